"""Registered queries beside their SQL counterparts on the smallest tables; tools/check.py runs all of them."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from tools.check import TABLES, _rows

DATA = "/root/testdata/sf0.001"
CHOSEN = [
    "flt5_6_name_needles", "flt11_selected_headlines", "win4_first_seen_titles", "join3_bars_to_event", "fn1_to_3_labelled_headlines",
    "fn6_to_18_valuation", "agg2_price_percentiles", "agg10_accuracy", "agg15_running_accuracy", "join16_agg5_6_threshold_grid",
    "win11_eval_sample", "fn18_exact_decimal_text", "str1_weekly_counts", "agg6_cells_in_wide_bands", "agg14_low_ship_gate", "set2_merged_pools",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="sample tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", CHOSEN)
def test_same_rows(spark, sql, name):
    frame = queries()[name](spark, DATA)
    cursor = sql.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert _rows(frame.columns, [tuple(r) for r in frame.collect()]) == _rows(columns, cursor.fetchall())


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["outcome", "headlines"] and frame.count() > 0
