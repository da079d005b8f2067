"""Rows of op8 that share an id, or have none, and whose texts agree in the low bits of a hash."""

import pytest
from pyspark.sql import functions as F

from newsquake.llm import suffixes
from newsquake.llm.common import Shelf
from tests.llm.test_operators import prose, removed


@pytest.fixture
def shelf(spark, tmp_path):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    return Shelf(spark, "rows")


@pytest.mark.parametrize("id_", [None, 7])
def test_each_row_is_cut_at_its_own_places(spark, shelf, id_):
    # Texts with one value of the 16 low bits of their hash: half share a passage, half repeat nothing.
    passage = prose("shared", 60)
    many = spark.range(1 << 21).select(F.col("id").alias("n"), F.when(F.col("id") % 2 == 0, F.concat(F.lit(passage + " "), "id")).otherwise(F.concat("id", F.lit(" own "), F.repeat(F.concat("id", F.lit(" ")), 40))).alias("text"))
    low = F.xxhash64("text").bitwiseAND(F.lit(0xFFFF))
    texts = [r.text for r in many.where(low == 11).orderBy("n").limit(20).collect()]
    assert any(t.startswith(passage) for t in texts) and not all(t.startswith(passage) for t in texts)
    texts += [texts[0]] * 3
    docs = spark.createDataFrame([(id_, t) for t in texts], "doc_id bigint, text string")
    data = [t.encode() for t in texts]
    wanted = [(t, bytes(b for b, g in zip(t, gone) if not g)) for t, gone in zip(data, removed(data, 200))]
    cut = suffixes.remove_repeats(docs, shelf, 200)
    assert sorted((r.text.encode(), bytes(r.cut.kept)) for r in cut.collect()) == sorted(wanted)
