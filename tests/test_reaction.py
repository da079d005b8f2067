import pytest
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions.reaction import classify_reaction, fuse, text_gap, valuation_bucket


@pytest.mark.parametrize(
    "m1,m21,ok,expected",
    [
        (0.01, None, True, "good"),
        (-0.01, None, True, "bad"),
        (0.0099, None, True, "neutral"),
        (-0.03, -0.015, True, "overreaction_down"),
        (-0.03, -0.0151, True, "bad"),
        (0.04, 0.02, True, "overreaction_up"),
        (0.04, 0.0201, True, "good"),
        (0.0299, -0.5, True, "good"),
        (-0.10, 0.10, False, "bad"),
        (-0.10, None, True, "bad"),
        (0.0, 0.0, True, "neutral"),
        (None, None, True, None),
    ],
)
def test_classes_at_their_edges(spark, m1, m21, ok, expected):
    df = spark.createDataFrame([(m1, m21, ok)], "m1 double, m21 double, ok boolean")
    assert df.select(classify_reaction(F.col("m1"), F.col("m21"), F.col("ok")).alias("x")).first()["x"] == expected


@pytest.mark.parametrize(
    "gap,bucket", [(-15.0, "undervalued"), (-14.99, "near_fair"), (0.0, "near_fair"), (15.0, "overvalued"), (None, "no_data")]
)
def test_buckets(spark, gap, bucket):
    df = spark.createDataFrame([(gap,)], "g double")
    assert df.select(valuation_bucket(F.col("g")).alias("x")).first()["x"] == bucket


@pytest.mark.parametrize("gap,shown", [(0.99, None), (-1.0, -1.0), (14.6, 15.0), (14.5, 14.0), (150.4, 150.0), (900.0, 150.0), (-400.0, -150.0)])
def test_gap_as_rendered(spark, gap, shown):
    df = spark.createDataFrame([(gap,)], "g double")
    assert df.select(text_gap(F.col("g")).alias("x")).first()["x"] == shown


def test_all_cells(spark):
    gaps = {"undervalued": -40.0, "near_fair": 5.0, "overvalued": 20.0, "no_data": None}
    rows = [(r, b, gaps[b], c, base) for r, b, c, base in K.FUSION_ROWS]
    df = spark.createDataFrame(rows, "news_reaction string, b string, gap_pct double, c string, base double")
    for row in fuse(df).collect():
        assert (row["valuation_bucket"], row["recommendation"]) == (row["b"], row["c"])
        bonus = 0.0 if row["gap_pct"] is None else 0.10 * min(abs(row["gap_pct"]) / 50, 1.0)
        assert row["confidence"] == pytest.approx(round(min(0.95, row["base"] + bonus), 2))


def test_unknown_reaction_raises(spark):
    df = spark.createDataFrame([("great", 1.0)], "news_reaction string, gap_pct double")
    with pytest.raises(Exception, match="unknown news reaction"):
        fuse(df).collect()
