"""What a row needs is computed once, whatever filters and joins read it."""

from pyspark.sql import functions as F

from newsquake.operators.lookup import computed_once
from newsquake.plans import convert


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_computed_once_is_not_repeated_by_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "id int, v string")
    once = computed_once(df, {"v": F.sha2(F.concat("v", F.lit("x")), 256), "w": F.col("id") + 1})
    assert once.columns == ["id", "v", "w"]
    kept = once.where("v is not null and v <> 'q'").where("v <> 'r'")
    assert optimized(kept).count("sha2(") == 1
    hashed = {r.id: r.h for r in df.select("id", F.sha2(F.concat("v", F.lit("x")), 256).alias("h")).collect()}
    assert {r.id: (r.v, r.w) for r in once.collect()} == {i: (h, None if i is None else i + 1) for i, h in hashed.items()}


def test_old_rows_are_parsed_once_per_branch(spark):
    prices = spark.createDataFrame([("A", "2024-03-01", 10.0)], "ticker string, d string, close double").select(
        "ticker", F.to_date("d").alias("trade_date"), "close"
    )
    fields = "row_id bigint, ticker string, user_query string, market_data string, valuation string, earnings string, news string, output string"
    old = spark.createDataFrame([(1, "A", "", "", "v", "", "n", "o")], fields)
    done = convert.converted(convert.convert_rows(old, prices, None))
    assert optimized(done).count("split(news") == 2  # the days to label, and the rows
