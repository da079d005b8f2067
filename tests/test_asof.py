import datetime as dt
import random

from pyspark.sql import functions as F

from newsquake.operators.asof import AsOf, asof_lookup, distinct_days
from newsquake.operators.lookup import skew_safe_join

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def fixture(spark, seed=3, hot=0.4):
    rng = random.Random(seed)
    # One key holds a large share of everything.
    key = lambda: "hot" if rng.random() < hot else f"k{rng.randrange(5)}"
    probes = {(key(), day(rng.randrange(60))) for _ in range(300)}
    bars = {(key(), day(rng.randrange(60))) for _ in range(200)}
    events = {(key(), dt.datetime.combine(day(rng.randrange(60)), dt.time(rng.choice([0, 18])))) for _ in range(80)}
    return (
        spark.createDataFrame(sorted(probes), "ticker string, as_of date").repartition(5),
        spark.createDataFrame([(k, d, float(d.toordinal())) for k, d in sorted(bars)], "ticker string, trade_date date, close double").repartition(3),
        spark.createDataFrame(sorted(events), "ticker string, event_ts timestamp"),
        probes, bars, events,
    )


def test_lookups_match_brute_force(spark):
    days, bars_df, events_df, probes, bars, events = fixture(spark)
    look = [
        AsOf("fwd", bars_df, "trade_date", ["trade_date"], direction="forward"),
        AsOf("back", bars_df, "trade_date", ["trade_date"], tolerance_days=4),
        AsOf("strict", bars_df, "trade_date", ["trade_date"], inclusive=False),
        AsOf("next", events_df, "event_ts", ["event_ts"], direction="forward", inclusive=False, carry={"bar": "fwd.trade_date"}),
        AsOf("last", events_df, "event_ts", ["event_ts"], inclusive=False),
        AsOf("late", bars_df, "trade_date", ["trade_date"], rows=F.col("close") > day(30).toordinal()),
    ]
    got = {(r["ticker"], r["as_of"]): r for r in asof_lookup(days, "ticker", "as_of", look).collect()}
    assert set(got) == probes
    pick = lambda row, name, part="trade_date": row[name][part] if row[name] is not None else None
    for (k, d), row in got.items():
        own = sorted(x for kk, x in bars if kk == k)
        midnight = dt.datetime.combine(d, dt.time())
        after = sorted(x for kk, x in events if kk == k and x > midnight)
        before = sorted(x for kk, x in events if kk == k and x < midnight)
        assert pick(row, "fwd") == next((x for x in own if x >= d), None)
        assert pick(row, "back") == next((x for x in reversed(own) if d - dt.timedelta(days=4) <= x <= d), None)
        assert pick(row, "strict") == next((x for x in reversed(own) if x < d), None)
        assert pick(row, "late") == next((x for x in reversed(own) if x <= d and x > day(30)), None)
        assert pick(row, "next", "event_ts") == (after[0] if after else None)
        assert pick(row, "last", "event_ts") == (before[-1] if before else None)
        if after:
            assert row["next"]["bar"] == next((x for x in own if x >= after[0].date()), None)


def test_result_does_not_depend_on_partitioning(spark):
    days, bars_df, *_ = fixture(spark)
    look = lambda bars: [AsOf("fwd", bars, "trade_date", ["trade_date", "close"], direction="forward")]
    first = asof_lookup(days, "ticker", "as_of", look(bars_df)).collect()
    second = asof_lookup(days.repartition(1), "ticker", "as_of", look(bars_df.repartition(7))).collect()
    assert sorted(map(str, first)) == sorted(map(str, second))


def test_distinct_days_drops_null_dates(spark):
    df = spark.createDataFrame([("a", None), ("a", day(1)), ("a", day(1))], "ticker string, published_at date")
    assert [tuple(r) for r in distinct_days(df, "ticker", "published_at").collect()] == [("a", day(1))]


def test_salted_join_equals_plain_join(spark):
    big = spark.range(500).withColumn("k", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 11))
    small = spark.range(8).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner"):
        salted = skew_safe_join(big, small, ["k"], ["id"], how).select("id", "k", "v")
        plain = big.join(small, ["k"], how).select("id", "k", "v")
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
