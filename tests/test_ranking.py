import random

import pytest
from pyspark.sql import functions as F

from newsquake.operators.ranking import nearest_rank, running_totals, sample_per_group, top_k


@pytest.mark.parametrize("target", [0, 1, 37, 200, 10_000])
@pytest.mark.parametrize("bits", [2, 6, 16])
def test_sample_is_exact_and_stable(spark, target, bits):
    rows = [(i, "a" if i % 3 else "b") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g string")
    targets = spark.createDataFrame([("a", target), ("b", 5)], "g string, target long")
    one = sample_per_group(df, "g", targets, ["id"], "s", bits).collect()
    two = sample_per_group(df.repartition(7), "g", targets, ["id"], "s", bits).collect()
    assert sorted(one) == sorted(two)
    assert len({r["id"] for r in one}) == len(one)
    assert sum(r["g"] == "a" for r in one) == min(target, 200)
    assert sum(r["g"] == "b" for r in one) == 5


def test_sample_does_not_depend_on_the_bucket_count(spark):
    df = spark.range(400).withColumn("g", F.lit("a"))
    targets = spark.createDataFrame([("a", 123)], "g string, target long")
    picks = [sorted(r["id"] for r in sample_per_group(df, "g", targets, ["id"], "s", bits).collect()) for bits in (1, 5, 16)]
    assert picks[0] == picks[1] == picks[2]


@pytest.mark.parametrize("n", [1, 2, 7, 100, 101])
def test_nearest_rank(spark, n):
    rng = random.Random(n)
    values = [round(rng.gauss(0, 0.05), 3) for _ in range(n)]
    percents = (5, 10, 25, 50, 75, 90, 95)
    df = spark.createDataFrame([("s", v) for v in values], "series string, v double")
    got = {r["percent"]: (r["n"], r["v"]) for r in nearest_rank(df, ["series"], "v", percents).collect()}
    ordered = sorted(values)
    assert got == {p: (n, ordered[min(n - 1, max(0, round(p / 100 * (n - 1))))]) for p in percents}


ROOMS = {
    "one range": [1.0 + i * 2.0**-50 for i in range(300)],
    "far apart": [(-1) ** i * 2.0 ** (i * 13 % 1900 - 950) for i in range(200)],
    "one far out": [i / 7 for i in range(200)] + [1e300, float("inf"), float("-inf")],
    "zeros and repeats": [0.0, -0.0] * 40 + [-1e-310, 5e-324] * 30 + [3.5] * 50,
}


@pytest.mark.parametrize("values", ROOMS.values(), ids=ROOMS.keys())
def test_nearest_rank_wherever_values_lie(spark, values):
    df = spark.createDataFrame([("s", v) for v in values], "series string, v double")
    other = df.withColumns({"series": F.lit("t"), "v": -F.col("v")})
    got = nearest_rank(df.union(other), ["series"], "v", (0, 5, 50, 95, 100), most=3, bins=8).collect()
    for series, ordered in (("s", sorted(values)), ("t", sorted(-v for v in values))):
        told = {r["percent"]: r["v"] for r in got if r["series"] == series}
        assert told == {p: ordered[round(p / 100 * (len(values) - 1))] for p in (0, 5, 50, 95, 100)}


def test_nearest_rank_of_long_integers_and_decimals(spark):
    big = [10**18 + i for i in range(50)]
    df = spark.createDataFrame([("s", v) for v in big], "series string, v long")
    for typed in (df, df.withColumn("v", F.col("v").cast("decimal(24,4)") / 10000)):
        got = {r["percent"]: r["v"] for r in nearest_rank(typed, ["series"], "v", (0, 50, 100), most=2, bins=4).collect()}
        every = sorted(r["v"] for r in typed.collect())
        assert got == {0: every[0], 50: every[24], 100: every[49]}
    assert nearest_rank(df.limit(0), ["series"], "v", (50,)).collect() == []


def test_sample_moves_no_whole_class(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") < 4000, "a").otherwise("b"))
    targets = spark.createDataFrame([("a", 100), ("b", 5000)], "g string, target long")
    taken = sample_per_group(df, "g", targets, ["id"], "s")
    assert taken.groupBy("g").count().orderBy("g").collect() == [("a", 100), ("b", 1000)]
    def nodes(plan):
        yield plan.nodeName()
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    # The maps are subqueries, no children: the rows themselves meet no join and no aggregate.
    assert not {"Join", "Aggregate"} & set(nodes(taken._jdf.queryExecution().optimizedPlan()))


def test_running_totals_over_chunks(spark):
    rng = random.Random(1)
    rows = [(m, i * 3, rng.randrange(2)) for m in ("a", "b") for i in range(97)]
    df = spark.createDataFrame(rows, "m string, i long, hit int").repartition(5)
    got = {(r["m"], r["i"]): (r["running_n"], r["running_hit"]) for r in running_totals(df, ["m"], "i", ["hit"], chunk=20).collect()}
    for m in ("a", "b"):
        n = total = 0
        for mm, i, hit in sorted(r for r in rows if r[0] == m):
            n, total = n + 1, total + hit
            assert got[(mm, i)] == (n, total)


def test_top_k_filters_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    best = top_k(df, ["g"], [F.col("id").desc()], 3)
    assert sorted(r["id"] for r in best.collect()) == [994, 995, 996, 997, 998, 999]
    assert "WindowGroupLimit" in best._jdf.queryExecution().toString()


def test_settled_follows_the_session(spark, monkeypatch, tmp_path):
    from newsquake import session

    df = spark.range(10).withColumn("x", F.col("id") * 2)
    if spark.conf.get(session.CHECKPOINT_CONF, None) is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    else:
        kept = session.settled(df)
        assert kept is not df
        assert sorted(map(tuple, kept.collect())) == [(i, 2 * i) for i in range(10)]
    monkeypatch.setattr(session, "CHECKPOINT_CONF", "spark.newsquake.no-such-setting")
    assert session.settled(df) is df
