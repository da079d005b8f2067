"""Draws of template rows are spread by more than their reaction class."""

from pyspark.sql import functions as F

from newsquake.plans import template


def templates(spark):
    pools = [(p, i, [f"{{ticker}} {p} {i}"], [f"r {p} {i}"]) for p in ("good", "bad", "neutral") for i in range(12)]
    pools = spark.createDataFrame(pools, "pool string, idx int, headlines array<string>, reasonings array<string>")
    news = spark.createDataFrame([("Energy", "g", "b", "gr", "br")], "sector string, good_headline string, bad_headline string, good_reasoning string, bad_reasoning string")
    rows = [(i, ("good", "bad", "neutral", "overreaction_up", None)[i % 5], "AB"[i % 2], ("Energy", None)[i % 2], 1.5) for i in range(60)]
    drawn = spark.createDataFrame(rows, "draw_id bigint, news_reaction string, ticker string, sector string, move_pct double")
    drawn = drawn.withColumn("as_of", F.date_add(F.lit("2001-01-01").cast("date"), (F.col("draw_id") % 3).cast("int")))
    drawn = drawn.withColumn("name", F.col("ticker"))
    days = drawn.select("ticker", "as_of").distinct().where("not (ticker = 'B' and as_of = '2001-01-03')")
    texts = {name: F.concat(F.lit(name), F.lit(" "), F.col("as_of").cast("string")) for name in ("market_data", "valuation", "earnings")}
    number = F.lit(None).cast("double")
    return pools, news, drawn, days.withColumns({**texts, "operating_margin": number, "roe": number, "peg_ratio": number, "shown_gap_pct": F.lit(20.0)})


def test_template_rows_are_not_gathered_by_class(spark):
    pools, news, drawn, days = templates(spark)
    args = (pools, news, ["name", "ticker"], F.lit("2002-01-01").cast("date"))
    late = template.template_rows(drawn, *args, days=days)
    early = template.template_rows(drawn.join(days, ["ticker", "as_of"]), *args)
    got = sorted(map(tuple, late.collect()), key=str)
    assert got == sorted(map(tuple, early.collect()), key=str)
    assert {r[0] for r in got} == {r.draw_id for r in drawn.join(days, ["ticker", "as_of"]).collect() if r.draw_id % 5 < 3}
    for rows in (late, early):
        assert "hashpartitioning(news_reaction" not in rows._jdf.queryExecution().executedPlan().toString()
