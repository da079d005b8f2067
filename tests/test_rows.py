import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions import render
from newsquake.functions.numeric import draw, fixed_text, scaled_half_even, weighted_choice
from newsquake.plans import convert, evaluate, report, rows, template
from newsquake.schemas import ROW, ROW_FIELDS
from newsquake.sources import sinks, stored


def row(**values):
    return tuple(values.get(name, "") for name in ROW_FIELDS)


def test_decimal_text_is_exact(spark):
    rng = random.Random(5)
    values = [0.25, 0.35, 0.05, 0.15, -0.04, 2.675, 1.005, 0.125, 0.375, 1e9 + 0.05, 123456.785, 0.0, 99.95, 0.5, 1.5, 2.5]
    values += [rng.randrange(-10**6, 10**6) / rng.choice([8, 16, 20, 40, 200, 2000]) for _ in range(400)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    columns = [fixed_text(F.col("v"), d).alias(f"d{d}") for d in (0, 1, 2)] + [scaled_half_even(F.col("v"), 2).alias("n")]
    for r in df.select("v", *columns).collect():
        for d in (0, 1, 2):
            assert r[f"d{d}"] == f"{r['v']:.{d}f}", r["v"]


def test_draws_are_stable_and_spread(spark):
    df = spark.range(4000).select(weighted_choice(K.REACTION_WEIGHTS, draw(F.col("id"), "r")).alias("c"))
    shares = {r["c"]: r["count"] / 4000 for r in df.groupBy("c").count().collect()}
    assert set(shares) == set(K.REACTION_WEIGHTS)
    assert all(abs(shares[k] - w) < 0.03 for k, w in K.REACTION_WEIGHTS.items())


def test_news_block(spark):
    df = spark.range(300).withColumn("line", F.lit("- [Mon, 01 Jan 2024] Real - Wire"))
    today = F.lit("2024-01-10").cast("date")
    blocks = [r["b"] for r in df.select(render.news_block(F.array("line"), F.col("id"), today).alias("b")).collect()]
    sizes, places = set(), set()
    for block in blocks:
        lines = block.split("\n")
        noise = [x.split("] ")[1].rsplit(" - ", 1)[0] for x in lines if "Real" not in x]
        assert len(set(noise)) == len(noise) and set(noise) <= set(K.NOISE_HEADLINES)
        sizes.add(len(noise))
        places.add(lines.index("- [Mon, 01 Jan 2024] Real - Wire"))
        for x in lines:
            if "Real" not in x:
                when = dt.datetime.strptime(x[3:19], "%a, %d %b %Y").date()
                assert dt.date(2024, 1, 4) <= when <= dt.date(2024, 1, 10)
    assert sizes == {1, 2, 3} and len(places) > 2


def test_prompt_by_task(spark):
    data = [row(task="reaction", ticker="A", news="n", output="{}", price_context="p"), row(task="analysis", ticker="A", user_query="q?", output="{}")]
    got = [r["p"] for r in spark.createDataFrame(data, ROW).select(render.prompt(F.col("task"), "<end>").alias("p")).collect()]
    assert "Target Stock: A\nRecent Price Move: p\n" in got[0] and got[0].endswith("### Response:\n\n{}<end>")
    assert "User Question: q?\n" in got[1] and '{"recommendation": "BUY|SELL|HOLD"' in got[1]
    with pytest.raises(Exception, match="unknown task"):
        spark.createDataFrame([row(task="other")], ROW).select(render.prompt(F.col("task"))).collect()


@pytest.mark.parametrize("rare", [0, 29, 30, 31])
def test_rebalance_counts(spark, rare):
    data = [("reaction", "good")] * 80 + [("reaction", "bad")] * 12 + [("reaction", "overreaction_up")] * rare + [("analysis", "good")] * 7
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "id long, task string, news_reaction string").repartition(4)
    got = {(r["task"], r["news_reaction"]): r["count"] for r in rows.rebalance(df, ["id"]).groupBy("task", "news_reaction").count().collect()}
    assert got.get(("reaction", "good")) == max(30, rare) and got[("reaction", "bad")] == 12
    assert got.get(("reaction", "overreaction_up"), 0) == rare and got[("analysis", "good")] == 7


@pytest.mark.parametrize("n,held", [(35, [2, 7, 12, 17, 22, 27, 32]), (37, [2, 7, 13, 18, 23, 29, 34]), (22, [2, 8, 13, 19]), (12, [3, 9]), (3, [1])])
def test_holdout_indices(spark, n, held):
    pools = spark.range(n).select(F.lit("p").alias("pool"), F.col("id").alias("idx"))
    assert sorted(r["idx"] for r in template.holdout_indices(pools).collect()) == held


def test_template_pool_mapping(spark):
    rows_ = [("BUY", "extreme_alone"), ("BUY", "news_wins"), ("SELL", "news_wins"), ("HOLD", "news_wins_no_headroom")]
    df = spark.createDataFrame(rows_, "d string, t string")
    assert [r["p"] for r in df.select(template.pool_of(F.col("d"), F.col("t")).alias("p")).collect()] == ["neutral", "good", "bad", "bad"]


def test_files_round_trip(spark, tmp_path):
    data = [row(task="reaction", ticker=t, news_reaction="good", output='{"news_reaction":"good"}', news="n") for t in "ABAC"]
    frame = spark.createDataFrame(data, ROW).withColumn("split", F.when(F.col("ticker") == "A", "val").otherwise("train"))
    path = str(tmp_path / "rows")
    sinks.write_split(frame.where("ticker <> 'C'"), path)
    sinks.append_rows(frame.where("ticker = 'C'"), path)
    train, val = stored.read_rows(spark, f"{path}/split=train"), stored.read_rows(spark, f"{path}/split=val")
    assert sorted(r["ticker"] for r in train.collect()) == ["B", "C"] and val.count() == 2
    assert train.columns == list(ROW_FIELDS)
    both = stored.read_split(spark, [f"{path}/split=train"], [f"{path}/split=val", f"{path}/split=none"])
    assert both.count() == 4
    tagged = stored.read_tagged(spark, {"real": f"{path}/split=train", "old": f"{path}/split=val"})
    assert {(r["source"], r["ticker"]) for r in tagged.collect()} == {("real", "B"), ("real", "C"), ("old", "A")}
    entities = spark.createDataFrame([("A",), ("Z",)], "ticker string")
    assert [r["ticker"] for r in rows.pending(entities, both).collect()] == ["Z"]
    sinks.rewrite(f"{path}/split=train", str(tmp_path / "staging"), train.where("ticker = 'B'"))
    assert [r["ticker"] for r in stored.read_rows(spark, f"{path}/split=train").collect()] == ["B"]


def test_blank_lines_are_skipped(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text(json.dumps(dict(zip(ROW_FIELDS, row(ticker="A")))) + "\n\n  \n" + '{"ticker": "B"}\n')
    got = stored.read_rows(spark, str(tmp_path / "x.jsonl"))
    assert sorted((r["ticker"], r["task"]) for r in got.collect()) == [("A", ""), ("B", "")]


def told(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def test_heading_over_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], ROW).withColumns({"id": F.lit(1), "split": F.lit("train")})
    sinks.write_review(empty, str(tmp_path / "none"), "id", "synthetic")
    assert told(tmp_path / "none") == f"SYNTHETIC dataset review list: 0 total rows (0 train, 0 val), grouped by ticker.\n{'=' * 100}\n\n"


def test_valuation_report_in_order(spark, tmp_path):
    entities = spark.createDataFrame([("A", "Alpha"), ("B", "Beta"), ("C", "Gamma"), ("D", "Delta")], "ticker string, name string")
    market = "Price: $1,250.50\nP/E (trailing): 12.5 | P/E (forward): N/A\nSector Median P/E: 20.0 (Energy)"
    gap = "Intrinsic Value (EPS-based): $900.00\nvs Current Price: {} by ~{}%"
    texts = [("A", market, gap.format("overvalued", 39), "e1"), ("B", market, gap.format("undervalued", 120), "e2"), ("C", "nothing known", "", None)]
    frame = spark.createDataFrame(texts, "ticker string, market_data string, valuation string, earnings string").repartition(3)
    sinks.write_valuation_report(entities.repartition(2), frame, str(tmp_path / "report"), F.lit("2024-05-06"))
    body = told(tmp_path / "report")
    lines = body.split("\n")
    assert lines[0] == "# Valuation report - all 4 tickers" and lines[2].startswith("Generated 2024-05-06.")
    assert lines[6:10] == [
        "| B | Beta | 1,250.50 | 900.00 (EPS-based) | undervalued 120% | Energy | 12.5/N/A |",
        "| A | Alpha | 1,250.50 | 900.00 (EPS-based) | overvalued 39% | Energy | 12.5/N/A |",
        "| C | Gamma | N/A | N/A (N/A) | N/A | N/A | N/A/N/A |",
        "| D | Delta | ERROR | - (-) | - | - | -/- |",
    ]
    assert lines[10:15] == ["", "---", "", "## Full detail per ticker", ""]
    marks = [body.index(f"### {t}") for t in ("B (Beta)", "A (Alpha)", "C (Gamma)", "D (Delta)")]
    assert marks == sorted(marks)
    assert f"### B (Beta)\n\n**Market Data:**\n```\n{market}\n```\n\n**Valuation:**\n```\n{gap.format('undervalued', 120)}\n```\n\n**Earnings:**\n```\ne2\n```\n\n" in body


def test_review_list(spark, tmp_path):
    data = [row(task="reaction", ticker=t, news="n", output='{"news_reaction":"good"}') for t in ("B", "A", "B")]
    frame = spark.createDataFrame(data, ROW).withColumn("id", F.monotonically_increasing_id())
    frame = frame.withColumn("split", F.when(F.col("ticker") == "A", "val").otherwise("train"))
    sinks.write_review(frame, str(tmp_path / "review"), "id")
    body = told(tmp_path / "review")
    assert body.startswith(f"REAL dataset review list: 3 total rows (2 train, 1 val), grouped by ticker.\n{'=' * 100}\n\n\n{'#' * 100}\n# TICKER: A\n")
    assert body.index("# TICKER: A") < body.index("--- [val] A (reaction) ---") < body.index("# TICKER: B") < body.index("--- [train] B")
    assert body.count("# TICKER: B") == 1 and body.count("--- [train] B") == 2
    summary = report.split_summary(frame).first()
    assert tuple(summary) == (3, 2, 1, 2)


def test_conversion_outcomes(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 4, 5, 8)]
    prices = spark.createDataFrame([("A", d, 100.0 + 5 * i) for i, d in enumerate(days)], "ticker string, trade_date date, close double")
    noise = f"- [Mon, 01 Jan 2024] {K.NOISE_HEADLINES[1]} - Reuters"
    real = "- [Wed, 03 Jan 2024] Profit - record - up - Wire"
    cheap = "Intrinsic Value (EPS-based): $9.00\nvs Current Price: undervalued by ~40%"
    good = json.dumps({"impacted_stocks": [{"recommendation": "BUY", "reasoning": "r", "answer": "a"}]})
    sell = json.dumps({"impacted_stocks": [{"recommendation": "SELL", "reasoning": "r", "answer": "a"}]})
    cases = [
        (1, f"{noise}\n{real}", cheap, good, None),
        (2, f"{noise}\n{real}", cheap, sell, "recommendation_mismatch"),
        (3, noise, cheap, good, "unresolvable_headline"),
        (4, f"{real}\n{real}", cheap, good, "unresolvable_headline"),
        (5, f"{noise}\n{real}", cheap, "{oops", "unparseable_output"),
        (6, f"{noise}\n{real}", cheap, '{"impacted_stocks": []}', "unparseable_output"),
        (7, "- [Mon, 01 Jan 2024] Early - Wire", cheap, good, "relabel_failed:insufficient_history"),
        (8, "- [Wed, 03 Jan 2024] Hyphen - Some-Wire", cheap, good, "unresolvable_headline"),
    ]
    frame = spark.createDataFrame(
        [(i, "A", "q", "m", v, "e", n, o) for i, n, v, o, _ in cases],
        "row_id long, ticker string, user_query string, market_data string, valuation string, earnings string, news string, output string",
    )
    done = {r["row_id"]: r for r in convert.convert_rows(frame, prices, None).collect()}
    assert {i: done[i]["drop_reason"] for i in done} == {i: reason for i, _, _, _, reason in cases}
    assert done[1]["news_reaction"] == "good" and json.loads(done[1]["output"]) == {"recommendation": "BUY", "reasoning": "r", "answer": "a"}
    assert done[1]["price_context"] == "A moved +4.8% on the day this was published."


def test_evaluation_counts(spark):
    stored_rows = spark.createDataFrame(
        [(1, "reaction", "s", "good", "", ""), (2, "reaction", "s", "bad", "", ""), (3, "analysis", "s", "good", "BUY", ""), (4, "analysis", "t", "good", "HOLD", "near_fair")],
        "row_id long, task string, source string, news_reaction string, recommendation string, valuation_bucket string",
    )
    texts = spark.createDataFrame(
        [(1, "m", '{"news_reaction": "good"}'), (2, "m", "no idea"), (3, "m", '{"recommendation": "BUY", "reasoning": "r", "answer": " "}'),
         (4, "m", '{"recommendation": "SELL", "reasoning": "r", "answer": "a"} trailing }')],
        "row_id long, model string, text string",
    )
    scored = evaluate.score(stored_rows, texts)
    got = {r["row_id"]: (r["correct"], r["json_ok"], r["nonempty"], r["predicted"]) for r in scored.collect()}
    assert got == {1: (True, True, None, "good"), 2: (False, False, None, None), 3: (True, True, False, "BUY"), 4: (False, False, True, "SELL")}
    cells = {(r["news_reaction"], r["bucket"]): r["accuracy"] for r in evaluate.cell_accuracy(scored).collect()}
    assert cells == {("good", "unknown"): 1.0, ("good", "near_fair"): 0.0}
    gate = evaluate.ship_gate(scored).first()
    assert (gate["agreement"], gate["ships"]) == (0.5, False)
    shown = {(r["expected"], r["predicted"]) for r in evaluate.confusion_report(scored).where("task = 'reaction'").collect()}
    assert shown == {("good", "good"), ("bad", "UNPARSEABLE")}
    with pytest.raises(Exception, match="unknown task"):
        evaluate.score(stored_rows.withColumn("task", F.lit("x")), texts).collect()
