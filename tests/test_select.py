import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsquake.plans.select import attempted_skips, first_seen, keep_within_caps, select_headlines, skip_totals
from newsquake.sources.tables import sector_table

HEADS = "ticker string, window_idx int, feed_pos long, title string, publisher string, published_at timestamp"
ASSESS = "ticker string, feed_pos long, relevant boolean, importance int"


def june(d):
    return dt.datetime(2026, 6, d)


def run(spark, heads, assess, name="Novo Nordisk A/S", ticker="NVO", sector="Healthcare"):
    entities = spark.createDataFrame([(ticker, name, sector)], "ticker string, name string, sector string")
    rows = spark.createDataFrame(heads, HEADS).repartition(3)
    done = select_headlines(rows, spark.createDataFrame(assess, ASSESS), entities, sector_table(spark)).collect()
    return sorted(done, key=lambda r: (r["window_idx"], r["order_1"], r["order_2"], r["feed_pos"]))


def test_screened_window_is_ordered_by_importance_then_recency(spark):
    titles = ["Novo cuts prices", "Novo wins FDA approval", "Novo Banco profit", "Novo shares edge up", "Novo opens a plant"]
    marks = [(True, 3), (True, 9), (False, 5), (True, 0), (True, 3)]
    heads = [("NVO", 1, i, t, "TIKR", june(i + 1)) for i, t in enumerate(titles)]
    done = run(spark, heads, [("NVO", i, *m) for i, m in enumerate(marks)])
    assert [r["title"] for r in done if r["skip_reason"] is None] == ["Novo wins FDA approval", "Novo opens a plant", "Novo cuts prices"]
    assert sorted(r["skip_reason"] for r in done if r["skip_reason"]) == ["screen_not_relevant", "screen_unimportant"]


def test_a_missing_date_comes_last(spark):
    heads = [("NVO", 1, 0, "a", "x", None), ("NVO", 1, 1, "b", "x", june(1)), ("NVO", 1, 2, "c", "x", None)]
    done = run(spark, heads, [("NVO", i, True, 3) for i in range(3)])
    assert [r["title"] for r in done] == ["b", "a", "c"]


def test_headlines_without_a_window_keep_their_reason(spark):
    heads = [("NVO", 1, 0, "a", "x", june(1)), ("NVO", None, 1, "a", "x", None), ("NVO", None, 2, "b", "x", dt.datetime(1990, 1, 1))]
    entities = spark.createDataFrame([("NVO", "Novo", "Healthcare")], "ticker string, name string, sector string")
    assessed = spark.createDataFrame([("NVO", 0, True, 3)], ASSESS)
    done = select_headlines(spark.createDataFrame(heads, HEADS), assessed, entities, sector_table(spark)).collect()
    assert sorted((r["feed_pos"], r["skip_reason"] or "") for r in done) == [(0, ""), (1, "no_date"), (2, "outside_windows")]


def test_one_missing_assessment_sends_the_window_to_the_rules(spark):
    heads = [
        ("ORCL", 1, 0, "Should You Buy Oracle Stock?", "Motley Fool", None),
        ("ORCL", 1, 1, "Oracle signs cloud deal", "MarketBeat", None),
        ("ORCL", 1, 2, "Oracle signs cloud deal with OpenAI", "Reuters", None),
        ("ORCL", 1, 3, "Grain harvest begins", "Reuters", None),
    ]
    done = run(spark, heads, [("ORCL", i, True, 5) for i in range(3)], "Oracle", "ORCL", "Technology")
    assert {r["path"] for r in done} == {"regex"}
    assert [r["skip_reason"] for r in done] == ["low_content_headline", "low_quality_publisher", None, "not_relevant"]


@pytest.mark.parametrize("assessed,path,count", [(30, "screen", 30), (29, "regex", 35)])
def test_pool_of_thirty(spark, assessed, path, count):
    heads = [("NVO", 1, i, f"Novo Nordisk item {i}", "Reuters", None) for i in range(35)]
    done = run(spark, heads, [("NVO", i, True, 3) for i in range(assessed)])
    assert {r["path"] for r in done} == {path} and len(done) == count


def test_title_is_taken_from_the_most_recent_window(spark):
    heads = [("A", 2, 1, "same", "p", None), ("A", 1, 9, "same", "q", None), ("A", 1, 12, "same", "r", None), ("B", 5, 3, "same", "s", None)]
    got = {(r["ticker"], r["window_idx"], r["feed_pos"]) for r in first_seen(spark.createDataFrame(heads, HEADS)).collect()}
    assert got == {("A", 1, 9), ("B", 5, 3)}


def loop(rows, per_window=8, per_entity=50):
    """The capped loop over one entity: rows are (window, position, ok)."""
    kept, skips = [], 0
    for window in sorted({r[0] for r in rows}):
        if len(kept) >= per_entity:
            break
        here = 0
        for _, position, ok in sorted(r for r in rows if r[0] == window):
            if len(kept) >= per_entity or here >= per_window:
                break
            if ok:
                kept.append((window, position))
                here += 1
            else:
                skips += 1
    return kept, skips


@pytest.mark.parametrize("windows,size,every", [(1, 9, 99), (7, 12, 4), (9, 20, 3), (3, 5, 2), (7, 8, 99)])
def test_caps_and_tallies_match_the_loop(spark, windows, size, every):
    rows = [(w, p, p % every != 1) for w in range(1, windows + 1) for p in range(size)]
    frame = spark.createDataFrame(
        [("A", w, w * 1000 + p, 0, 0, "good" if ok else None, None if ok else "failed") for w, p, ok in rows],
        "ticker string, window_idx int, feed_pos long, order_1 long, order_2 long, news_reaction string, skip_reason string",
    ).repartition(4)
    kept = keep_within_caps(frame)
    expected, skips = loop(rows)
    assert sorted((r["window_idx"], r["feed_pos"] - r["window_idx"] * 1000) for r in kept.collect()) == expected
    selected = frame.select("ticker", "window_idx", "feed_pos", F.lit("screen").alias("path"), F.lit(None).cast("string").alias("skip_reason"))
    counted = {r["skip_reason"]: r["n"] for r in attempted_skips(selected, frame, kept).collect()}
    assert counted.get("failed", 0) == skips


def test_totals_have_both_levels(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "x"), ("B", "x"), ("B", None)], "ticker string, skip_reason string")
    got = {(r["ticker"], r["skip_reason"]): r["n"] for r in skip_totals(df).collect()}
    assert got == {("A", "x"): 2, ("B", "x"): 1, (None, "x"): 3}
