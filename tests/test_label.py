import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsquake.plans.label import label_days, label_headlines, measure_days, reaction_counts

MONDAY = dt.date(2024, 1, 1)


def weekdays(n, start=MONDAY):
    out, d = [], start
    while len(out) < n:
        if d.weekday() < 5:
            out.append(d)
        d += dt.timedelta(days=1)
    return out


@pytest.fixture(scope="module")
def market(spark):
    days = weekdays(40)
    closes = [100.0 + i for i in range(40)]
    prices = spark.createDataFrame([("A", d, c) for d, c in zip(days, closes)], "ticker string, trade_date date, close double")
    return days, closes, prices


def measured(spark, prices, dates, events=None):
    frame = spark.createDataFrame([("A", d) for d in dates], "ticker string, as_of date")
    earnings = None
    if events is not None:
        earnings = spark.createDataFrame([("A", e) for e in events], "ticker string, event_ts timestamp")
    return {r["as_of"]: r for r in label_days(measure_days(frame, prices, earnings)).collect()}


def test_calendar_edges(spark, market):
    days, closes, prices = market
    saturday, before, after = dt.date(2024, 1, 6), dt.date(2023, 12, 25), days[-1] + dt.timedelta(days=1)
    got = measured(spark, prices, [days[0], days[3], saturday, before, after, days[-1]])
    assert got[days[0]]["skip_reason"] == "insufficient_history"
    assert got[before]["skip_reason"] == "insufficient_history"
    assert got[after]["skip_reason"] == "insufficient_history"
    assert got[days[3]]["day0_date"] == days[3]
    assert got[days[3]]["move_1d"] == (closes[3] - closes[2]) / closes[2]
    assert got[days[3]]["move_21d"] == (closes[24] - closes[2]) / closes[2]
    assert got[saturday]["day0_date"] == days[5]
    assert got[saturday]["move_1d"] == (closes[5] - closes[4]) / closes[4]
    assert got[days[-1]]["move_21d"] is None and got[days[-1]]["skip_reason"] is None


def test_search_windows(spark):
    rows = [("A", MONDAY, 10.0), ("A", MONDAY + dt.timedelta(days=20), 11.0), ("A", MONDAY + dt.timedelta(days=26), 12.0)]
    prices = spark.createDataFrame(rows, "ticker string, trade_date date, close double")
    got = measured(spark, prices, [MONDAY + dt.timedelta(days=8), MONDAY + dt.timedelta(days=7), MONDAY + dt.timedelta(days=21)])
    assert got[MONDAY + dt.timedelta(days=8)]["skip_reason"] == "insufficient_history"
    assert got[MONDAY + dt.timedelta(days=7)]["move_1d"] == pytest.approx(0.1)
    assert got[MONDAY + dt.timedelta(days=21)]["move_1d"] == pytest.approx(1 / 11)


@pytest.mark.parametrize(
    "offset,hour,skip,assessable",
    [(0, 18, "earnings_within_1d", False), (0, 0, None, True), (1, 0, None, False), (21, 12, None, False), (22, 12, None, True)],
)
def test_earnings_guard(spark, market, offset, hour, skip, assessable):
    days, _, prices = market
    event = dt.datetime.combine(days[5 + offset], dt.time(hour))
    got = measured(spark, prices, [days[5]], [event])[days[5]]
    assert (got["skip_reason"], got["assessable"]) == (skip, assessable)


def test_weekend_event_counts_as_the_next_trading_day(spark, market):
    days, _, prices = market
    saturday, sunday = dt.date(2024, 1, 6), dt.datetime(2024, 1, 7, 9)
    assert measured(spark, prices, [saturday], [sunday])[saturday]["skip_reason"] == "earnings_within_1d"


def test_headlines_keep_a_missing_date_as_a_reason(spark, market):
    days, _, prices = market
    rows = [(1, "A", dt.datetime.combine(days[4], dt.time(23))), (2, "A", None), (3, "B", dt.datetime.combine(days[4], dt.time(1)))]
    heads = spark.createDataFrame(rows, "feed_pos long, ticker string, published_at timestamp")
    got = {r["feed_pos"]: (r["news_reaction"], r["skip_reason"]) for r in label_headlines(heads, prices).collect()}
    assert got == {1: ("neutral", None), 2: (None, "no_date"), 3: (None, "insufficient_history")}
    counts = {r["outcome"]: r["headlines"] for r in reaction_counts(heads, prices).collect()}
    assert counts == {"neutral": 1, "no_date": 1, "insufficient_history": 1}


def test_hot_day_is_reduced_before_the_lookup(spark, market):
    days, _, prices = market
    one = spark.createDataFrame([(1, "A", dt.datetime.combine(days[4], dt.time(1)))], "feed_pos long, ticker string, published_at timestamp")
    many = one.withColumn("feed_pos", F.explode(F.sequence(F.lit(1), F.lit(5000)))).repartition(6)
    counts = reaction_counts(many, prices).collect()
    assert [(r["outcome"], r["headlines"]) for r in counts] == [("neutral", 5000)]
    assert label_headlines(many, prices).where("news_reaction = 'neutral'").count() == 5000
