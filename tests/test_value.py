"""Valuations against a plain per-row calculation written for the test."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from newsquake.plans.value import quarter_facts, value_days, value_facts
from newsquake.sources.tables import sector_table

MEDIAN = {"Technology": 28.0, "Energy": 12.0, "Financial Services": 13.0}
HEAVY = {"Energy", "Industrials", "Basic Materials", "Utilities"}
FIELDS = (
    "price eps_ttm revenue last_eps last_estimate shares_outstanding payout_ratio free_cash_flow dividend_rate growth_0y growth_1y "
    "growth_0y_low growth_0y_high eps_growth_5y book_value_per_share pe_forward"
).split()


def plain(c):
    """(basis, intrinsic) of one case."""
    g = c.get
    price, sector = g("price"), g("sector")
    eps = g("eps_ttm") or None
    cap = price * g("shares_outstanding") if price is not None and g("shares_outstanding") else None
    pe = price / eps if price is not None and eps and eps > 0 else None
    annual = g("revenue") * 4 if g("revenue") is not None else None
    payout, fcf = g("payout_ratio"), g("free_cash_flow")
    alternative = "fcf" if sector in HEAVY and fcf is not None and fcf > 0 else "eps"
    if sector == "Real Estate":
        basis = "dividends"
    elif eps is None or eps <= 0:
        basis = "revenue"
    elif payout is not None and 0.55 <= payout <= 1.20:
        basis = "dividends"
    else:
        basis = alternative
    if price is None:
        return None, None

    def flow(b):
        if b == "eps":
            fwd = g("pe_forward")
            if pe and fwd and fwd > 0 and pe < fwd * 0.5:
                return price / fwd
            if pe and pe < 6 and (fwd is None or 0 < fwd < 6):
                return None
            return eps
        if b == "dividends":
            return g("dividend_rate")
        if not cap:
            return None
        if g("currency") and g("financial_currency") and g("currency") != g("financial_currency"):
            return None
        top = annual if b == "revenue" else fcf
        return top / (cap / price) if top else None

    def growth():
        sgr, book = None, g("book_value_per_share")
        if eps and eps > 0 and book and book > 0 and eps / book >= 0.02:
            sgr = min(eps / book, 0.25) * (1 - (payout or 0.0))
        a, b, five = g("growth_0y"), g("growth_1y"), g("eps_growth_5y")
        if five is not None and abs(five) <= 0.6:
            mid, up, down = ((five + sgr) / 2 if sgr is not None else five), 0.02, 0.04
        elif a is not None and b is not None and (a >= 0) == (b >= 0) and abs(a) <= 0.6 and abs(b) <= 0.6:
            hi = min(g("growth_0y_high") - a, 0.1) if g("growth_0y_high") is not None else None
            lo = min(a - g("growth_0y_low"), 0.1) if g("growth_0y_low") is not None else None
            mid = (a + b) / 2
            up = hi if hi is not None else lo if lo is not None else 0.02
            down = lo if lo is not None else hi if hi is not None else 0.04
        elif sgr is not None:
            mid, up, down = sgr, 0.02, 0.04
        else:
            return [0.08, 0.10, 0.04]
        return [max(min(v, 0.30), -0.10) for v in (mid, mid + up, mid - down)]

    def worth(b, stream):
        cf = flow(b)
        if cf is None or cf <= 0:
            return None
        low = 12.0 if sector in HEAVY else 13.0
        known = [v for v in (MEDIAN.get(sector), pe) if v is not None]
        normal = min(20.0, max(known)) if known else 20.0
        exits = {"revenue": [3.0, 6.0, 1.0], "dividends": [20.0, 25.0, low]}.get(b, [normal, normal + 5, low])
        total = 0.0
        for g1, ceiling, out in zip(growth(), (0.10, 0.12, 0.04), exits):
            if b == "dividends":
                g2, pv, running = max(g1, -0.05), 0.0, cf
                for year in range(1, 11):
                    running *= 1 + (g1 if year <= 5 else g2)
                    pv += running / 1.1**year
                pv += running * out / 1.1**10
            else:
                g2 = max(0.0, min(ceiling, g1))
                pv = cf * (1 + g1) ** 5 * (1 + g2) ** 5 * out / 1.1**10
                if stream and g("dividend_rate"):
                    pv += sum(g("dividend_rate") * (1 + g2) ** y / 1.1**y for y in range(1, 11))
            total += pv / 3
        return total

    actual, estimate = g("last_eps"), g("last_estimate")
    if basis == "eps" and actual is not None and estimate and (actual - estimate) / abs(estimate) > 0.75:
        return "eps", None
    low, high = 0.55 - 0.05, 0.55 + 0.05
    if basis != "revenue" and sector != "Real Estate" and payout is not None and low <= payout <= high:
        t, d, o = (payout - low) / (high - low), worth("dividends", False), worth(alternative, False)
        if d is not None and o is not None:
            return ("dividends" if t >= 0.5 else alternative), t * d + (1 - t) * o
        basis, value = ("dividends", d) if d is not None else (alternative, o)
    else:
        value = worth(basis, True)
    if value is None:
        for other in ("fcf", "eps", "dividends", "revenue"):
            if other != basis and worth(other, True) is not None:
                return other, worth(other, True)
    return basis, value


BASE = dict(
    price=100.0, eps_ttm=5.0, revenue=50.0, last_eps=1.2, last_estimate=1.0, shares_outstanding=10.0, payout_ratio=0.2,
    free_cash_flow=40.0, dividend_rate=2.0, growth_0y=0.08, growth_1y=0.1, growth_0y_low=0.05, growth_0y_high=0.12,
    eps_growth_5y=None, book_value_per_share=30.0, pe_forward=18.0, sector="Technology", currency="USD", financial_currency="USD",
)
CHANGES = [
    {}, {"sector": "Real Estate"}, {"sector": "Real Estate", "dividend_rate": None}, {"eps_ttm": 0.0}, {"eps_ttm": -1.0}, {"eps_ttm": None},
    *[{"payout_ratio": p} for p in (None, 0.4999, 0.50, 0.55, 0.5501, 0.60, 0.61, 1.20, 1.21)],
    {"payout_ratio": 0.55, "dividend_rate": None}, {"payout_ratio": 0.52, "eps_ttm": 40.0, "pe_forward": None},
    {"payout_ratio": 0.52, "eps_ttm": 40.0, "pe_forward": None, "dividend_rate": None},
    {"sector": "Energy"}, {"sector": "Energy", "free_cash_flow": None}, {"sector": "Energy", "free_cash_flow": -5.0},
    {"sector": "Energy", "payout_ratio": 0.53}, {"sector": "Unknown"}, {"sector": None},
    {"eps_ttm": -1.0, "financial_currency": "EUR"}, {"eps_ttm": -1.0, "financial_currency": None}, {"eps_ttm": -1.0, "currency": ""},
    {"growth_0y": -0.05}, {"growth_0y": 0.60, "growth_1y": 0.60}, {"growth_0y": 0.61}, {"growth_0y_high": None}, {"growth_0y_low": None},
    {"growth_0y_high": None, "growth_0y_low": None}, {"growth_0y_high": 0.9}, {"growth_1y": None}, {"growth_0y": -0.5, "growth_1y": -0.5},
    {"growth_1y": None, "book_value_per_share": 1000.0}, {"growth_1y": None, "book_value_per_share": 5.0},
    {"growth_1y": None, "book_value_per_share": None}, {"eps_growth_5y": 0.2}, {"eps_growth_5y": 0.2, "book_value_per_share": 0.0},
    {"eps_growth_5y": 0.944}, {"eps_growth_5y": -0.6}, {"pe_forward": 60.0}, {"eps_ttm": 20.0, "pe_forward": None},
    {"eps_ttm": 20.0, "pe_forward": 5.0}, {"eps_ttm": 20.0, "pe_forward": 0.0}, {"eps_ttm": 20.0, "pe_forward": 7.0},
    {"last_eps": 1.75}, {"last_eps": 1.76}, {"last_eps": 1.76, "sector": "Energy"}, {"last_estimate": 0.0, "last_eps": 9.0},
    {"price": None}, {"shares_outstanding": None, "eps_ttm": None}, {"dividend_rate": 0.0}, {"dividend_rate": None}, {"revenue": None, "eps_ttm": -1.0},
    {"eps_ttm": 1.0, "sector": "Financial Services"}, {"eps_ttm": 12.0, "sector": "Financial Services"},
]


def test_every_case(spark):
    cases = [{**BASE, **change, "ticker": f"T{i:02d}"} for i, change in enumerate(CHANGES)]
    names = ["ticker", *FIELDS, "sector", "currency", "financial_currency"]
    text = {"ticker", "sector", "currency", "financial_currency"}
    schema = T.StructType([T.StructField(n, T.StringType() if n in text else T.DoubleType()) for n in names])
    frame = spark.createDataFrame([tuple(c[n] for n in names) for c in cases], schema)
    known = ("price", "eps_ttm", "revenue", "last_eps", "last_estimate")
    facts = frame.select("ticker", *known)
    got = {r["ticker"]: r for r in value_facts(facts, frame.drop(*known), sector_table(spark)).collect()}
    for case in cases:
        basis, intrinsic = plain(case)
        row = got[case["ticker"]]
        assert row["basis"] == basis, case
        if intrinsic is None:
            assert row["intrinsic"] is None, case
        else:
            assert row["intrinsic"] == pytest.approx(intrinsic, rel=1e-9), case
            assert row["gap_pct"] == pytest.approx((case["price"] - intrinsic) / intrinsic * 100, rel=1e-9)


def quarters(spark, rows):
    return spark.createDataFrame(rows, "ticker string, metric string, period_end date, value double")


def test_quarters_known_on_a_date(spark):
    ends = [dt.date(2023, 3, 31), dt.date(2023, 6, 30), dt.date(2023, 9, 30), dt.date(2023, 12, 31), dt.date(2024, 3, 31)]
    rows = [("A", "Basic EPS", d, 9.0) for d in ends] + [("A", "Diluted EPS", d, float(i + 1)) for i, d in enumerate(ends)]
    rows += [("A", "Total Revenue", d, 100.0 + i) for i, d in enumerate(ends)] + [("B", "Basic EPS", ends[0], 3.0), ("B", "Diluted EPS", ends[1], None)]
    got = {(r["ticker"], r["kind"], r["period_end"]): r for r in quarter_facts(quarters(spark, rows)).collect()}
    assert [got[("A", "eps", d)]["eps_ttm"] for d in ends] == [4.0, 8.0, 12.0, 10.0, 14.0]
    assert [got[("A", "revenue", d)]["year_ago"] for d in ends] == [None, None, None, None, 100.0]
    assert not any(k[0] == "B" for k in got)


@pytest.mark.parametrize("shift,found", [(-20, False), (-19, True), (0, True), (19, True), (20, False)])
def test_year_ago_tolerance(spark, shift, found):
    now, target = dt.date(2024, 3, 31), dt.date(2023, 3, 31)
    rows = [("A", "Total Revenue", target + dt.timedelta(days=shift), 50.0), ("A", "Total Revenue", now, 60.0)]
    got = {r["period_end"]: r["year_ago"] for r in quarter_facts(quarters(spark, rows)).collect()}
    assert got[now] == (50.0 if found else None)


def test_period_end_on_the_date_is_not_known_yet(spark):
    end = dt.date(2024, 3, 31)
    days = spark.createDataFrame([("A", end), ("A", end + dt.timedelta(days=1))], "ticker string, as_of date")
    prices = spark.createDataFrame([("A", end - dt.timedelta(days=9), 10.0)], "ticker string, trade_date date, close double")
    quarterly = quarters(spark, [("A", "Diluted EPS", end, 1.0), ("A", "Total Revenue", end, 5.0)])
    earnings = spark.createDataFrame([], "ticker string, event_ts timestamp, eps_estimate double, eps_reported double")
    snapshot = spark.createDataFrame([("A", "Technology", 3.0)], "ticker string, sector string, shares_outstanding double")
    got = {r["as_of"]: r for r in value_days(days, prices, quarterly, earnings, snapshot, sector_table(spark)).collect()}
    assert got[end]["eps_ttm"] is None and got[end]["price"] == 10.0
    assert got[end + dt.timedelta(days=1)]["eps_ttm"] == 4.0 and got[end + dt.timedelta(days=1)]["price"] == 10.0
    assert got[end]["market_cap"] == 30.0
