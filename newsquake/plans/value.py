"""JOB-VAL: point-in-time metrics and three-scenario valuation per (entity, date)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions.numeric import clamp, present, ratio
from newsquake.operators.asof import AsOf, asof_lookup

_DOUBLES = (
    "shares_outstanding payout_ratio free_cash_flow dividend_rate growth_0y growth_1y growth_0y_low growth_0y_high "
    "eps_growth_5y book_value_per_share operating_margin pe_forward dividend_yield year_low year_high"
).split()


def consensus_growth(estimates: DataFrame) -> DataFrame:
    """Growth and its range from an EPS estimate table; nothing when the year-ago figure is missing or 0."""
    year_ago = present(F.col("year_ago_eps"))
    usable = year_ago.isNotNull()
    return estimates.select(
        "ticker",
        F.when(usable, F.col("growth_0y")).alias("growth_0y"),
        F.when(usable, F.col("growth_1y")).alias("growth_1y"),
        ratio(F.col("eps_low") - year_ago, F.abs(year_ago)).alias("growth_0y_low"),
        ratio(F.col("eps_high") - year_ago, F.abs(year_ago)).alias("growth_0y_high"),
    )


def _preferred(quarterly: DataFrame, groups: dict[str, tuple[str, ...]]) -> DataFrame:
    """(ticker, kind, metric, period_end, value): per kind, the first listed metric an entity reports at all."""
    ranks = [(kind, place, name) for kind, names in groups.items() for place, name in enumerate(names)]

    def chosen(part: int) -> Column:
        return reduce(lambda acc, r: acc.when(F.col("metric") == r[2], r[part]), ranks[1:], F.when(F.col("metric") == ranks[0][2], ranks[0][part]))

    ranked = quarterly.where(F.col("metric").isin(*[r[2] for r in ranks])).withColumns({"kind": chosen(0), "_rank": chosen(1)})
    return (
        ranked.withColumn("_best", F.min("_rank").over(Window.partitionBy("ticker", "kind")))
        .where((F.col("_rank") == F.col("_best")) & F.col("value").isNotNull() & ~F.isnan("value"))
        .select("ticker", "kind", "metric", "period_end", "value")
    )


def preferred_metric(quarterly: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Rows of the first listed metric an entity reports at all, without missing values."""
    return _preferred(quarterly, {"only": names}).drop("kind")


def quarter_facts(quarterly: DataFrame, tolerance: int = K.YEAR_AGO_TOLERANCE_DAYS) -> DataFrame:
    """(ticker, kind, period_end, eps_ttm, revenue, year_ago), one row per quarter and kind.

    eps_ttm sums the last four quarters, or takes the latest times four when there are fewer.
    year_ago is the revenue of a period less than tolerance days from a year before; statements
    are listed most recent first, so of several the latest counts. A range frame around a year
    back holds the few candidates, so nothing is joined to itself.
    """
    facts = _preferred(quarterly, {"eps": K.EPS_METRICS, "revenue": K.REVENUE_METRICS})
    axis = Window.partitionBy("ticker", "kind").orderBy("period_end")
    # A year before is 365 or 366 days back, give or take the tolerance.
    year_back = Window.partitionBy("ticker", "kind").orderBy("_day").rangeBetween(-366 - tolerance, tolerance - 365)
    previous = [F.lag("value", i).over(axis) for i in (1, 2, 3)]
    summed = F.col("value") + previous[0] + previous[1] + previous[2]
    target = F.add_months("period_end", -12)
    near = F.filter("_candidates", lambda c: F.abs(F.datediff(c["period_end"], target)) < tolerance)
    return (
        facts.withColumn("_day", F.unix_date("period_end"))
        .withColumns(
            {
                "_ttm": F.when(previous[2].isNotNull(), summed).otherwise(F.col("value") * 4),
                "_candidates": F.collect_list(F.struct("period_end", "value")).over(year_back),
            }
        )
        .select(
            "ticker", "kind", "period_end",
            F.when(F.col("kind") == "eps", F.col("_ttm")).alias("eps_ttm"),
            F.when(F.col("kind") == "revenue", F.col("value")).alias("revenue"),
            F.when(F.col("kind") == "revenue", F.array_max(near)["value"]).alias("year_ago"),
        )
    )


def trailing_eps(quarterly: DataFrame) -> DataFrame:
    """(ticker, period_end, eps_ttm)."""
    return quarter_facts(quarterly).where(F.col("kind") == "eps").select("ticker", "period_end", "eps_ttm")


def fact_lookups(prices: DataFrame, quarterly: DataFrame, earnings: DataFrame) -> list[AsOf]:
    """Price, trailing EPS, revenue, last report and next report as known on a date."""
    quarters = quarter_facts(quarterly)
    return [
        AsOf("bar", prices, "trade_date", ["trade_date", "close"], tolerance_days=K.PRICE_TOLERANCE_DAYS),
        AsOf("eps", quarters, "period_end", ["period_end", "eps_ttm"], inclusive=False, rows=F.col("kind") == "eps"),
        AsOf(
            "rev", quarters, "period_end", ["period_end", "revenue", "year_ago"], inclusive=False,
            rows=F.col("kind") == "revenue",
        ),
        AsOf(
            "report", earnings, "event_ts", ["event_ts", "eps_reported", "eps_estimate"], inclusive=False,
            rows=F.col("eps_reported").isNotNull(),
        ),
        AsOf("next", earnings, "event_ts", ["event_ts"], direction="forward", inclusive=False),
    ]


def fact_columns() -> dict[str, Column]:
    return {
        "price_date": F.col("bar.trade_date"),
        "price": F.col("bar.close"),
        "eps_ttm": F.col("eps.eps_ttm"),
        "last_quarter": F.col("rev.period_end"),
        "revenue": F.col("rev.revenue"),
        "year_ago_revenue": F.col("rev.year_ago"),
        "last_eps": F.col("report.eps_reported"),
        "last_estimate": F.col("report.eps_estimate"),
        "next_earnings": F.to_date("next.event_ts"),
    }


def facts_as_of(days: DataFrame, prices: DataFrame, quarterly: DataFrame, earnings: DataFrame) -> DataFrame:
    """What was known on each (ticker, as_of) date."""
    found = asof_lookup(days, "ticker", "as_of", fact_lookups(prices, quarterly, earnings))
    return found.select(*days.columns, *[c.alias(name) for name, c in fact_columns().items()])


def with_fundamentals(facts: DataFrame, fundamentals: DataFrame, sectors: DataFrame) -> DataFrame:
    """Facts joined to the entity snapshot and its sector constants; missing columns come as null."""
    have = set(fundamentals.columns)
    snapshot = fundamentals.select(
        "ticker",
        *[(F.col(c) if c in have else F.lit(None)).cast("double").alias(c) for c in _DOUBLES],
        *[(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in ("sector", "currency", "financial_currency")],
    )
    # The sector table has one row per known sector, a fixed handful.
    known = sectors.select("sector", "median_pe", "asset_heavy", "reit")
    described = snapshot.join(known, "sector", "left").withColumns(
        {"asset_heavy": F.coalesce("asset_heavy", F.lit(False)), "reit": F.coalesce("reit", F.lit(False))}
    )
    return facts.join(described, "ticker", "left")


def sustainable_growth(eps: Column, book_value: Column, payout: Column) -> Column:
    roe = ratio(eps, book_value)
    usable = (eps > 0) & (book_value > 0) & (roe >= K.ROE_FLOOR)
    return F.when(usable, F.least(roe, F.lit(K.ROE_CAP)) * (1 - F.coalesce(payout, F.lit(0.0))))


def valuation_basis(eps: Column, payout: Column, reit: Column, asset_heavy: Column, fcf: Column) -> Column:
    return (
        F.when(reit, "dividends")
        .when(eps.isNull() | (eps <= 0), "revenue")
        .when(payout.between(K.DIVIDEND_PAYOUT_THRESHOLD, K.DIVIDEND_PAYOUT_CEILING), "dividends")
        .when(asset_heavy & (fcf > 0), "fcf")
        .otherwise("eps")
    )


def screen_metrics(df: DataFrame) -> DataFrame:
    """ROE, price ratios, FCF yield and PEG; each is null alone when its own inputs are unusable."""
    eps, book, cap = present(F.col("eps_ttm")), F.col("book_value_per_share"), present(F.col("market_cap"))
    growth = F.col("growth_0y")
    return df.withColumns(
        {
            "roe": F.when(book > 0, ratio(eps, book)),
            "price_to_sales": F.when(F.col("annual_revenue") > 0, ratio(cap, F.col("annual_revenue"))),
            "fcf_yield": F.when(cap > 0, ratio(F.col("free_cash_flow"), cap)),
            "peg_ratio": F.when(growth > K.PEG_MIN_GROWTH, ratio(present(F.col("pe_trailing")), growth * 100)),
            "price_to_book": F.when(book > 0, ratio(present(F.col("price")), book)),
        }
    )


def base_flows(df: DataFrame) -> DataFrame:
    """Per-share flow of every basis at once: cf_eps, cf_dividends, cf_fcf, cf_revenue."""
    pe, forward = F.col("pe_trailing"), present(F.col("pe_forward"))
    one_time = (pe > 0) & (forward > 0) & (pe < forward * K.ONE_TIME_PE_RATIO) & present(F.col("price")).isNotNull()
    raw_forward = F.col("pe_forward")
    too_low = (pe > 0) & (pe < K.LOW_PE_THRESHOLD) & (
        raw_forward.isNull() | ((raw_forward > 0) & (raw_forward < K.LOW_PE_THRESHOLD))
    )
    shares = ratio(present(F.col("market_cap")), present(F.col("price")))
    same_currency = F.coalesce(
        (F.col("currency") == F.col("financial_currency")) | (F.col("currency") == "") | (F.col("financial_currency") == ""),
        F.lit(True),
    )
    per_share = F.when(same_currency, present(shares))
    return df.withColumns(
        {
            "cf_eps": F.when(one_time, ratio(F.col("price"), forward)).when(too_low, F.lit(None)).otherwise(F.col("eps_known")),
            "cf_dividends": F.col("dividend_rate"),
            "cf_fcf": ratio(present(F.col("free_cash_flow")), per_share),
            "cf_revenue": ratio(present(F.col("annual_revenue")), per_share),
        }
    )


def growth_tiers(df: DataFrame, use_5y: bool = True) -> DataFrame:
    """First-stage growth per scenario: 5-year consensus, else consensus, else sustainable, else the fallback."""
    sgr = F.col("sustainable_growth")
    g0, g1 = F.col("growth_0y"), F.col("growth_1y")
    reliable = (
        ((g0 >= 0) == (g1 >= 0))
        & (F.abs(g0) <= K.CONSENSUS_MAGNITUDE_CAP)
        & (F.abs(g1) <= K.CONSENSUS_MAGNITUDE_CAP)
    )

    def offset(c: Column) -> Column:
        return F.when(c.isNotNull(), F.least(c, F.lit(K.CONSENSUS_OFFSET_CAP)))

    high = offset(F.col("growth_0y_high") - g0)
    low = offset(g0 - F.col("growth_0y_low"))
    five = F.col("eps_growth_5y")
    five_usable = F.lit(use_5y) & (F.abs(five) <= K.CONSENSUS_MAGNITUDE_CAP)
    blended = F.coalesce((five + sgr) / 2, five)
    middle = (g0 + g1) / 2
    staged = df.withColumns(
        {
            "_five": F.when(five_usable, blended),
            "_middle": F.when(reliable, middle),
            "_up": F.coalesce(high, low, F.lit(K.GROWTH_BEST_SPREAD)),
            "_down": F.coalesce(low, high, F.lit(-K.GROWTH_WORST_SPREAD)),
        }
    )
    spread = {"normal": F.lit(0.0), "best": F.lit(K.GROWTH_BEST_SPREAD), "worst": F.lit(K.GROWTH_WORST_SPREAD)}
    shift = {"normal": F.lit(0.0), "best": F.col("_up"), "worst": -F.col("_down")}
    return staged.withColumns(
        {
            f"g1_{name}": clamp(
                F.coalesce(
                    F.col("_five") + spread[name],
                    F.col("_middle") + shift[name],
                    F.col("sustainable_growth") + spread[name],
                    F.lit(K.G1_FALLBACK[name]),
                ),
                K.G1_FLOOR,
                K.G1_CAP,
            )
            for name in K.SCENARIOS
        }
    ).drop("_five", "_middle", "_up", "_down")


def later_stage(df: DataFrame) -> DataFrame:
    """Second-stage growth and exit multiples per scenario."""
    own_or_sector = F.when(
        F.col("median_pe").isNotNull() | F.col("pe_trailing").isNotNull(), F.greatest("median_pe", "pe_trailing")
    )
    normal = F.coalesce(F.least(F.lit(K.NORMAL_EXIT), own_or_sector), F.lit(K.NORMAL_EXIT))
    worst = F.when(F.col("asset_heavy"), K.WORST_EXIT_ASSET_HEAVY).otherwise(K.WORST_EXIT_DEFAULT)
    columns = {
        "exit_normal": normal,
        "exit_best": normal + (K.BEST_EXIT - K.NORMAL_EXIT),
        "exit_worst": worst,
    }
    for name in K.SCENARIOS:
        g1 = F.col(f"g1_{name}")
        columns[f"g2_{name}"] = F.greatest(F.lit(K.G2_FLOOR), F.least(F.lit(K.G2_CEILING[name]), g1))
        columns[f"g2d_{name}"] = F.greatest(g1, F.lit(K.G2_DIVIDENDS_FLOOR))
    return df.withColumns(columns)


def _fold(terms: int, step: Column) -> Column:
    """step + step**2 + ... + step**terms."""
    return reduce(lambda acc, _: step * (1 + acc), range(terms - 1), step)


def dividend_stream(rate: Column, growth: Column, years: int = 10) -> Column:
    """Present value of a dividend growing at one rate for the whole horizon."""
    return rate * _fold(years, (1 + growth) / (1 + K.DISCOUNT_RATE))


def dcf_factor(g1: Column, g2: Column, exit_multiple: Column) -> Column:
    """Present value, per unit of flow, of five and five discounted years plus the terminal value."""
    early, late = (1 + g1) / (1 + K.DISCOUNT_RATE), (1 + g2) / (1 + K.DISCOUNT_RATE)
    return _fold(5, early) + F.pow(early, F.lit(5.0)) * (_fold(5, late) + F.pow(late, F.lit(5.0)) * exit_multiple)


def terminal_factor(g1: Column, g2: Column, exit_multiple: Column) -> Column:
    """Present value, per unit of flow, of the terminal value alone."""
    grown = F.pow(1 + g1, F.lit(5.0)) * F.pow(1 + g2, F.lit(5.0))
    return grown * exit_multiple / (1 + K.DISCOUNT_RATE) ** 10


def intrinsic_values(df: DataFrame) -> DataFrame:
    """iv_<basis> for all four bases and stream_pv, the dividend stream a non-dividend basis may add."""

    def weighted(terms: dict[str, Column]) -> Column:
        return reduce(lambda a, b: a + b, [K.SCENARIO_PROBABILITY * terms[name] for name in K.SCENARIOS])

    def multiple(name: str) -> Column:
        return F.col(f"exit_{name}")

    flat_exit = {"normal": F.lit(K.NORMAL_EXIT), "best": F.lit(K.BEST_EXIT), "worst": multiple("worst")}
    growth = {name: (F.col(f"g1_{name}"), F.col(f"g2_{name}")) for name in K.SCENARIOS}
    factors = df.withColumns(
        {
            "_f_market": weighted({n: terminal_factor(*growth[n], multiple(n)) for n in K.SCENARIOS}),
            "_f_revenue": weighted({n: terminal_factor(*growth[n], F.lit(K.REVENUE_EXIT[n])) for n in K.SCENARIOS}),
            "_f_dividends": weighted(
                {n: dcf_factor(F.col(f"g1_{n}"), F.col(f"g2d_{n}"), flat_exit[n]) for n in K.SCENARIOS}
            ),
            "stream_pv": F.coalesce(
                weighted({n: dividend_stream(present(F.col("dividend_rate")), F.col(f"g2_{n}")) for n in K.SCENARIOS}),
                F.lit(0.0),
            ),
        }
    )

    def value(flow: str, factor: str) -> Column:
        return F.when(F.col(flow) > 0, F.col(flow) * F.col(factor))

    return factors.withColumns(
        {
            "iv_eps": value("cf_eps", "_f_market"),
            "iv_fcf": value("cf_fcf", "_f_market"),
            "iv_revenue": value("cf_revenue", "_f_revenue"),
            "iv_dividends": value("cf_dividends", "_f_dividends"),
        }
    ).drop("_f_market", "_f_revenue", "_f_dividends")


def choose_value(df: DataFrame) -> DataFrame:
    """Basis and intrinsic value after the surprise gate, the payout blend and the fallback order."""
    stream = F.col("stream_pv")
    full = {
        "fcf": F.col("iv_fcf") + stream,
        "eps": F.col("iv_eps") + stream,
        "dividends": F.col("iv_dividends"),
        "revenue": F.col("iv_revenue") + stream,
    }

    def by_basis(basis: Column, values: dict[str, Column]) -> Column:
        return reduce(lambda acc, kv: acc.when(basis == kv[0], kv[1]), values.items(), F.when(F.lit(False), F.lit(0.0)))

    low = K.DIVIDEND_PAYOUT_THRESHOLD - K.PAYOUT_BLEND_HALF_WIDTH
    high = K.DIVIDEND_PAYOUT_THRESHOLD + K.PAYOUT_BLEND_HALF_WIDTH
    payout = F.col("payout_ratio")
    blends = (F.col("first_basis") != "revenue") & ~F.col("reit") & payout.between(low, high)
    prepared = df.withColumns(
        {
            "_gated": (F.col("first_basis") == "eps") & F.coalesce(F.col("eps_surprise") > K.EPS_SURPRISE_LIMIT, F.lit(False)),
            "_t": F.when(blends, (payout - low) / (high - low)),
            "_other": F.when(F.col("asset_heavy") & (F.col("free_cash_flow") > 0), "fcf").otherwise("eps"),
        }
    ).withColumn("_other_iv", by_basis(F.col("_other"), {"fcf": F.col("iv_fcf"), "eps": F.col("iv_eps")}))
    t, div_iv, other_iv = F.col("_t"), F.col("iv_dividends"), F.col("_other_iv")
    both = div_iv.isNotNull() & other_iv.isNotNull()
    tried = prepared.withColumns(
        {
            "_basis": F.when(t.isNull(), F.col("first_basis"))
            .when((both & (t >= 0.5)) | (div_iv.isNotNull() & other_iv.isNull()), "dividends")
            .otherwise(F.col("_other")),
            "_value": F.when(t.isNull(), by_basis(F.col("first_basis"), full))
            .when(both, t * div_iv + (1 - t) * other_iv)
            .otherwise(F.coalesce(div_iv, other_iv)),
        }
    )
    open_to_fallback = F.col("_value").isNull() & ~F.col("_gated")
    fallback = F.coalesce(
        *[
            F.when(full[name].isNotNull() & (F.col("_basis") != name), F.struct(F.lit(name).alias("basis"), full[name].alias("value")))
            for name in K.FALLBACK_BASIS_ORDER
        ]
    )
    chosen = tried.withColumn("_fallback", F.when(open_to_fallback, fallback))
    known = F.col("price").isNotNull()
    return chosen.withColumns(
        {
            "basis": F.when(known, F.when(F.col("_gated"), "eps").otherwise(F.coalesce("_fallback.basis", "_basis"))),
            "intrinsic": F.when(known & ~F.col("_gated"), F.coalesce("_value", "_fallback.value")),
        }
    ).drop("_gated", "_t", "_other", "_other_iv", "_basis", "_value", "_fallback")


def value_facts(facts: DataFrame, fundamentals: DataFrame, sectors: DataFrame, use_5y: bool = True) -> DataFrame:
    """Metrics, basis, intrinsic value and gap from facts and the entity snapshot."""
    known = with_fundamentals(facts, fundamentals, sectors)
    eps = present(F.col("eps_ttm"))
    estimate = present(F.col("last_estimate"))
    base = known.withColumns(
        {
            "eps_known": eps,
            "market_cap": F.col("price") * present(F.col("shares_outstanding")),
            "annual_revenue": F.col("revenue") * 4,
            "pe_trailing": F.when(F.col("eps_ttm") > 0, ratio(F.col("price"), F.col("eps_ttm"))),
            "eps_surprise": ratio(F.col("last_eps") - estimate, F.abs(estimate)),
            "sustainable_growth": sustainable_growth(eps, F.col("book_value_per_share"), F.col("payout_ratio")),
            "first_basis": valuation_basis(
                eps, F.col("payout_ratio"), F.col("reit"), F.col("asset_heavy"), F.col("free_cash_flow")
            ),
        }
    )
    staged = later_stage(growth_tiers(screen_metrics(base_flows(base)), use_5y))
    chosen = choose_value(intrinsic_values(staged))
    gap = ratio(F.col("price") - F.col("intrinsic"), F.col("intrinsic")) * 100
    return chosen.withColumn("gap_pct", gap)


def value_days(
    days: DataFrame,
    prices: DataFrame,
    quarterly: DataFrame,
    earnings: DataFrame,
    fundamentals: DataFrame,
    sectors: DataFrame,
    use_5y: bool = True,
) -> DataFrame:
    """Typed valuation of each distinct (ticker, as_of) row, gap_pct positive when overvalued."""
    return value_facts(facts_as_of(days, prices, quarterly, earnings), fundamentals, sectors, use_5y)
