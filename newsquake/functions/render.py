"""Text blocks of finished rows, formatted exactly and only at the edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions.numeric import draw, draw_index, fill, fixed_text, pick, ratio

DATE_FORMAT = "EEE, dd MMM yyyy"


def dated(day: Column) -> Column:
    return F.date_format(day, DATE_FORMAT)


def parse_dated(text: Column) -> Column:
    """The date of 'Wed, 05 Aug 2026'; the weekday is skipped because to_date rejects it."""
    return F.try_to_timestamp(F.substring(text, 6, 11), F.lit("dd MMM yyyy")).cast("date")


def headline_line(day: Column, title: Column, publisher: Column) -> Column:
    return F.concat(F.lit("- ["), F.coalesce(dated(day), F.lit("recent")), F.lit("] "), title, F.lit(" - "), publisher)


def with_text(df: DataFrame, digits: int, columns: dict[str, Column]) -> DataFrame:
    """Adds each value as text with a fixed number of decimals; null stays null.

    The values go through one array, so the exact rounding is compiled once per block rather than
    once per value, which would outgrow the size limit of a generated method.
    """
    packed = df.withColumn(f"_values_{digits}", F.array(*columns.values())).withColumn(
        f"_texts_{digits}", F.transform(f"_values_{digits}", lambda x: fixed_text(x, digits))
    )
    named = {name: F.col(f"_texts_{digits}")[i] for i, name in enumerate(columns)}
    return packed.withColumns(named).drop(f"_values_{digits}", f"_texts_{digits}")


def signed(text: Column) -> Column:
    return F.when(text.startswith("-"), text).otherwise(F.concat(F.lit("+"), text))


def money(value: Column, trillions: Column, billions: Column) -> Column:
    """A dollar amount in trillions with two digits or billions with one."""
    return F.concat(
        F.lit("$"),
        F.when(value >= 1e12, F.concat(trillions, F.lit("T"))).otherwise(F.concat(billions, F.lit("B"))),
    )


def price_context(df: DataFrame, move: str = "move_1d") -> DataFrame:
    text = F.concat(
        F.col("ticker"), F.lit(" moved "), signed(F.col("_move")), F.lit("% on the day this was published.")
    )
    return with_text(df, 1, {"_move": F.col(move) * 100}).withColumn("price_context", text).drop("_move")


def market_data(df: DataFrame) -> DataFrame:
    """market_data text of a valued day; unavailable without price, market cap or trailing EPS."""
    one_digit = {
        "_cap_b": F.col("market_cap") / 1e9,
        "_pe": F.col("pe_trailing"),
        "_pe_next": F.col("pe_forward"),
        "_margin": F.col("operating_margin") * 100,
        "_roe": F.col("roe") * 100,
        "_pb": F.col("price_to_book"),
        "_ps": F.col("price_to_sales"),
        "_fcf": F.col("fcf_yield") * 100,
        "_peg": F.col("peg_ratio"),
        "_median": F.col("median_pe"),
    }
    two_digits = {
        "_cap_t": F.col("market_cap") / 1e12,
        "_price": F.col("price"),
        "_eps": F.col("eps_ttm"),
        "_yield": F.col("dividend_yield"),
        "_low": F.col("year_low"),
        "_high": F.col("year_high"),
    }
    staged = with_text(with_text(df, 1, one_digit), 2, two_digits)

    def one(c: str, unit: str = "") -> Column:
        return F.coalesce(F.concat(F.col(c), F.lit(unit)), F.lit("N/A"))

    def when_set(c: str, text: Column, otherwise: str = "N/A") -> Column:
        return F.coalesce(F.when(F.col(c) != 0, text), F.lit(otherwise))

    spread = F.when(
        (F.col("year_low") != 0) & (F.col("year_high") != 0),
        F.concat(F.lit("$"), F.col("_low"), F.lit(" - $"), F.col("_high")),
    )
    sector = F.when(
        F.col("median_pe").isNotNull(), F.concat(F.col("_median"), F.lit(" ("), F.col("sector"), F.lit(")"))
    ).when(F.col("sector") != "", F.concat(F.lit("N/A ("), F.col("sector"), F.lit(")")))
    block = F.concat(
        F.lit("Price: $"), F.col("_price"),
        F.lit(" | Market Cap: "), money(F.col("market_cap"), F.col("_cap_t"), F.col("_cap_b")),
        F.lit("\nP/E (trailing): "), one("_pe"), F.lit(" | P/E (forward): "), when_set("pe_forward", F.col("_pe_next")),
        F.lit("\nEPS (trailing): $"), F.col("_eps"),
        F.lit(" | Dividend Yield: "), when_set("dividend_yield", F.concat(F.col("_yield"), F.lit("%")), "0.00%"),
        F.lit("\n52-Week Range: "), F.coalesce(spread, F.lit("N/A")),
        F.lit("\nOperating Margin: "), one("_margin", "%"), F.lit(" | ROE: "), one("_roe", "%"),
        F.lit(" | Price/Book: "), one("_pb"),
        F.lit("\nPrice/Sales: "), one("_ps"), F.lit(" | FCF Yield: "), one("_fcf", "%"), F.lit(" | PEG: "), one("_peg"),
        F.lit("\nSector Median P/E: "), F.coalesce(sector, F.lit("N/A")),
    )
    known = F.col("price").isNotNull() & F.col("market_cap").isNotNull() & F.col("eps_known").isNotNull()
    return staged.withColumn("market_data", F.when(known, block).otherwise(K.UNAVAILABLE)).drop(*one_digit, *two_digits)


def basis_label(basis: Column) -> Column:
    chain = None
    for name, label in K.BASIS_LABELS.items():
        chain = F.when(basis == name, label) if chain is None else chain.when(basis == name, label)
    return chain


def valuation(df: DataFrame) -> DataFrame:
    """valuation text of a valued day."""
    label, gap = basis_label(F.col("basis")), F.col("gap_pct")
    head = F.concat(F.lit("Intrinsic Value ("), label, F.lit("): $"), F.col("_value"), F.lit("\nvs Current Price: "))
    verdict = F.when(gap >= 0, "overvalued").otherwise("undervalued")
    size = F.when(F.abs(gap) > K.VALUATION_DISPLAY_CAP_PCT, F.lit(f">{K.VALUATION_DISPLAY_CAP_PCT:.0f}")).otherwise(
        F.concat(F.lit("~"), F.rint(F.abs(gap)).cast("long").cast("string"))
    )
    block = F.when(F.abs(gap) < 1.0, F.concat(head, F.lit("trading near fair value"))).otherwise(
        F.concat(head, verdict, F.lit(" by "), size, F.lit("%"))
    )
    missing = F.concat(F.lit("Not applicable (insufficient data for the "), F.lower(label), F.lit(" valuation basis)."))
    text = F.when(F.col("price").isNull(), K.UNAVAILABLE).when(F.col("intrinsic").isNull(), missing).otherwise(block)
    return with_text(df, 2, {"_value": F.col("intrinsic")}).withColumn("valuation", text).drop("_value")


def gap_from_text(text: Column) -> Column:
    """Signed gap back from a rendered valuation, null when it names no direction."""
    pattern = r"(overvalued|undervalued) by [~>](\d+)%"
    size = F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 2)).cast("double")
    return F.when(F.regexp_extract(text, pattern, 1) == "undervalued", -size).otherwise(size)


def earnings(df: DataFrame) -> DataFrame:
    """earnings text of a valued day; unavailable without a known quarter."""
    growth = ratio(F.col("revenue") - F.col("year_ago_revenue"), F.nullif(F.col("year_ago_revenue"), F.lit(0.0))) * 100
    two_digits = {"_rev_t": F.col("revenue") / 1e12, "_eps": F.col("last_eps"), "_est": F.col("last_estimate")}
    staged = with_text(with_text(df, 1, {"_yoy": growth, "_rev_b": F.col("revenue") / 1e9}), 2, two_digits)
    yoy = F.coalesce(F.concat(F.lit(" ("), signed(F.col("_yoy")), F.lit("% YoY)")), F.lit(""))
    actual, estimate = F.col("last_eps"), F.col("last_estimate")
    versus = F.when(actual > estimate, "beat est. $").when(actual < estimate, "missed est. $").otherwise("in line with est. $")
    note = F.when(
        actual.isNotNull() & (estimate != 0),
        F.concat(F.lit(", EPS $"), F.col("_eps"), F.lit(" ("), versus, F.col("_est"), F.lit(")")),
    )
    upcoming = F.concat(F.lit("\nNext Earnings Date: "), F.col("next_earnings").cast("string"))
    block = F.concat(
        F.lit("Last Quarter ("), F.col("last_quarter").cast("string"), F.lit("): Revenue "),
        money(F.col("revenue"), F.col("_rev_t"), F.col("_rev_b")),
        yoy, F.coalesce(note, F.lit("")), F.coalesce(upcoming, F.lit("")),
    )
    text = F.when(F.col("revenue").isNotNull(), block).otherwise(K.UNAVAILABLE)
    return staged.withColumn("earnings", text).drop("_yoy", "_rev_b", *two_digits)


def blocks(df: DataFrame) -> DataFrame:
    """All three fundamentals blocks of valued days."""
    return earnings(valuation(market_data(df)))


def drop_blocks(df: DataFrame, key: str, rate: float = K.BLOCK_MISSING_RATE) -> DataFrame:
    """Each block unavailable at the given rate, independently, by a hash of the key."""
    return df.withColumns(
        {
            name: F.when(draw(F.col(key), f"missing-{name}") < rate, K.UNAVAILABLE).otherwise(F.col(name))
            for name in ("market_data", "valuation", "earnings")
        }
    )


def news_block(lines: Column, key: Column, today: Column) -> Column:
    """The given lines and one to three distinct noise lines, in hash order."""
    count = draw_index(3, key, "noise-count") + 1
    size = len(K.NOISE_HEADLINES)
    first = draw_index(size, key, "noise-1")
    second = F.pmod(first + 1 + draw_index(size - 1, key, "noise-2"), F.lit(size))
    others = F.array_except(F.sequence(F.lit(0), F.lit(size - 1)), F.array(first, second))
    third = F.element_at(others, draw_index(size - 2, key, "noise-3") + 1)

    def noise(index: Column, place: int) -> Column:
        day = F.date_sub(today, draw_index(K.RECENT_DAYS + 1, key, f"noise-day-{place}"))
        publisher = pick(K.NOISE_PUBLISHERS, draw_index(len(K.NOISE_PUBLISHERS), key, f"noise-publisher-{place}"))
        return headline_line(day, pick(K.NOISE_HEADLINES, index), publisher)

    noise_lines = F.slice(F.array(noise(first, 1), noise(second, 2), noise(third, 3)), F.lit(1), count)
    mixed = F.transform(
        F.concat(lines, noise_lines),
        lambda line: F.struct(F.sha2(F.concat_ws(":", key.cast("string"), line), 256).alias("h"), line.alias("line")),
    )
    return F.array_join(F.transform(F.array_sort(mixed), lambda x: x["line"]), "\n")


def user_query(ticker: Column, key: Column) -> tuple[Column, Column]:
    """(question type, question text) drawn by key."""
    index = draw_index(len(K.USER_QUESTIONS), key, "question")
    kinds, texts = zip(*K.USER_QUESTIONS)
    return pick(kinds, index), fill(pick(texts, index), ticker=ticker)


def answer(kind: Column, recommendation: Column, ticker: Column) -> Column:
    pairs = [
        part
        for question, by_call in K.ANSWER_TEMPLATES.items()
        for call, text in by_call.items()
        for part in (F.lit(f"{question}|{call}"), F.lit(text))
    ]
    return fill(F.try_element_at(F.create_map(*pairs), F.concat_ws("|", kind, recommendation)), ticker=ticker)


def fallback_reasoning(ticker: Column, reaction: Column, recommendation: Column) -> Column:
    phrases = [part for name, text in K.REACTION_PHRASES.items() for part in (F.lit(name), F.lit(text))]
    phrase = F.try_element_at(F.create_map(*phrases), reaction)
    return fill(F.lit(K.FALLBACK_REASONING), ticker=ticker, phrase=phrase, recommendation=recommendation)


def quality_tier(margin: Column, roe: Column) -> Column:
    """Tier of margin and ROE, null when either is missing."""
    return (
        F.when(margin.isNull() | roe.isNull(), F.lit(None))
        .when((margin > K.OPERATING_MARGIN_STRONG) & (roe > K.ROE_STRONG), "strong")
        .when((margin < K.OPERATING_MARGIN_WEAK) | (roe < K.ROE_WEAK), "weak")
        .otherwise("adequate")
    )


def growth_tier(peg: Column) -> Column:
    return (
        F.when(peg.isNull(), "unknown").when(peg < K.PEG_CHEAP, "cheap").when(peg > K.PEG_RICH, "rich").otherwise("fair")
    )


def _phrase(table: dict, tier: Column, key: Column, salt: str) -> Column:
    chain = None
    for name, texts in table.items():
        text = pick(texts, draw_index(len(texts), key, salt))
        chain = F.when(tier == name, text) if chain is None else chain.when(tier == name, text)
    return chain


def value_commentary(margin: Column, roe: Column, peg: Column, key: Column) -> Column:
    """One or two clauses on quality and growth-adjusted price, null when quality is unknown."""
    quality = _phrase(K.QUALITY_PHRASES, quality_tier(margin, roe), key, "quality")
    growth = _phrase(K.GROWTH_PHRASES, growth_tier(peg), key, "growth")
    connector = pick(K.COMMENTARY_CONNECTORS, draw_index(len(K.COMMENTARY_CONNECTORS), key, "connector"))
    return F.concat(quality, connector, growth, F.lit("."))


def clause_kind(reaction: Column, bucket: Column, recommendation: Column) -> Column:
    """How the valuation relates to the reaction's own lean."""
    leans = [(name, lean) for name, lean in K.REACTION_LEAN.items() if lean]
    lean = None
    for name, direction in leans:
        lean = F.when(reaction == name, direction) if lean is None else lean.when(reaction == name, direction)
    return (
        F.when(bucket.isin("no_data", "near_fair"), bucket)
        .when(lean.isNull(), "driving")
        .when(lean == recommendation, "reinforcing")
        .otherwise("capping")
    )


def fusion_clause(
    ticker: Column, reaction: Column, bucket: Column, recommendation: Column, gap_pct: Column, key: Column
) -> Column:
    text = _phrase(K.FUSION_CLAUSES, clause_kind(reaction, bucket, recommendation), key, "clause")
    percent = F.coalesce(F.rint(F.abs(gap_pct)).cast("long").cast("string"), F.lit(""))
    return fill(text, ticker=ticker, bucket_word=bucket, pct=percent, recommendation=recommendation)


def prompt(task: Column, end_token: str = "</s>") -> Column:
    """Prompt and response of one row by its task; an unknown task raises."""

    def built(template: str, *names: str) -> Column:
        pieces = template.split("%s")
        parts = [F.lit(pieces[0])]
        for name, piece in zip(names, pieces[1:]):
            parts += [F.coalesce(F.col(name), F.lit("")), F.lit(piece)]
        return F.concat(*parts, F.lit(end_token))

    reaction = built(K.REACTION_PROMPT, "ticker", "price_context", "news", "output")
    analysis = built(
        K.ANALYSIS_PROMPT, "ticker", "user_query", "news_reaction", "market_data", "valuation", "earnings", "news", "output"
    )
    unknown = F.raise_error(F.concat(F.lit("unknown task: "), F.coalesce(task, F.lit("null")))).cast("string")
    return F.when(task == "reaction", reaction).when(task == "analysis", analysis).otherwise(unknown)
