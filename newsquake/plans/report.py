"""JOB-REPORT: review lists, valuation ranking and as-of checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake.functions import render
from newsquake.functions.text import field_text
from newsquake.plans.value import value_days

RULE = "-" * 100
HEADER_RULE = "#" * 100
HEADING_RULE = "=" * 100


def split_summary(rows: DataFrame) -> DataFrame:
    """Row counts by split and the number of distinct tickers."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "val").alias("val"),
        F.countDistinct("ticker").alias("tickers"),
    )


def review_entry() -> Column:
    """The review text of one stored row; an unknown task raises."""
    output = F.from_json("output", "news_reaction string, recommendation string, reasoning string, answer string")
    head = F.concat(F.lit("--- ["), F.col("split"), F.lit("] "), F.col("ticker"), F.lit(" ("), F.col("task"), F.lit(") ---\n"))
    reaction = F.concat(
        F.lit("News:\n"), F.col("news"), F.lit("\n\nNews reaction (dataset label): "), output["news_reaction"], F.lit("\n")
    )
    analysis = F.concat(
        F.lit("User Question: "), F.col("user_query"),
        F.lit("\n\nMarket Data:\n"), F.col("market_data"),
        F.lit("\n\nValuation:\n"), F.col("valuation"),
        F.lit("\n\nEarnings:\n"), F.col("earnings"),
        F.lit("\n\nNews:\n"), F.col("news"),
        F.lit("\n\nRecommendation (dataset label): "), F.col("recommendation"),
        F.lit("\nReasoning (dataset label): "), output["reasoning"],
        F.lit("\nAnswer (dataset label): "), output["answer"], F.lit("\n"),
    )
    unknown = F.raise_error(F.concat(F.lit("unknown task: "), F.coalesce("task", F.lit("null")))).cast("string")
    body = F.when(F.col("task") == "reaction", reaction).when(F.col("task") == "analysis", analysis).otherwise(unknown)
    return F.concat(head, body, F.lit(f"\n{RULE}\n"))


def review_list(rows: DataFrame, row_order: str) -> DataFrame:
    """(ticker, place, split, row_order, value): one header per ticker, then its rows by split.

    Headers come from the distinct tickers, so no ticker is gathered to find its first row, and
    the final sort spreads a large ticker over many range partitions.
    """
    header = F.concat(F.lit(f"\n{HEADER_RULE}\n# TICKER: "), F.col("ticker"), F.lit(f"\n{HEADER_RULE}\n"))
    headers = rows.select("ticker").distinct().select(
        "ticker", F.lit(0).alias("place"), F.lit("").alias("split"), F.lit(None).cast("string").alias(row_order), header.alias("value")
    )
    entries = rows.select(
        "ticker", F.lit(1).alias("place"), "split", F.col(row_order).cast("string").alias(row_order), review_entry().alias("value")
    )
    return headers.unionByName(entries)


def review_heading(rows: DataFrame, label: str) -> DataFrame:
    """The line over a review list, with totals; one row, also over no rows."""
    totals = split_summary(rows)
    return totals.select(
        F.format_string(
            f"%s dataset review list: %d total rows (%d train, %d val), grouped by ticker.\n{HEADING_RULE}\n",
            F.lit(label.upper()), "total", "train", "val",
        ).alias("value")
    )


def review_text(rows: DataFrame, row_order: str, label: str) -> DataFrame:
    """Heading and sorted review list, in order: the totals are counted in a pass of their own, before the entries."""
    heading = review_heading(rows, label).select(
        F.lit(None).cast("string").alias("ticker"), F.lit(-1).alias("place"), F.lit("").alias("split"), F.lit(None).cast("string").alias(row_order), "value"
    )
    numeric = F.col(row_order).try_cast("decimal(38,0)")
    every = heading.unionByName(review_list(rows, row_order))
    return every.orderBy(F.col("place") >= 0, "ticker", "place", "split", numeric, row_order).select("value")


def valuation_report(entities: DataFrame, texts: DataFrame, written_on: Column) -> DataFrame:
    """(place, pct, ticker, value): the lines of a ranked valuation report, to be ordered by report_text.

    place 0 is the heading with the number of entities, 1 a table line per entity, 2 the heading of the details, 3 the
    full texts per entity. entities: one row per (ticker, name); texts: one row per ticker with market_data, valuation
    and earnings. What a text does not tell is N/A; an entity without texts gets ERROR for its price and dashes.
    """
    typed = entities.select("ticker", "name").join(typed_from_text(texts).withColumn("there", F.lit(True)), "ticker", "left")
    there = F.col("there").isNotNull()
    told = lambda c: F.when(there, F.coalesce(c, F.lit("N/A"))).otherwise("-")
    cells = [
        F.col("ticker"),
        F.col("name"),
        F.when(there, F.coalesce("price", F.lit("N/A"))).otherwise("ERROR"),
        F.concat(told(F.col("intrinsic")), F.lit(" ("), told(F.col("basis")), F.lit(")")),
        told(F.concat("verdict", F.lit(" "), "pct", F.lit("%"))),
        told(F.col("sector")),
        F.concat(told(F.col("pe_trailing")), F.lit("/"), told(F.col("pe_forward"))),
    ]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    blocks = [("Market Data", "market_data", "no texts for this entity"), ("Valuation", "valuation", "-"), ("Earnings", "earnings", "-")]
    fenced = [F.concat(F.lit(f"**{title}:**\n```\n"), F.coalesce(text, F.lit(none)), F.lit("\n```\n")) for title, text, none in blocks]
    detail = F.concat(F.lit("### "), "ticker", F.lit(" ("), "name", F.lit(")\n\n"), F.concat_ws("\n", *fenced))
    # both lines of an entity come from the same row, so the entities are valued once
    parts = F.array(F.struct(F.lit(1).alias("place"), line.alias("value")), F.struct(F.lit(3).alias("place"), detail.alias("value")))
    pct = F.coalesce(F.col("pct").cast("int"), F.lit(0))
    lines = typed.select("ticker", pct.alias("pct"), F.explode(parts).alias("part")).select("part.place", "pct", "ticker", "part.value")
    heading = F.concat(
        F.format_string("# Valuation report - all %d tickers\n\nGenerated %s. Sorted by |mispricing %%|, largest first.\n\n", F.count(F.lit(1)), F.first(written_on.cast("string"))),
        F.lit("| Ticker | Name | Price | Intrinsic (basis) | Gap | Sector | P/E (T/F) |\n|---|---|---|---|---|---|---|"),
    )
    top = entities.agg(F.lit(0).alias("place"), F.lit(0).alias("pct"), F.lit("").alias("ticker"), heading.alias("value"))
    middle = entities.sparkSession.createDataFrame([(2, 0, "", "\n---\n\n## Full detail per ticker\n")], "place int, pct int, ticker string, value string")
    return top.unionByName(middle).unionByName(lines)


def report_text(lines: DataFrame) -> DataFrame:
    """The report's text in order, largest mispricing first, then by ticker."""
    return lines.orderBy("place", F.col("pct").desc(), "ticker").select("value")


def valuation_ranking(valued: DataFrame) -> DataFrame:
    """One typed row per entity, largest mispricing first; rows without a direction rank as 0."""
    gap = F.col("gap_pct")
    shown = F.when(F.abs(gap) >= 1, F.least(F.rint(F.abs(gap)), F.lit(150.0)))
    verdict = F.when(shown.isNotNull(), F.when(gap >= 0, "overvalued").otherwise("undervalued"))
    return valued.select(
        "ticker", "as_of", "price", "pe_trailing", "pe_forward", "sector", "basis", "intrinsic", "gap_pct",
        verdict.alias("verdict"), shown.alias("shown_pct"),
    ).orderBy(F.coalesce("shown_pct", F.lit(0.0)).desc(), "ticker")


def typed_from_text(rows: DataFrame) -> DataFrame:
    """Price, P/E, basis, intrinsic value and verdict back from rendered text of old rows."""
    gap = r"Intrinsic Value \(([^)]+)\): \$([\d,.]+)\nvs Current Price: (overvalued|undervalued) by [~>](\d+)%"
    number = r"Price: \$([\d,.]+)"
    multiple = r"P/E \(trailing\): ([\d.]+|N/A) \| P/E \(forward\): ([\d.]+|N/A)"
    sector = r"Sector Median P/E: [\d.]+ \(([^)]+)\)"

    def part(text: str, pattern: str, group: int) -> Column:
        return F.when(F.col(text).rlike(pattern), F.regexp_extract(text, pattern, group))

    return rows.withColumns(
        {
            "price": field_text(F.col("market_data"), number),
            "pe_trailing": part("market_data", multiple, 1),
            "pe_forward": part("market_data", multiple, 2),
            "sector": part("market_data", sector, 1),
            "basis": part("valuation", gap, 1),
            "intrinsic": part("valuation", gap, 2),
            "verdict": part("valuation", gap, 3),
            "pct": part("valuation", gap, 4),
        }
    )


def spot_check(pairs: DataFrame, stored: DataFrame, tables) -> DataFrame:
    """Blocks recomputed for given (ticker, as_of) pairs beside the stored ones, with a verdict each."""
    valued = value_days(
        pairs.select("ticker", "as_of").distinct(), tables.prices, tables.quarterly, tables.earnings,
        tables.fundamentals, tables.sectors,
    )
    names = ("market_data", "valuation", "earnings")
    fresh = render.blocks(valued).select("ticker", "as_of", *[F.col(n).alias(f"recomputed_{n}") for n in names])
    compared = stored.join(fresh, ["ticker", "as_of"])
    return compared.withColumns({f"{n}_matches": F.col(n).eqNullSafe(F.col(f"recomputed_{n}")) for n in names})
