"""JOB-FUSE: label and valuation joined per (entity, date), then fused and attached to headlines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsquake.functions.reaction import fuse, text_gap
from newsquake.operators.asof import asof_lookup, distinct_days
from newsquake.plans.label import attach_labels, label_days, measured_columns, reaction_lookups, trading_bars
from newsquake.plans.value import fact_columns, fact_lookups, value_facts


def signal_days(days: DataFrame, tables, gap_mode: str = "text", **thresholds) -> DataFrame:
    """Reaction, valuation and recommendation per distinct (ticker, as_of) row.

    Both halves depend on the date only, so all seven lookups share one shuffle of one row per
    entity and day. gap_mode
    'text' fuses the gap as rendered (whole percent, capped, null under one percent), 'raw' the
    exact one.
    """
    if gap_mode not in ("text", "raw"):
        raise ValueError(f"gap_mode must be 'text' or 'raw', not {gap_mode!r}")
    bars = trading_bars(tables.prices)
    lookups = reaction_lookups(bars, tables.earnings) + fact_lookups(bars, tables.quarterly, tables.earnings)
    found = asof_lookup(days, "ticker", "as_of", lookups)
    columns = {**measured_columns(found), **fact_columns()}
    facts = label_days(found.select(*days.columns, *[c.alias(name) for name, c in columns.items()]), **thresholds)
    values = value_facts(facts, tables.fundamentals, tables.sectors)
    gap = text_gap(F.col("gap_pct")) if gap_mode == "text" else F.col("gap_pct")
    return fuse(values.withColumn("fused_gap_pct", gap), "news_reaction", "fused_gap_pct", skip_unlabelled=True)


def fuse_headlines(headlines: DataFrame, tables, gap_mode: str = "text", **thresholds) -> DataFrame:
    """Each headline with its reaction, valuation and recommendation; skipped ones keep their reason."""
    days = distinct_days(headlines, "ticker", "published_at")
    return attach_labels(headlines, signal_days(days, tables, gap_mode, **thresholds))
