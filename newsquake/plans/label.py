"""Market reaction per (entity, publish date), and its attachment to headlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions.numeric import present
from newsquake.functions.reaction import classify_reaction
from newsquake.operators.asof import AsOf, asof_lookup, distinct_days
from newsquake.operators.lookup import skew_safe_join


def trading_bars(prices: DataFrame, ahead: int = K.LOOK_AHEAD_BARS) -> DataFrame:
    """Each trading day with its ordinal, the previous close and the close some bars ahead.

    An entity has one bar per calendar day at most, which bounds the window's group.
    """
    axis = Window.partitionBy("ticker").orderBy("trade_date")
    return prices.select(
        "ticker",
        "trade_date",
        "close",
        F.row_number().over(axis).alias("bar_no"),
        F.lag("trade_date").over(axis).alias("prev_date"),
        F.lag("close").over(axis).alias("prev_close"),
        F.lead("trade_date", ahead).over(axis).alias("ahead_date"),
        F.lead("close", ahead).over(axis).alias("ahead_close"),
    )


def reaction_lookups(bars: DataFrame, earnings: DataFrame | None) -> list[AsOf]:
    """Day 0 of a date, and the next earnings event after its midnight.

    The event carries the ordinal of the first trading day on or after its own date, which puts
    it on the trading-day axis.
    """
    day0 = ["trade_date", "close", "bar_no", "prev_date", "prev_close", "ahead_date", "ahead_close"]
    lookups = [AsOf("day0", bars, "trade_date", day0, direction="forward")]
    if earnings is not None:
        lookups.append(
            AsOf(
                "event", earnings, "event_ts", ["event_ts"], direction="forward", inclusive=False,
                carry={"event_bar": "day0.bar_no"},
            )
        )
    return lookups


def measured_columns(
    found: DataFrame, pre_days: int = K.PRE_PUBLISH_DAYS, post_days: int = K.POST_PUBLISH_DAYS
) -> dict[str, Column]:
    """Moves around the date and the reason there are none, from the two lookups above."""
    event_bar = F.col("event.event_bar") if "event" in found.columns else F.lit(None).cast("int")
    horizon = F.date_add("as_of", post_days)
    usable = (
        (F.col("day0.trade_date") < horizon)
        & (F.col("day0.prev_date") >= F.date_sub("as_of", pre_days))
        & present(F.col("day0.prev_close")).isNotNull()
    )
    bars_to_event = event_bar - F.col("day0.bar_no")
    reason = F.when(~F.coalesce(usable, F.lit(False)), "insufficient_history").when(
        bars_to_event <= K.EARNINGS_SKIP_BARS, "earnings_within_1d"
    )
    base = F.when(reason.isNull(), F.col("day0.prev_close"))
    ahead = F.when(F.col("day0.ahead_date") < horizon, F.col("day0.ahead_close"))
    return {
        "day0_date": F.col("day0.trade_date"),
        "bars_to_event": bars_to_event,
        "move_1d": (F.col("day0.close") - base) / base,
        "move_21d": (ahead - base) / base,
        "assessable": reason.isNull() & F.coalesce(bars_to_event > K.EARNINGS_UNASSESSABLE_BARS, F.lit(True)),
        "skip_reason": reason,
    }


def measure_days(
    days: DataFrame,
    prices: DataFrame,
    earnings: DataFrame | None = None,
    pre_days: int = K.PRE_PUBLISH_DAYS,
    post_days: int = K.POST_PUBLISH_DAYS,
) -> DataFrame:
    """Moves around each distinct (ticker, as_of) date, or the reason there are none."""
    found = asof_lookup(days, "ticker", "as_of", reaction_lookups(trading_bars(prices), earnings))
    columns = measured_columns(found, pre_days, post_days)
    return found.select(*days.columns, *[c.alias(name) for name, c in columns.items()])


def label_days(measured: DataFrame, x=K.GOOD_BAD_THRESHOLD, y=K.OVERREACTION_THRESHOLD, z=K.RETRACEMENT_FRACTION) -> DataFrame:
    label = classify_reaction(F.col("move_1d"), F.col("move_21d"), F.col("assessable"), x, y, z)
    return measured.withColumn("news_reaction", label)


def attach_labels(headlines: DataFrame, labels: DataFrame) -> DataFrame:
    """Headlines with the label of their (ticker, publish date); a null date is its own reason."""
    dated = headlines.withColumn("as_of", F.to_date("published_at"))
    joined = skew_safe_join(dated, labels, ["ticker", "as_of"], ["feed_pos"], "left")
    reason = F.when(F.col("as_of").isNull(), "no_date").otherwise(F.col("skip_reason"))
    return joined.withColumn("skip_reason", reason)


def label_headlines(headlines: DataFrame, prices: DataFrame, earnings: DataFrame | None = None, **thresholds) -> DataFrame:
    """JOB-LABEL: each headline with reaction, moves and skip reason."""
    days = distinct_days(headlines, "ticker", "published_at")
    return attach_labels(headlines, label_days(measure_days(days, prices, earnings), **thresholds))


def reaction_counts(headlines: DataFrame, prices: DataFrame, earnings: DataFrame | None = None, **thresholds) -> DataFrame:
    """Headlines per class and reason, counted per (ticker, date) before anything is joined."""
    per_day = headlines.groupBy("ticker", F.to_date("published_at").alias("as_of")).agg(F.count(F.lit(1)).alias("n"))
    days = per_day.where(F.col("as_of").isNotNull()).select("ticker", "as_of")
    labels = label_days(measure_days(days, prices, earnings), **thresholds)
    reason = F.when(F.col("as_of").isNull(), "no_date").otherwise(F.col("skip_reason"))
    return (
        per_day.join(labels, ["ticker", "as_of"], "left")
        .groupBy(F.coalesce("news_reaction", reason).alias("outcome"))
        .agg(F.sum("n").alias("headlines"))
    )
