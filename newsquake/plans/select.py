"""JOB-SELECT: which headlines of each entity and week are worth labelling, and why others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions.text import (
    is_low_content,
    is_low_quality_publisher,
    is_relevant,
    name_needle,
    word_pattern,
)
from newsquake.operators.lookup import skew_safe_join
from newsquake.operators.ranking import top_k

ATTEMPT_ORDER = ("order_1", "order_2", "feed_pos")


def window_index(day: Column, end: Column, weeks: int = K.LOOKBACK_WEEKS) -> Column:
    """1-based weekly window of a date, most recent first; null outside the weeks searched and without a date."""
    index = F.ceil(F.datediff(end, day) / F.lit(7)).cast("int")
    return F.when((index >= 1) & (index <= weeks), index)


def outside_windows(headlines: DataFrame) -> DataFrame:
    """Headlines without a window, each with the reason: no date, or a date outside the weeks searched."""
    reason = F.when(F.col("published_at").isNull(), "no_date").otherwise("outside_windows")
    return headlines.where(F.col("window_idx").isNull()).select(
        "ticker", "window_idx", "feed_pos", "title", "publisher", "published_at",
        F.lit("none").alias("path"), reason.alias("skip_reason"),
        F.lit(0).cast("long").alias("order_1"), F.lit(0).cast("long").alias("order_2"),
    )


def first_seen(headlines: DataFrame) -> DataFrame:
    """First row per (ticker, title), most recent window first; copies are merged before the shuffle.

    Headlines without a window are not searched, see outside_windows.
    """
    first = F.min(F.struct("window_idx", "feed_pos", "publisher", "published_at")).alias("f")
    return headlines.where(F.col("window_idx").isNotNull()).groupBy("ticker", "title").agg(first).select("ticker", "title", "f.*")


def entity_patterns(entities: DataFrame, sectors: DataFrame) -> DataFrame:
    """(ticker, needle_pattern, ticker_pattern, keyword_pattern), null where a tier does not apply."""
    needle = name_needle(F.coalesce("name", F.lit("")))
    # The sector table has one row per known sector, a fixed handful.
    keywords = sectors.select("sector", "keyword_pattern")
    return (
        entities.withColumn("_needle", needle)
        .join(keywords, "sector", "left")
        .select(
            "ticker",
            F.when(F.col("_needle") != "", word_pattern(F.col("_needle"))).alias("needle_pattern"),
            word_pattern(F.col("ticker")).alias("ticker_pattern"),
            "keyword_pattern",
        )
    )


def regex_reason(df: DataFrame) -> DataFrame:
    """skip_reason of the rule-based path, first match wins; needs the entity patterns as columns."""
    relevant = is_relevant(
        F.col("title"), F.col("needle_pattern"), F.col("ticker_pattern"), F.col("keyword_pattern")
    )
    reason = (
        F.when(is_low_quality_publisher(F.col("publisher")), "low_quality_publisher")
        .when(is_low_content(F.col("title")), "low_content_headline")
        .when(~relevant, "not_relevant")
    )
    return df.withColumn("skip_reason", reason)


def screened_pool(unseen: DataFrame, assessments: DataFrame, pool: int = K.SCREEN_POOL) -> DataFrame:
    """The first rows of each window with their assessment, and whether the window is fully covered.

    Each group is at most the pool size, because the rank filter runs before it is gathered.
    """
    pooled = top_k(unseen, ["ticker", "window_idx"], [F.col("feed_pos")], pool, "pool_rank")
    # Of conflicting assessments the least row counts, whichever arrives first.
    told = [c for c in assessments.columns if c not in ("ticker", "feed_pos")]
    one = assessments.groupBy("ticker", "feed_pos").agg(F.min(F.struct(*told)).alias("told")).select("ticker", "feed_pos", "told.*")
    assessed = pooled.join(one, ["ticker", "feed_pos"], "left")
    window = Window.partitionBy("ticker", "window_idx")
    covered = F.min(F.col("importance").isNotNull() & F.col("relevant").isNotNull()).over(window)
    return assessed.withColumn("covered", covered)


def select_headlines(
    headlines: DataFrame,
    assessments: DataFrame,
    entities: DataFrame,
    sectors: DataFrame,
) -> DataFrame:
    """Every considered headline with its path, skip_reason (null when selected) and attempt order.

    A window whose pool is fully assessed takes the screen path: pool only, by importance, then
    recency. Any other window takes the rule path: all of its headlines, in feed order. Headlines
    without a window are listed with their reason.
    """
    unseen = first_seen(headlines)
    pool = screened_pool(unseen, assessments)
    importance = F.least(F.lit(5), F.greatest(F.lit(1), F.col("importance")))
    screen = pool.where("covered").select(
        "ticker", "window_idx", "feed_pos", "title", "publisher", "published_at",
        F.lit("screen").alias("path"),
        F.when(~F.col("relevant"), "screen_not_relevant")
        .when(importance < K.IMPORTANCE_THRESHOLD, "screen_unimportant")
        .alias("skip_reason"),
        (-importance).cast("long").alias("order_1"),
        F.coalesce(-F.unix_micros(F.col("published_at").cast("timestamp")), F.lit(2**62)).alias("order_2"),
    )
    open_windows = (
        pool.where(~F.col("covered")).select("ticker", "window_idx").distinct()
        .join(entity_patterns(entities, sectors), "ticker")
    )
    candidates = skew_safe_join(unseen, open_windows, ["ticker", "window_idx"], ["feed_pos"], "inner")
    ruled = regex_reason(candidates).select(
        "ticker", "window_idx", "feed_pos", "title", "publisher", "published_at",
        F.lit("regex").alias("path"),
        "skip_reason",
        F.lit(0).cast("long").alias("order_1"),
        F.lit(0).cast("long").alias("order_2"),
    )
    return screen.unionByName(ruled).unionByName(outside_windows(headlines))


def keep_within_caps(
    labelled: DataFrame, per_window: int = K.MAX_PER_WINDOW, per_entity: int = K.MAX_PER_ENTITY
) -> DataFrame:
    """Labelled rows within both caps, best first; only rows with a label count."""
    usable = labelled.where(F.col("news_reaction").isNotNull())
    order = [F.col(c) for c in ATTEMPT_ORDER]
    in_window = top_k(usable, ["ticker", "window_idx"], order, per_window, "rank_in_window")
    return top_k(in_window, ["ticker"], [F.col("window_idx"), *order], per_entity, "rank_in_entity")


def attempted_skips(
    selected: DataFrame,
    labelled: DataFrame,
    kept: DataFrame,
    per_window: int = K.MAX_PER_WINDOW,
    per_entity: int = K.MAX_PER_ENTITY,
) -> DataFrame:
    """(ticker, skip_reason, n) as counted by a run that stops at the caps.

    Nothing after the window in which the entity cap is reached is looked at, and inside a window
    nothing after its last kept row once a cap is reached.
    """
    order = F.struct(*ATTEMPT_ORDER)
    stops = kept.groupBy("ticker", "window_idx").agg(
        F.count(F.lit(1)).alias("_kept"), F.max(order).alias("_last"), F.max("rank_in_entity").alias("_upto")
    )
    ends = stops.where(F.col("_upto") == per_entity).select("ticker", F.col("window_idx").alias("_end"))
    full = (
        stops.join(ends, "ticker", "left")
        .where((F.col("_kept") == per_window) | (F.col("window_idx") == F.col("_end")))
        .select("ticker", "window_idx", F.col("_last").alias("_stop"))
    )
    rejected = selected.where(F.col("skip_reason").isNotNull()).select(
        "ticker", "window_idx", "feed_pos", "skip_reason", F.lit(None).cast("struct<order_1:bigint,order_2:bigint,feed_pos:bigint>").alias("_at")
    )
    failed = labelled.where(F.col("skip_reason").isNotNull()).select(
        "ticker", "window_idx", "feed_pos", "skip_reason", order.alias("_at")
    )
    fallback = selected.where(F.col("path") == "regex").select("ticker", "window_idx").distinct()
    windows = fallback.select(
        "ticker", "window_idx", F.lit(0).cast("long").alias("feed_pos"), F.lit("screen_fallback_windows").alias("skip_reason"),
        F.lit(None).cast("struct<order_1:bigint,order_2:bigint,feed_pos:bigint>").alias("_at"),
    )
    events = rejected.unionByName(failed).unionByName(windows)
    bounded = skew_safe_join(events, ends, ["ticker"], ["feed_pos", "window_idx"], "left")
    looked_at = skew_safe_join(
        bounded.where(F.col("_end").isNull() | (F.col("window_idx") <= F.col("_end"))),
        full, ["ticker", "window_idx"], ["feed_pos"], "left",
    )
    before_stop = F.col("_at").isNull() | F.col("_stop").isNull() | (F.col("_at") < F.col("_stop"))
    return looked_at.where(before_stop).groupBy("ticker", "skip_reason").agg(F.count(F.lit(1)).alias("n"))


def skip_totals(reasons: DataFrame) -> DataFrame:
    """Reason counts per entity and, with a null ticker, over all entities."""
    pairs = reasons.where(F.col("skip_reason").isNotNull())
    return (
        pairs.groupingSets([["ticker", "skip_reason"], ["skip_reason"]], "ticker", "skip_reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("ticker", "skip_reason", "n")
    )


def top_headlines(fused: DataFrame, k: int = 3) -> DataFrame:
    """Up to k best headlines per (ticker, window), each with its reaction; the first one anchors the call."""
    order = [F.col(c) for c in ATTEMPT_ORDER]
    best = top_k(fused.where(F.col("news_reaction").isNotNull()), ["ticker", "window_idx"], order, k)
    item = F.struct("rank", "title", "news_reaction")
    return best.groupBy("ticker", "window_idx").agg(
        F.array_sort(F.collect_list(item)).alias("headlines"),
        F.max(F.when(F.col("rank") == 1, F.col("recommendation"))).alias("recommendation"),
    )
