"""JOB-CONVERT: old analysis rows re-labelled, re-fused and kept only when consistent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions import render
from newsquake.functions.reaction import fuse
from newsquake.operators.lookup import computed_once
from newsquake.plans.label import label_headlines
from newsquake.schemas import OLD_OUTPUT, ROW_FIELDS


def signal_date(news: Column, noise=K.NOISE_HEADLINES) -> Column:
    """Date of the one line that is not a known noise headline; null for none or several."""
    lines = F.split(news, r"\r\n|\r|\n")
    known = F.array(*[F.lit(title) for title in noise])
    own = F.filter(
        lines,
        lambda line: line.rlike(K.NEWS_LINE_PATTERN)
        & ~F.array_contains(known, F.regexp_extract(line, K.NEWS_LINE_PATTERN, 2)),
    )
    # Bound to a variable, as the lines would else be matched once for the number and again for the line.
    single = F.element_at(F.transform(F.array(own), lambda rows: F.when(F.size(rows) == 1, F.element_at(rows, 1))), 1)
    return render.parse_dated(F.regexp_extract(single, K.NEWS_LINE_PATTERN, 1))


def convert_rows(old_rows: DataFrame, prices: DataFrame, earnings: DataFrame | None, key: str = "row_id") -> DataFrame:
    """Every old row with its new fields and drop_reason (null when it converts).

    Each check is a column; the row is dropped by the first that fails. The stored recommendation
    must equal the one fused from the recomputed reaction and the gap in the stored text.
    """
    parsed = F.from_json("output", OLD_OUTPUT, {"mode": "PERMISSIVE"})
    first = F.try_element_at(F.col("_old.impacted_stocks"), F.lit(1))
    read = computed_once(
        old_rows.withColumn("_old", parsed),
        {
            "_first": first,
            "published_at": signal_date(F.col("news")).cast("timestamp"),
            "gap_pct": render.gap_from_text(F.col("valuation")),
        },
    ).withColumnRenamed(key, "feed_pos")
    labelled = label_headlines(read, prices, earnings).withColumnRenamed("skip_reason", "_label_reason")
    fused = render.price_context(fuse(labelled, skip_unlabelled=True))
    unparseable = (
        F.col("_first.recommendation").isNull() | F.col("_first.reasoning").isNull() | F.col("_first.answer").isNull()
    )
    reason = (
        F.when(unparseable, "unparseable_output")
        .when(F.col("published_at").isNull(), "unresolvable_headline")
        .when(F.col("news_reaction").isNull(), F.concat(F.lit("relabel_failed:"), F.col("_label_reason")))
        .when(F.col("recommendation") != F.col("_first.recommendation"), "recommendation_mismatch")
    )
    output = F.to_json(
        F.struct("recommendation", F.col("_first.reasoning").alias("reasoning"), F.col("_first.answer").alias("answer"))
    )
    return (
        fused.withColumns({"drop_reason": reason, "task": F.lit("analysis"), "output": output})
        .withColumnRenamed("feed_pos", key)
        .select(key, "drop_reason", *ROW_FIELDS)
    )


def converted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("drop_reason").isNull()).drop("drop_reason")


def drop_counts(checked: DataFrame) -> DataFrame:
    """Rows per outcome; 'converted' for those that pass."""
    return checked.groupBy(F.coalesce("drop_reason", F.lit("converted")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
