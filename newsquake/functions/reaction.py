"""Reaction classes and the fusion of reaction and valuation."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions.numeric import ratio


def _as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def retraced(move_1d: Column, move_21d: Column) -> Column:
    """Share of the first day's move given back by the later close."""
    down = ratio(move_21d - move_1d, F.abs(move_1d))
    up = ratio(move_1d - move_21d, move_1d)
    return F.when(move_1d < 0, down).when(move_1d > 0, up)


def classify_reaction(
    move_1d: Column,
    move_21d: Column,
    assessable: Column,
    x=K.GOOD_BAD_THRESHOLD,
    y=K.OVERREACTION_THRESHOLD,
    z=K.RETRACEMENT_FRACTION,
) -> Column:
    """One of the five classes; every comparison is inclusive and a null move_1d gives null."""
    x, y, z = _as_column(x), _as_column(y), _as_column(z)
    given_back = assessable & move_21d.isNotNull() & (retraced(move_1d, move_21d) >= z)
    return (
        F.when(move_1d.isNull(), F.lit(None).cast("string"))
        .when((move_1d <= -y) & given_back, "overreaction_down")
        .when((move_1d >= y) & given_back, "overreaction_up")
        .when(move_1d >= x, "good")
        .when(move_1d <= -x, "bad")
        .otherwise("neutral")
    )


def valuation_bucket(gap_pct: Column, threshold: float = K.BUCKET_THRESHOLD_PCT) -> Column:
    return (
        F.when(gap_pct.isNull(), "no_data")
        .when(gap_pct <= -threshold, "undervalued")
        .when(gap_pct >= threshold, "overvalued")
        .otherwise("near_fair")
    )


def text_gap(gap_pct: Column) -> Column:
    """The gap as it reads once rendered: whole percent, capped, null under one percent."""
    magnitude = F.when(F.abs(gap_pct) > K.VALUATION_DISPLAY_CAP_PCT, K.VALUATION_DISPLAY_CAP_PCT).otherwise(
        F.rint(F.abs(gap_pct))
    )
    return F.when(F.abs(gap_pct) >= 1.0, F.when(gap_pct >= 0, magnitude).otherwise(-magnitude))


def _fusion_lookup(part: str) -> Column:
    """The fusion table as one constant map from 'reaction|bucket'."""
    index = {"recommendation": 2, "confidence": 3}[part]
    pairs = chain.from_iterable((F.lit(f"{row[0]}|{row[1]}"), F.lit(row[index])) for row in K.FUSION_ROWS)
    return F.create_map(*pairs)


def fuse(
    df: DataFrame, reaction: str = "news_reaction", gap: str = "gap_pct", skip_unlabelled: bool = False
) -> DataFrame:
    """Adds valuation_bucket, recommendation and confidence; an unknown reaction raises.

    The 20-row table is a constant map, so the lookup is a projection: no join, no broadcast.
    With skip_unlabelled, rows that carry no reaction at all get nulls instead of an error.
    """
    labelled = F.col(reaction).isNotNull() if skip_unlabelled else F.lit(True)
    cell = F.concat_ws("|", F.col(reaction), F.col("valuation_bucket"))
    unknown = F.raise_error(F.concat(F.lit("unknown news reaction: "), F.coalesce(F.col(reaction), F.lit("null"))))
    base = F.try_element_at(_fusion_lookup("confidence"), cell)
    magnitude = F.least(F.abs(F.col(gap)) / K.CONFIDENCE_SPAN_PCT, F.lit(1.0))
    raised = F.least(F.lit(K.CONFIDENCE_CAP), base + K.CONFIDENCE_BONUS * magnitude)
    return (
        df.withColumn("valuation_bucket", F.when(labelled, valuation_bucket(F.col(gap))))
        .withColumn(
            "recommendation",
            F.when(
                labelled,
                F.coalesce(F.try_element_at(_fusion_lookup("recommendation"), cell), unknown.cast("string")),
            ),
        )
        .withColumn(
            "confidence",
            F.when(labelled, F.round(F.when(F.col("valuation_bucket") == "no_data", base).otherwise(raised), 2)),
        )
    )
