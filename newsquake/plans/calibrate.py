"""JOB-CALIBRATE: return distributions and the threshold grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions.reaction import retraced
from newsquake.operators.ranking import nearest_rank
from newsquake.plans.label import measure_days


def weekly_windows(df: DataFrame, as_of: Column, weeks: int = K.LOOKBACK_WEEKS, buffer: int = K.POST_PUBLISH_DAYS) -> DataFrame:
    """df times its weekly windows (window_idx, after, before), most recent first."""
    end = F.date_sub(as_of, buffer)
    return df.withColumn("window_idx", F.explode(F.sequence(F.lit(1), F.lit(weeks)))).withColumns(
        {
            "after": F.date_sub(end, F.col("window_idx") * 7),
            "before": F.date_sub(end, F.col("window_idx") * 7 - 7),
        }
    )


def reaction_samples(
    entities: DataFrame, prices: DataFrame, earnings: DataFrame, as_of: Column, weeks: int = K.LOOKBACK_WEEKS
) -> DataFrame:
    """One measured anchor per entity and weekly window, skipped ones with their reason."""
    anchors = weekly_windows(entities.select("ticker"), as_of, weeks)
    return measure_days(anchors.select("ticker", F.col("after").alias("as_of")), prices, earnings)


def usable_samples(samples: DataFrame) -> DataFrame:
    return samples.where(F.col("skip_reason").isNull())


def series_values(samples: DataFrame, min_move: float = min(K.Y_CANDIDATES)) -> DataFrame:
    """(series, value): every move, and the share given back by large movers, down and up apart."""
    moves = F.struct(F.lit("move_1d").alias("series"), F.col("move_1d").alias("value"))
    large = F.col("assessable") & F.col("move_21d").isNotNull() & (F.abs("move_1d") >= min_move)
    series = F.when(F.col("move_1d") < 0, "retracement_down").otherwise("retracement_up")
    given_back = F.when(
        large, F.struct(series.alias("series"), retraced(F.col("move_1d"), F.col("move_21d")).alias("value"))
    )
    pairs = F.explode(F.filter(F.array(moves, given_back), lambda p: p.isNotNull())).alias("p")
    return usable_samples(samples).select(pairs).select("p.*")


def percentiles(values: DataFrame, percents=K.PERCENTS) -> DataFrame:
    return nearest_rank(values, ["series"], "value", percents)


def moments(values: DataFrame) -> DataFrame:
    """Count, mean and, above one value, the sample standard deviation."""
    return values.groupBy("series").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.when(F.count("value") > 1, F.stddev_samp("value")).alias("stdev"),
    )


def _grid() -> list[tuple[float, float, float]]:
    return [(x, y, z) for x in K.X_CANDIDATES for y in K.Y_CANDIDATES if y > x for z in K.Z_CANDIDATES]


def _step(value: Column, edges) -> Column:
    """How many of the ascending edges the value reaches, by the same comparison the labels use."""
    total = F.lit(0)
    for edge in edges:
        total = total + F.when(value >= edge, 1).otherwise(0)
    return total


def grid_counts(
    samples: DataFrame,
    overreaction_band: tuple[float, float] = K.OVERREACTION_BAND,
    neutral_band: tuple[float, float] = K.NEUTRAL_BAND,
) -> DataFrame:
    """Class counts and fractions per (x, y, z), with the acceptance verdict: both shares within their bands, ends included.

    A label depends only on the sign of the move and on which candidate thresholds it reaches. The
    samples are counted per such combination first, at most a few hundred groups whatever their
    number, and only those groups meet the grid.
    """
    move = F.col("move_1d")
    given_back = F.when(F.col("assessable") & F.col("move_21d").isNotNull(), retraced(move, F.col("move_21d")))
    signature = usable_samples(samples).select(
        F.signum(move).cast("int").alias("side"),
        _step(F.abs(move), K.X_CANDIDATES).alias("sx"),
        _step(F.abs(move), K.Y_CANDIDATES).alias("sy"),
        F.coalesce(_step(given_back, K.Z_CANDIDATES), F.lit(0)).alias("sz"),
    )
    groups = signature.groupBy("side", "sx", "sy", "sz").agg(F.count(F.lit(1)).alias("n"))
    cells = F.array(
        *[
            F.struct(
                F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(z).alias("z"),
                F.lit(K.X_CANDIDATES.index(x) + 1).alias("nx"),
                F.lit(K.Y_CANDIDATES.index(y) + 1).alias("ny"),
                F.lit(K.Z_CANDIDATES.index(z) + 1).alias("nz"),
            )
            for x, y, z in _grid()
        ]
    )
    over = (F.col("sy") >= F.col("c.ny")) & (F.col("sz") >= F.col("c.nz"))
    label = (
        F.when(over & (F.col("side") < 0), "overreaction_down")
        .when(over & (F.col("side") > 0), "overreaction_up")
        .when((F.col("sx") >= F.col("c.nx")) & (F.col("side") > 0), "good")
        .when((F.col("sx") >= F.col("c.nx")) & (F.col("side") < 0), "bad")
        .otherwise("neutral")
    )
    labelled = groups.withColumn("c", F.explode(cells)).select("c.x", "c.y", "c.z", "n", label.alias("label"))
    counted = labelled.groupBy("x", "y", "z").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col("label") == name, F.col("n")).otherwise(0)).alias(name) for name in K.REACTIONS],
    )
    over_share = (F.col("overreaction_down") + F.col("overreaction_up")) / F.col("n")
    return counted.withColumns(
        {"overreaction_share": over_share, "neutral_share": F.col("neutral") / F.col("n")}
    ).withColumn(
        "passes",
        F.col("overreaction_share").between(*overreaction_band) & F.col("neutral_share").between(*neutral_band),
    )
