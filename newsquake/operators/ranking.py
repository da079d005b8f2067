"""Exact ranks, samples and running totals that never sort a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsquake.functions.numeric import draw_bits
from newsquake.session import settled


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows per group. Spark keeps k rows per group and map task before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def sample_per_group(
    df: DataFrame, by: str, targets: DataFrame, ids: Sequence[str], seed: str, bits: int = 16
) -> DataFrame:
    """Exactly min(size, target) rows per group, the ones with the smallest hash of ids and seed.

    targets has one row per group: (by, target). Groups are classes, few enough for one map of them. The hash at
    which a group's target is reached is searched in two levels: counts by its first bits, then counts by the other
    bits of the one bucket that holds it. Both answers go to the rows as such a map, so rows are filtered where they
    lie; only those of the one hash that splits, if any, are ranked. Groups without a target are left out.
    """
    number = draw_bits(*[F.col(c) for c in ids], seed)
    high, low = F.shiftright("_hash", 32 - bits), F.col("_hash").bitwiseAND(F.lit((1 << (32 - bits)) - 1))
    hashed = df.where(F.col(by).isNotNull()).withColumn("_hash", number)
    first = _edges(hashed.select(by, high.alias("_bucket")), by, targets)
    # of a group: the bucket that splits, null if the group is taken whole, and the rows wanted of that bucket
    outer = F.element_at(first, F.col(by))
    inside = hashed.where(high == outer["edge"]).select(by, low.alias("_bucket"))
    rest = targets.select(by, F.element_at(first, F.col(by))["room"].alias("target")).where("target is not null")
    inner = F.element_at(_edges(inside, by, rest), F.col(by))
    known = hashed.where(outer.isNotNull())
    here = high == outer["edge"]
    sure = outer["edge"].isNull() | (high < outer["edge"]) | (here & (low < inner["edge"]))
    torn = known.where(here & (low == inner["edge"]))
    order = Window.partitionBy(by).orderBy(*ids)
    some = torn.withColumn("_room", inner["room"]).withColumn("_rank", F.row_number().over(order))
    some = some.where(F.col("_rank") <= F.col("_room")).drop("_rank", "_room")
    return known.where(F.coalesce(sure, F.lit(False))).unionByName(some).drop("_hash")


def _edges(buckets: DataFrame, by: str, targets: DataFrame) -> Column:
    """A map from group to (edge, room): the bucket in which the target is passed and what is wanted of it."""
    counts = buckets.groupBy(by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(by).orderBy("_bucket"))
    found = (
        counts.withColumn("_upto", upto)
        .join(targets, by)
        .groupBy(by)
        .agg(
            F.min(F.when(F.col("_upto") > F.col("target"), F.col("_bucket"))).alias("edge"),
            (F.first("target") - F.coalesce(F.max(F.when(F.col("_upto") <= F.col("target"), F.col("_upto"))), F.lit(0))).alias("room"),
        )
    )
    entries = F.collect_list(F.struct(F.col(by), F.struct("edge", "room")))
    return found.agg(F.map_from_entries(entries).alias("edges")).scalar()


def nearest_rank(
    df: DataFrame, by: Sequence[str], value: str, percents: Sequence[int], weight: str | None = None,
    most: int = 100_000, bins: int = 4096,
) -> DataFrame:
    """Nearest-rank percentiles (by, percent, n, value): the item at round(p/100*(n-1)), half to even.

    Equal values are counted first. A histogram by sign and power of two, which suits numbers of any size, tells the
    ranges that hold a wanted rank; a range with more than `most` different values is cut into `bins` equal parts
    between its least and largest value, again and again, until none has more. Only those are ordered in full, so no
    task sorts more than `most` values, however they lie. Values are numbers; infinities are ordered too, NaN last.
    """
    by = list(by)
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(amount.alias("_n"))
    placed = settled(counted.withColumns({"_from": F.lit(0), "_range": _power_range(F.col(value).cast("double"))}))
    keys = [*by, "_from", "_range"]
    whole = _ranges(placed, keys).withColumn("_before", _earlier(by, "_range")).withColumn("n", F.sum("_rn").over(Window.partitionBy(*by)))
    asked = whole.withColumn("percent", F.explode(F.array(*[F.lit(p) for p in percents]))).withColumn(
        "_rank", F.rint(F.col("percent") / F.lit(100) * (F.col("n") - 1)).cast("long")
    )
    wanted = settled(_holding(asked))
    while (wanted.agg(F.max("_values")).first()[0] or 0) > most:
        spans = wanted.select(*keys, "_low", "_high", "_before", "_values").distinct()
        width = F.col("_high") - F.col("_low")
        part = F.floor((F.col(value) - F.col("_low")).cast("double") / width.cast("double") * bins)
        inside = placed.join(spans, keys)
        # ranges small enough stay one part, so they are carried along unchanged
        cut = F.when(F.col("_values") > most, part).otherwise(F.lit(0)).cast("long")
        placed = settled(inside.select(*by, value, "_n", F.col("_low").alias("_from"), cut.alias("_range"), F.col("_before").alias("_start")))
        parts = _ranges(placed, [*keys, "_start"])
        parts = parts.withColumn("_before", F.col("_start") + _earlier([*by, "_from"], "_range"))
        marks = wanted.select(*by, F.col("_low").alias("_from"), "n", "percent", "_rank")
        wanted = settled(_holding(parts.join(marks, [*by, "_from"])))
        placed = placed.drop("_start")
    needed = wanted.select(*keys, "_before").distinct()
    inner = Window.partitionBy(*keys).orderBy(value)
    ordered = placed.join(needed, keys).withColumn("_upto", F.col("_before") + F.sum("_n").over(inner))
    hit = ordered.join(wanted.select(*keys, "n", "percent", "_rank"), keys).where(
        (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n"))
    )
    return hit.select(*by, "percent", "n", value)


def _power_range(number: Column) -> Column:
    """A number of at most a few thousand ranges, in the order of the numbers: sign and power of two."""
    power = F.least(F.floor(F.least(F.log2(F.abs(number)), F.lit(2000.0))), F.lit(2000)) + 1100
    ranged = F.when(number > 0, power).when(number < 0, -power).otherwise(F.lit(0))
    return F.when(F.isnan(number), F.lit(9999)).otherwise(ranged).cast("long")


def _ranges(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    value = next(c for c in placed.columns if c not in (*keys, "_n", "_start"))
    return placed.groupBy(*keys).agg(
        F.sum("_n").alias("_rn"), F.count(F.lit(1)).alias("_values"), F.min(value).alias("_low"), F.max(value).alias("_high")
    )


def _earlier(by: Sequence[str], order: str) -> Column:
    """Rows in the ranges before this one; ranges are few, whatever the number of rows."""
    return F.sum("_rn").over(Window.partitionBy(*by).orderBy(order)) - F.col("_rn")


def _holding(ranges: DataFrame) -> DataFrame:
    return ranges.where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_rn")))


def running_totals(
    df: DataFrame, by: Sequence[str], position: str, sums: Sequence[str], chunk: int = 100_000
) -> DataFrame:
    """Running row number and running sums in position order, as running_n and running_<name>.

    Positions are cut into chunks; chunk totals are accumulated first (one row per chunk), and
    each chunk then adds its own offset, so the work inside a group is spread over its chunks.
    """
    by = list(by)
    cut = df.withColumn("_chunk", F.floor(F.col(position) / F.lit(chunk)))
    totals = cut.groupBy(*by, "_chunk").agg(
        F.count(F.lit(1)).alias("_total_n"), *[F.sum(c).alias(f"_total_{c}") for c in sums]
    )
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    names = ["n", *sums]
    offsets = totals.select(
        *by,
        "_chunk",
        *[F.coalesce(F.sum(f"_total_{name}").over(earlier), F.lit(0)).alias(f"_offset_{name}") for name in names],
    )
    inside = Window.partitionBy(*by, "_chunk").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    joined = cut.join(offsets, [*by, "_chunk"])
    return joined.withColumns(
        {
            "running_n": F.col("_offset_n") + F.count(F.lit(1)).over(inside),
            **{f"running_{c}": F.col(f"_offset_{c}") + F.sum(c).over(inside) for c in sums},
        }
    ).drop("_chunk", *[f"_offset_{name}" for name in names])
