"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake.session import salts


def skew_safe_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join big to small with each key spread over a fixed number of salts.

    The salt is a hash of columns that differ within a key, so a re-run task places its rows where
    the lost one did. The small side is repeated once per salt. Spark still broadcasts it when its
    size is under spark.sql.autoBroadcastJoinThreshold; beyond that the salted sort-merge join
    bounds what one task receives to a key's rows over the number of salts.
    """
    on = list(on)
    count = salts(big.sparkSession)
    if count == 1:
        return big.join(small, on, how)
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(count)).cast("int"))
    salted_small = small.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(count)])))
    return salted_big.join(salted_small, [*on, "_salt"], how).drop("_salt")


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds columns (or replaces those of the name) that are computed once per row, whatever reads them.

    They pass through an explode of one struct: a later filter or join condition on a plain column is moved below its
    projection with the whole expression written out at every use, and each of these is computed by itself.
    """
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    one = F.explode(F.array(F.struct(*[value.alias(name) for name, value in columns.items()])))
    return df.select(*kept, one.alias("_once")).select(*kept, "_once.*")
