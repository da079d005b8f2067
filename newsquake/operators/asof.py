"""As-of lookups: for each (key, date), the nearest row of one or more time-ordered tables.

Everything the labels and valuations need depends on an entity and a calendar date only, so the
probes are reduced to distinct (key, date) pairs before any shuffle by key. A key then holds at
most one probe per calendar day, however many headlines it has, and the result goes back to the
headlines by an equi-join on (key, date).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Where a row sorts among rows of equal time; a probe holds the middle place.
_BEFORE, _PROBE, _AFTER = 0, 1, 2


@dataclass(frozen=True)
class AsOf:
    """One lookup: which table, by which time, in which direction, and what to bring back.

    An inclusive lookup compares dates, a strict one compares the exact time with the probe's
    midnight. rows limits the lookup to some rows of the table. carry adds fields of a forward
    lookup listed earlier, as seen from the found row itself.
    """

    name: str
    table: DataFrame
    time: str
    payload: Sequence[str]
    direction: str = "backward"
    inclusive: bool = True
    tolerance_days: int | None = None
    rows: Column | None = None
    carry: Mapping[str, str] = field(default_factory=dict)

    @property
    def forward(self) -> bool:
        return self.direction == "forward"

    def place(self) -> int:
        """A backward lookup sees what sorts before the probe, a forward one what sorts after."""
        return _AFTER if self.forward == self.inclusive else _BEFORE

    def at(self) -> Column:
        """Sort time. Forward inclusive rows stand at the end of their day, so that any row of that
        day, whatever its hour, still finds them ahead."""
        if not self.inclusive:
            return F.col(self.time).cast("timestamp")
        day = F.col(self.time).cast("date")
        return F.date_add(day, 1).cast("timestamp") - F.expr("interval 1 microsecond") if self.forward else day.cast("timestamp")


def distinct_days(df: DataFrame, by: str, time: str, name: str = "as_of") -> DataFrame:
    """The distinct (key, date) pairs; rows are combined on the map side before they move."""
    return df.select(F.col(by), F.col(time).cast("date").alias(name)).where(F.col(name).isNotNull()).distinct()


def _by_table(lookups: Sequence[AsOf]) -> list[list[AsOf]]:
    groups: list[list[AsOf]] = []
    for look in lookups:
        same = next((g for g in groups if g[0].table is look.table), None)
        if same is None:
            groups.append([look])
        else:
            same.append(look)
    return groups


def asof_lookup(days: DataFrame, by: str, time: str, lookups: Sequence[AsOf]) -> DataFrame:
    """Adds one struct column per lookup to distinct (by, time) rows; null where nothing qualifies.

    All tables are unioned and sorted once per key and direction, so N lookups cost one shuffle
    by key and at most two sorts, instead of N range joins that compare every pair. A table that
    serves several lookups is read once and its rows take one place per lookup.
    """
    extra = [c for c in days.columns if c not in (by, time)]
    probe = F.struct(F.col(time), *[F.col(c) for c in extra])

    def type_of(df: DataFrame, value: Column):
        return df.select(value.alias("s")).schema["s"].dataType

    values = {look.name: F.struct(*[F.col(c) for c in look.payload]) for look in lookups}
    types = {"_probe": type_of(days, probe), **{look.name: type_of(look.table, values[look.name]) for look in lookups}}

    def entry(at: Column, place: int, own: str, value: Column) -> Column:
        fields = [at.alias("_at"), F.lit(place).alias("_place")]
        fields += [(value if name == own else F.lit(None).cast(kind)).alias(name) for name, kind in types.items()]
        return F.struct(*fields)

    parts = [days.select(by, entry(F.col(time).cast("timestamp"), _PROBE, "_probe", probe).alias("e"))]
    for group in _by_table(lookups):
        entries = [
            entry(look.at(), look.place(), look.name, values[look.name])
            if look.rows is None
            else F.when(look.rows, entry(look.at(), look.place(), look.name, values[look.name]))
            for look in group
        ]
        filled = F.filter(F.array(*entries), lambda e: e.isNotNull() & e["_at"].isNotNull())
        parts.append(group[0].table.select(by, F.explode(filled).alias("e")))
    merged = reduce(DataFrame.unionByName, parts).select(by, "e.*")

    past = Window.partitionBy(by).orderBy("_at", "_place").rowsBetween(Window.unboundedPreceding, 0)
    future = (
        Window.partitionBy(by)
        .orderBy(F.col("_at").desc(), F.col("_place").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )

    def nearest(look: AsOf) -> Column:
        carried = [F.col(f"_found_{source.split('.')[0]}")["v"][source.split(".")[1]].alias(n) for n, source in look.carry.items()]
        value = F.struct(*[F.col(look.name)[c].alias(c) for c in look.payload], *carried)
        seen = F.when(F.col(look.name).isNotNull(), F.struct(F.to_date("_at").alias("on"), value.alias("v")))
        return F.last(seen, ignorenulls=True).over(future if look.forward else past)

    found = merged
    for step in ([x for x in lookups if not x.carry], [x for x in lookups if x.carry]):
        found = found.withColumns({f"_found_{look.name}": nearest(look) for look in step}) if step else found
    columns = [F.col(by), *[F.col("_probe")[c].alias(c) for c in (time, *extra)]]
    for look in lookups:
        hit = F.col(f"_found_{look.name}")
        value = hit["v"]
        if look.tolerance_days is not None:
            value = F.when(F.abs(F.datediff(hit["on"], F.to_date("_at"))) <= look.tolerance_days, value)
        columns.append(value.alias(look.name))
    return found.where(F.col("_probe").isNotNull()).select(*columns)
