"""The jobs put together: from landing tables to stored, balanced rows, in steps that can be cut off and resumed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake.plans.rows import finished_rows, pending, rebalance, shuffled
from newsquake.plans.select import keep_within_caps, select_headlines
from newsquake.plans.signals import fuse_headlines
from newsquake.sources.store import RowStore
from newsquake.sources.versions import publish

# The tables of a job that have a ticker; sectors are shared.
BY_ENTITY = ("entities", "headlines", "assessments", "prices", "quarterly", "earnings", "fundamentals")


class Chosen:
    """The tables of a job, with the rows of some entities only."""

    def __init__(self, tables, entities: DataFrame):
        self._tables, self._entities = tables, entities.select("ticker").distinct()

    def __getattr__(self, name: str):
        table = getattr(self._tables, name)
        return table.join(self._entities, "ticker", "left_semi") if name in BY_ENTITY else table

    @cached_property
    def sectors(self) -> DataFrame:
        return self._tables.sectors


def kept_headlines(tables) -> DataFrame:
    """Headlines selected, labelled, valued and fused, within both caps."""
    chosen = select_headlines(tables.headlines, tables.assessments, tables.entities, tables.sectors)
    return keep_within_caps(fuse_headlines(chosen.where(F.col("skip_reason").isNull()).drop("skip_reason"), tables))


def group_of(ticker: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(ticker), F.lit(groups)).cast("int")


def generate_rows(
    tables, store: RowStore, today: Column, holdout: Sequence[str] = (), responses: DataFrame | None = None, analysis: bool = True, groups: int = 8
) -> int:
    """Stores the rows of all entities that have none yet; returns how many steps that took.

    Entities are cut into groups by a hash of their ticker, and each group is one step of the store: what a run
    finished before it was cut off is not done again. An entity without any row is tried in every run.
    """
    entities = tables.entities.select("ticker")
    todo = pending(entities, store.done()).withColumn("g", group_of(F.col("ticker"), groups))
    steps = 0
    for g in sorted(r.g for r in todo.select("g").distinct().collect()):  # `groups` numbers at most
        part = Chosen(tables, pending(entities, store.done()).where(group_of(F.col("ticker"), groups) == g))
        store.write(finished_rows(kept_headlines(part), today, holdout, responses, analysis))
        steps += 1
    return steps


def balance_rows(store: RowStore, path: str, split: str = "train", seed: str = "rebalance") -> int:
    """The split's rows, rebalanced and in hash order, as the next version of a folder of JSON Lines."""
    fields = store.schema.names
    rows = store.rows(split).withColumn("row_key", F.sha2(F.to_json(F.struct(*fields)), 256))
    balanced = rebalance(rows, ["row_key"], seed)  # rows alike in every field may stand for each other
    return publish(shuffled(balanced, ["row_key"]).select(*fields), path, lambda writer, folder: writer.json(folder))
