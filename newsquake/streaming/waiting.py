"""Headlines that wait in the state of a stream until their forward window is complete.

Each waits under its entity, the moment it is due and a salt, in RocksDB, with a timer at that moment. A batch
touches the groups of its arrivals and those whose timers went off, whatever else is waiting; nothing is listed or
read again. Timers follow the clock, as the label of a past day depends on today's date only, so a headline that
arrives late is due at once instead of being dropped behind a watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from newsquake import constants as K
from newsquake.plans.label import label_headlines
from newsquake.session import salts
from newsquake.sources.versions import delete


class HoldUntilDue(StatefulProcessor):
    """Keeps the rows of a key (entity, due in milliseconds, salt) until then; without a due time they pass."""

    def __init__(self, schema: StructType):
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        due = key[1]
        if due is None or due <= timerValues.getCurrentProcessingTimeInMs():
            for row in rows:
                yield self.own(row)
            return
        self.waiting.appendList([tuple(self.own(row)) for row in rows])
        self.handle.registerTimer(due)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for row in self.waiting.get():
            yield Row(**dict(zip(self.schema.names, row)))
        self.waiting.clear()

    def own(self, row: Row) -> Row:
        """The headline without the columns it is grouped by."""
        return Row(**{name: row[name] for name in self.schema.names})

    def close(self) -> None:
        pass


def complete_headlines(feed: DataFrame, buffer_days: int = K.POST_PUBLISH_DAYS, due: Column | None = None) -> DataFrame:
    """The headlines of a stream, each once, from the first batch on that runs when its forward window is complete.

    That is the start (in the session's zone) of the day `buffer_days` after its publish date, or the timestamp
    `due`. A headline without a date, or of an old date, passes in the batch it arrives in. Rows that repeat are
    headlines of their own. The session needs the RocksDB state store, as `build_session` sets it. Start the query by
    `processingTime` or `once`: with timers of the clock Spark always has another batch to run, so `availableNow`
    does not end.
    """
    at = F.date_add(F.to_date("published_at"), buffer_days).cast("timestamp") if due is None else due
    salt = F.pmod(F.xxhash64(*feed.columns), F.lit(salts(feed.sparkSession)))
    keys = {"__ticker": F.col("ticker"), "__due": F.unix_millis(at), "__salt": salt}
    groups = feed.select("*", *[c.alias(name) for name, c in keys.items()]).groupBy(*keys)
    return groups.transformWithState(HoldUntilDue(feed.schema), feed.schema, "Append", "ProcessingTime")


def label_complete(
    labelled_path: str, prices: Callable[[], DataFrame], earnings: Callable[[], DataFrame | None]
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer of the labels of `complete_headlines`, one folder per batch.

    The batch is stored before it is labelled, as labelling reads it more than once and reading it again would run
    the stateful step again. A batch run again after a failure has the clock of its first run and replaces its folder.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = f"{labelled_path}_complete/batch={batch_id}"
        batch.write.mode("overwrite").parquet(stored)
        labels = label_headlines(spark.read.schema(batch.schema).parquet(stored), prices(), earnings())
        labels.write.mode("overwrite").parquet(f"{labelled_path}/batch={batch_id}")
        delete(spark, stored)

    return run
