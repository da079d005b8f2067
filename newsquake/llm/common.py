"""What several operators share: tables of the run, stored intermediate tables and text helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# The word patterns of the result contracts.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A table of the run, as Spark's reader finds it."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see; a local session that names none gets one of its own, a cluster has to name it."""
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="newsquake-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


# Shuffle files of a write go when it ends, not when the driver happens to collect its garbage.
TIDY_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Python workers take texts in small batches: a few thousand long ones at once would not fit beside the executor's heap.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


class Shelf:
    """Intermediate tables of one run of an operator, written where every executor can read them.

    `put` writes a frame and reads it back, which cuts its lineage and survives lost executors;
    `drop` deletes a table that later ones have replaced. With `tidy`, what a write has shuffled is deleted when the
    write ends.
    """

    watched: list[list[Shelf]] = []

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        self.spark = spark
        self.tidy = tidy
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        for key, value in ARROW_CONF.items():
            spark.conf.set(key, value)
        self.count = 0
        self.paths: dict[int, str] = {}
        self.frames: list[DataFrame] = []
        for opened in Shelf.watched:
            opened.append(self)

    def put(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """The frame written and read back; with `by`, in a folder for each value of that column."""
        self.count += 1
        path = f"{self.folder}/t{self.count}"
        before = self.spark.conf.get(TIDY_CONF)
        self.spark.conf.set(TIDY_CONF, "true" if self.tidy else before)
        try:
            (df.write.partitionBy(by) if by else df.write).parquet(path)
        finally:
            self.spark.conf.set(TIDY_CONF, before)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = path
        self.frames.append(kept)  # an id stays one frame's as long as the frame lives
        return kept

    def drop(self, *frames: DataFrame) -> None:
        for path in [self.paths.pop(id(f)) for f in frames if id(f) in self.paths]:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def keep_only(self, *frames: DataFrame) -> None:
        """Deletes all tables but those of `frames`, from which everything still to come is derived."""
        self.drop(*[f for f in self.frames if all(f is not kept for kept in frames)])


@contextmanager
def clearing() -> Iterator[None]:
    """Deletes at its end all tables of the shelves opened inside; what is needed of them must be written by then."""
    opened: list[Shelf] = []
    Shelf.watched.append(opened)
    try:
        yield
        for shelf in opened:
            shelf.keep_only()
    finally:
        Shelf.watched = [other for other in Shelf.watched if other is not opened]


def free(name: str, *frames: DataFrame) -> str:
    """The name, with underscores added while a column of the frames has it in any case of letters."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8(text: str | None) -> bytes:
    """A text as UTF-8 bytes; null is empty."""
    return b"" if text is None else text.encode("utf-8", "replace")
