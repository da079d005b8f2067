"""Folders that change as a whole: numbered versions, and a marker per version that is written last.

Nothing is renamed. A version is a folder of its own under the path; it counts from the moment its marker, an empty
file that names it, is created, which is one step on file systems and object stores alike. So a reader sees the rows
before or after, never half of them, and what a writer left that stopped before its marker is never read and is
written over by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession

MARKERS = "_versions"


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none where it does not exist."""
    fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def mark(spark: SparkSession, path: str) -> None:
    """Creates an empty file; raises if it is there."""
    fs, target = _fs(spark, path)
    fs.create(target, False).close()


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions, oldest first."""
    return sorted(int(name) for name in names(spark, f"{path}/{MARKERS}") if name.isdigit())


def version_path(path: str, number: int) -> str:
    return f"{path}/v{number:08d}"


def current_path(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest finished version; null where there is none."""
    done = versions(spark, path)
    return version_path(path, done[-1]) if done else None


def publish(
    df: DataFrame, path: str, save: Callable[[DataFrameWriter, str], None] = lambda w, p: w.parquet(p), keep: int = 2, number: int | None = None
) -> int:
    """Writes the frame as the next version and returns its number; rows may be computed from the current version.

    A given number must lie above those there are.

    The `keep` newest versions stay, so that jobs which began to read the one before can end. Of two writers at a
    time the second to finish raises, as the marker of its number exists.
    """
    spark = df.sparkSession
    done = versions(spark, path)
    last = done[-1] if done else 0
    if number is not None and number <= last:
        raise ValueError(f"version {number} of {path} is not above {last}")
    number = last + 1 if number is None else number
    save(df.write.mode("overwrite"), version_path(path, number))
    mark(spark, f"{path}/{MARKERS}/{number:08d}")
    for old in done[: max(0, len(done) + 1 - keep)]:
        delete(spark, f"{path}/{MARKERS}/{old:08d}")  # the marker first: what has none is not read
        delete(spark, version_path(path, old))
    return number


def current(spark: SparkSession, path: str, load: Callable[[DataFrameReader, str], DataFrame] = lambda r, p: r.parquet(p)) -> DataFrame:
    """The rows of the newest finished version."""
    found = current_path(spark, path)
    if found is None:
        raise FileNotFoundError(f"{path} has no finished version")
    return load(spark.read, found)
