"""Writers of stored rows and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake.plans.report import report_text, review_text, valuation_report
from newsquake.sources.stored import rejects


def append_rows(rows: DataFrame, path: str) -> None:
    """Append finished rows to their split's folder; the split is the folder, not a field."""
    rows.write.mode("append").partitionBy("split").json(path)


def write_split(rows: DataFrame, path: str) -> None:
    """Write train and val folders anew, without the split field in the rows."""
    rows.write.mode("overwrite").partitionBy("split").json(path)


def write_rejects(lines: DataFrame, path: str) -> None:
    """Lines that are no rows, as JSON Lines of (file, line, reject_reason); each run has a folder of its own."""
    rejects(lines).write.mode("overwrite").json(path)


def rewrite(path: str, staging: str, rows: DataFrame) -> None:
    """Replace a folder by rows computed from it.

    Spark reads lazily and must not overwrite its own input, so the result goes to a staging
    folder first; the source folder is kept beside it as <path>.previous until the swap is done.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").json(staging)
    jvm = spark._jvm
    target, fresh, previous = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, staging, path + ".previous"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(previous):
        fs.delete(previous, True)
    if not fs.rename(target, previous):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(fresh, target):
        fs.rename(previous, target)
        raise OSError(f"could not move {staging} to {path}")
    fs.delete(previous, True)


def write_review(rows: DataFrame, path: str, row_order: str, label: str = "real") -> None:
    """Review text: a heading with totals, then the rows in ticker order, as ordered part files."""
    review_text(rows, row_order, label).write.mode("overwrite").text(path)


def write_valuation_report(entities: DataFrame, texts: DataFrame, path: str, written_on: Column | None = None) -> None:
    """Valuation report in markdown: heading, ranked table, then the texts of each entity, as ordered part files."""
    lines = valuation_report(entities, texts, F.current_date() if written_on is None else written_on)
    report_text(lines).write.mode("overwrite").text(path)
