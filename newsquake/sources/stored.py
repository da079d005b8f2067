"""Stored rows as JSON Lines, and the landing tables of the jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from newsquake.functions.text import cell_after_label, percent_to_fraction
from newsquake.plans.value import consensus_growth
from newsquake.schemas import ROW


BROKEN, NO_OBJECT, MISSING = "broken_json", "no_object", "missing"
STRICT = {"allowSingleQuotes": "false"}
END = '{"end of the line": 1}'  # stands behind every line when it is parsed


def read_lines(spark: SparkSession, paths: str | Sequence[str], schema: StructType = ROW, required: Sequence[str] = ("ticker",)) -> DataFrame:
    """Every line of JSON Lines files that is not blank: (file, line, reject_reason, row).

    A line is one JSON object and nothing behind it; what is not is `broken_json`, another value is `no_object`, and an
    object without one of the required fields, or with null there, is `missing <field>`. row is null for rejected
    lines; in others missing keys read as ''. Required names that the schema does not have are not asked for.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    lines = lines.where(F.col("line").rlike(r"(?U)[^\s\x1C-\x1F]"))
    # In an array with an end mark, whatever follows the object on its line breaks the array or adds to it.
    end = StructType([*schema.fields, StructField("end of the line", LongType())])
    parsed = F.from_json(F.concat(F.lit("["), F.col("line"), F.lit(f", {END}]")), ArrayType(end), STRICT)
    lines = lines.withColumn("_p", parsed)
    whole = (F.size("_p") == 2) & F.get("_p", F.lit(1))["end of the line"].isNotNull()
    first = F.get("_p", F.lit(0))
    reason = F.when(~F.coalesce(whole, F.lit(False)), F.when(F.col("line").rlike(r"^\s*\{"), BROKEN).otherwise(F.coalesce(_other_value(F.col("line")), F.lit(BROKEN))))
    reason = reason.when(first.isNull() | ~F.col("line").rlike(r"^\s*\{"), NO_OBJECT)
    for name in [n for n in required if n in schema.names]:
        reason = reason.when(first[name].isNull(), f"{MISSING} {name}")
    filled = F.struct(*[_filled(first[f.name], f).alias(f.name) for f in schema.fields])
    return lines.withColumn("reject_reason", reason).select("file", "line", "reject_reason", F.when(F.col("reject_reason").isNull(), filled).alias("row"))


def _filled(value: Column, field: StructField) -> Column:
    return F.coalesce(value, F.lit("")) if isinstance(field.dataType, StringType) else value


def _other_value(line: Column) -> Column:
    """The reason for a JSON value that is no object; null where the line is no JSON at all."""
    held = F.from_json(F.concat(F.lit('{"v": '), line, F.lit(f', "e": {END}}}')), "struct<v:string,e:struct<`end of the line`:bigint>>", STRICT)
    plain = line.rlike(r'^\s*(\[|"|-?\d|true\b|false\b|null\b)')
    return F.when(plain & held["e"]["end of the line"].isNotNull(), NO_OBJECT)


def read_rows(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType = ROW, required: Sequence[str] = ("ticker",), on_reject: str = "raise"
) -> DataFrame:
    """The rows of JSON Lines files; blank lines do not count and missing keys read as ''.

    A line that is no such row (see read_lines) raises when the rows are computed, naming its file and reason; with
    on_reject="leave" it is left to whoever stores `rejects`.
    """
    if on_reject not in ("raise", "leave"):
        raise ValueError(f"on_reject must be 'raise' or 'leave', not {on_reject!r}")
    lines = read_lines(spark, paths, schema, required)
    if on_reject == "raise":
        told = F.concat(F.lit("rejected line in "), F.col("file"), F.lit(" ("), F.col("reject_reason"), F.lit("): "), F.substring("line", 1, 200))
        return lines.where(F.when(F.col("reject_reason").isNull(), True).otherwise(F.raise_error(told).cast("boolean"))).select("row.*")
    return lines.where(F.col("reject_reason").isNull()).select("row.*")


def rejects(lines: DataFrame) -> DataFrame:
    """(file, line, reject_reason) of the lines of `read_lines` that are no rows."""
    return lines.where(F.col("reject_reason").isNotNull()).select("file", "line", "reject_reason")


def line_counts(lines: DataFrame) -> DataFrame:
    """(file, outcome, n): rows and rejected lines of every file; outcome is 'row' or the reason."""
    return lines.groupBy("file", F.coalesce("reject_reason", F.lit("row")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_split(
    spark: SparkSession, required: Sequence[str], optional: Sequence[str] = (), schema: StructType = ROW
) -> DataFrame:
    """All files of one split as one table; optional files count only when they are there."""
    return read_rows(spark, [*required, *[p for p in optional if _exists(spark, p)]], schema)


def read_tagged(spark: SparkSession, sources: Mapping[str, str], tag: str = "source", schema: StructType = ROW) -> DataFrame:
    """Files by tag, unioned, each row carrying the tag of its file."""
    parts = [read_rows(spark, path, schema).withColumn(tag, F.lit(name)) for name, path in sources.items()]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def window_feed(landing: DataFrame, after: Column, before: Column) -> DataFrame:
    """Feed items published in [after, before) with a non-empty title; the range reaches the scan."""
    return landing.where((F.col("published_at") >= after) & (F.col("published_at") < before) & (F.col("feed_title") != ""))


def price_range(landing: DataFrame, start: Column, end: Column) -> DataFrame:
    """Daily closes in [start, end); the range reaches the scan."""
    return landing.where((F.col("trade_date") >= start) & (F.col("trade_date") < end))


def growth_from_pages(pages: DataFrame, label: str = "EPS next 5Y", tag: str = "td") -> DataFrame:
    """(ticker, eps_growth_5y) from quote pages (ticker, html)."""
    return pages.select("ticker", percent_to_fraction(cell_after_label(F.col("html"), label, tag)).alias("eps_growth_5y"))


def assemble_fundamentals(
    entities: DataFrame,
    info: DataFrame | None = None,
    estimates: DataFrame | None = None,
    growth_5y: DataFrame | None = None,
) -> DataFrame:
    """One row per entity; a source that is absent, or lacks the entity, leaves its fields null."""
    out = entities.select("ticker")
    if info is not None:
        fields = info.columns
        snapshot = info
        if "dividend_rate" in fields and "trailing_dividend_rate" in fields:
            rate = F.coalesce(F.nullif("dividend_rate", F.lit(0.0)), "trailing_dividend_rate")
            snapshot = info.withColumn("dividend_rate", rate).drop("trailing_dividend_rate")
        out = out.join(snapshot, "ticker", "left")
    if estimates is not None:
        out = out.join(consensus_growth(estimates), "ticker", "left")
    if growth_5y is not None:
        out = out.join(growth_5y, "ticker", "left")
    return out


def latest_snapshot(info: DataFrame, at: str = "fetched_at") -> DataFrame:
    """The most recent snapshot per entity."""
    order = Window.partitionBy("ticker").orderBy(F.col(at).desc())
    return info.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", at)
