"""Finished rows per split and entity, written in steps that can be repeated.

    <path>/rows/split=<split>/entity=<ticker>/part-*.json   the rows
    <path>/steps/<n>/part-*.json                            manifest of step n: (split, entity, rows)
    <path>/finished/<n>                                     empty; step n counts once this is there

A step stages its rows, replaces the folders of the entities it holds, writes its manifest and then its mark. An
entity's rows count if they are in the splits that the newest finished step with that entity names. A step that stops
anywhere before its mark adds no entity that counts, and the next run does the same entities again over the same
folders, so rows are neither lost nor doubled however often a run is cut off. (Of an entity that counted already, and
was being written anew, either content may lie there then; jobs only write entities that do not count yet.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from newsquake.schemas import ROW
from newsquake.session import salts, work_folder
from newsquake.sources.versions import delete, mark, names

MANIFEST = StructType([StructField("split", StringType()), StructField("entity", StringType()), StructField("rows", LongType())])


class RowStore:
    """Stored rows of one schema with `ticker` among its fields; the split is a folder, not a field."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType = ROW):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def steps(self) -> list[int]:
        """Numbers of the finished steps."""
        return sorted(int(name) for name in names(self.spark, f"{self.path}/finished") if name.isdigit())

    def manifest(self) -> DataFrame:
        """(split, entity, rows) of every entity's newest finished step."""
        finished = self.steps()
        if not finished:
            return self.spark.createDataFrame([], MANIFEST)
        told = self.spark.read.schema(StructType([*MANIFEST.fields, StructField("step", IntegerType())])).option("basePath", f"{self.path}/steps")
        read = told.json([f"{self.path}/steps/step={n}" for n in finished])
        newest = read.groupBy("entity").agg(F.max("step").alias("step"))
        return read.join(newest, ["entity", "step"]).select("split", "entity", "rows")

    def done(self) -> DataFrame:
        """(ticker) of the entities with at least one row that counts."""
        return self.manifest().select(F.col("entity").alias("ticker")).distinct()

    def rows(self, split: str | None = None) -> DataFrame:
        """The rows that count: the fields of the schema and, unless one split is asked for, `split`."""
        placed = StructType([*self.schema.fields, *MANIFEST.fields[:2]])
        there = names(self.spark, f"{self.path}/rows")
        read = self.spark.read.schema(placed).json(f"{self.path}/rows") if there else self.spark.createDataFrame([], placed)
        told = self.manifest()
        if split is not None:
            read, told = read.where(F.col("split") == split), told.where(F.col("split") == split)
        counted = read.join(told, ["split", "entity"], "left_semi")
        return counted.select(*self.schema.names, *(["split"] if split is None else []))

    def write(self, rows: DataFrame) -> int:
        """One step: the rows of every entity that appears replace that entity's rows. Returns the step's number.

        rows has the fields of the schema and `split`, no null ticker or split. They are computed once, into a staging
        folder, and an entity's rows are spread over several tasks, so that a large one does not wait for one writer.
        One writer at a time: the second of two to finish a step raises.
        """
        staging = work_folder(self.spark, "rows")
        rows.select(*self.schema.names, "split").write.parquet(staging)
        staged = self.spark.read.parquet(staging)
        self.place(staged)
        number = self.finish(staged)
        delete(self.spark, staging)
        return number

    def place(self, staged: DataFrame) -> None:
        """Replaces the folders of the entities in the step; nothing counts yet."""
        spread = F.pmod(F.xxhash64(*self.schema.names), F.lit(salts(self.spark)))
        placed = staged.withColumn("entity", F.col("ticker")).repartition("split", "entity", spread)
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("split", "entity").json(f"{self.path}/rows")

    def finish(self, staged: DataFrame) -> int:
        """Writes the manifest of the step and, last, its mark."""
        number = max(self.steps(), default=0) + 1
        told = staged.groupBy("split", F.col("ticker").alias("entity")).agg(F.count(F.lit(1)).alias("rows"))
        told.write.mode("overwrite").json(f"{self.path}/steps/step={number}")
        mark(self.spark, f"{self.path}/finished/{number}")
        return number
