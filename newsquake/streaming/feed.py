"""Arriving headlines: windows, de-duplication, and labels once their forward window is complete.

The batch jobs stay the definition; a stream only decides when a headline is ready for them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, IntegerType, LongType, StructField, StructType

from newsquake import constants as K
from newsquake.plans.label import label_headlines
from newsquake.sources.versions import delete, names, publish, version_path, versions


def read_feed(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def weekly_counts(feed: DataFrame, watermark: str = "7 days", start: str = "0 days") -> DataFrame:
    """Headlines per entity and seven-day tumbling window; works on a stream and on a table."""
    window = F.window("published_at", "7 days", startTime=start)
    base = feed.withWatermark("published_at", watermark) if feed.isStreaming else feed
    return base.groupBy("ticker", window.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        "ticker", F.col("w.start").alias("after"), F.col("w.end").alias("before"), "n"
    )


def unseen_titles(feed: DataFrame, watermark: str = "126 days") -> DataFrame:
    """First arrival of each (ticker, title) within the watermark; older state is dropped (see first_titles for all time).

    Of a table, the row with the earliest date, then the least by its other columns; undated rows come last.
    """
    if feed.isStreaming:
        return feed.withWatermark("published_at", watermark).dropDuplicatesWithinWatermark(["ticker", "title"])
    rest = [c for c in feed.columns if c not in ("ticker", "title", "published_at")]
    first = F.min(F.struct(F.col("published_at").isNull().alias("undated"), "published_at", *rest)).alias("f")
    return feed.groupBy("ticker", "title").agg(first).select(*[c if c in ("ticker", "title") else f"f.{c}" for c in feed.columns])


def first_titles(index_path: str, out_path: str, buckets: int = 256, merge_every: int = 20) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer of the headlines whose (ticker, title) no earlier batch had, however long ago.

    What was seen is an index of digests, cut into buckets by a hash. A batch reads the buckets its own titles fall
    into, of the merged index and of the runs since the last merge, and adds a run with its new titles; every
    `merge_every` batches the runs before are merged, so a batch lists no more than that many. A batch run again
    after a failure reads what batches before it left, and replaces its own output and run.
    """
    runs_path, merged_path = f"{index_path}/runs", f"{index_path}/merged"
    schema = StructType([StructField("digest", BinaryType()), StructField("bucket", IntegerType())])

    def index(spark: SparkSession, batch_id: int, wanted: list[int] | None) -> DataFrame:
        """Digests of the batches before; the newest version of the merged index is named after the first batch it lacks."""
        merged = versions(spark, merged_path)
        upto = merged[-1] if merged else 0
        folders = [version_path(merged_path, upto)] if merged else []
        there = {int(name.removeprefix("batch=")) for name in names(spark, runs_path) if name.startswith("batch=")}
        folders += [f"{runs_path}/batch={n}" for n in sorted(there) if upto <= n < batch_id]
        parts = [spark.read.schema(schema).option("basePath", f).parquet(f) for f in folders]
        seen = spark.createDataFrame([], schema)
        for part in parts:
            seen = seen.union(part if wanted is None else part.where(F.col("bucket").isin(wanted)))
        return seen

    def merge(spark: SparkSession, batch_id: int) -> None:
        done = versions(spark, merged_path)
        if batch_id == 0 or batch_id % merge_every or (done and done[-1] >= batch_id):
            return
        whole = index(spark, batch_id, None).distinct().repartition("bucket")
        publish(whole, merged_path, lambda writer, folder: writer.partitionBy("bucket").parquet(folder), number=batch_id)
        for name in names(spark, runs_path):
            if name.startswith("batch=") and int(name.removeprefix("batch=")) < batch_id:
                delete(spark, f"{runs_path}/{name}")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merge(spark, batch_id)
        digest = F.unhex(F.sha2(F.to_json(F.struct("ticker", "title")), 256))
        told = unseen_titles(batch).withColumn("digest", digest)
        told = told.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))
        wanted = sorted(r.bucket for r in told.select("bucket").distinct().collect())  # `buckets` numbers at most
        fresh = told.join(index(spark, batch_id, wanted), ["digest", "bucket"], "left_anti")
        own = f"{out_path}/batch={batch_id}"
        fresh.select(*batch.columns, "digest", "bucket").write.mode("overwrite").parquet(own)
        written = spark.read.schema(StructType([*batch.schema.fields, *schema.fields])).parquet(own)
        written.select("digest", "bucket").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{runs_path}/batch={batch_id}")

    return run


def ready(feed: DataFrame, as_of, buffer_days: int = K.POST_PUBLISH_DAYS) -> DataFrame:
    """Headlines whose forward window is complete on `as_of`."""
    return feed.where(F.to_date("published_at") <= F.date_sub(F.lit(as_of), buffer_days))


def label_when_complete(
    pending_path: str,
    labelled_path: str,
    prices: Callable[[], DataFrame],
    earnings: Callable[[], DataFrame | None],
    as_of: Callable[[], date],
    buffer_days: int = K.POST_PUBLISH_DAYS,
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer: arrivals wait in one table, finished labels are added to another.

    Every batch replaces its own folder (batch=<id>), so a batch run again after a failure leaves
    the same rows. Waiting headlines are partitioned by publish date, and each batch notes the last
    date it found complete. The next one reads the dates that became complete since then and, of
    older dates, its own arrivals: history is neither read again nor compared with the labels
    written. A headline without a date gets its reason at once.
    """
    noted_path = f"{pending_path}_complete"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.withColumn("published_on", F.to_date("published_at"))
        dated.write.mode("overwrite").partitionBy("published_on").parquet(f"{pending_path}/batch={batch_id}")
        until, before = as_of() - timedelta(days=buffer_days), None
        if batch_id > 0:
            before = spark.read.parquet(f"{noted_path}/batch={batch_id - 1}").first().until
            until = max(until, before)
        day, own = F.col("published_on"), F.col("batch") == batch_id
        fresh = own if before is None else own | (day > F.lit(before))
        waiting = spark.read.schema(_with_partitions(batch.schema)).parquet(pending_path).where(F.col("batch") <= batch_id)
        chosen = waiting.where((fresh & (day <= F.lit(until))) | (own & day.isNull())).select(*batch.columns)
        labels = label_headlines(chosen, prices(), earnings())
        labels.write.mode("overwrite").parquet(f"{labelled_path}/batch={batch_id}")
        spark.createDataFrame([(until,)], "until date").coalesce(1).write.mode("overwrite").parquet(f"{noted_path}/batch={batch_id}")

    return run


def _with_partitions(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("batch", LongType()), StructField("published_on", DateType())])
