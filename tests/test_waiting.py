import datetime as dt
import time

from pyspark.sql import functions as F

from newsquake.plans.label import label_headlines
from newsquake.streaming import feed, waiting

SCHEMA = "feed_pos long, ticker string, title string, published_at timestamp"


def drain(writer, folder):
    run = writer.option("checkpointLocation", str(folder)).trigger(once=True).start()
    ended = run.awaitTermination(90)
    if not ended:
        run.stop()
    assert ended and run.exception() is None


def stream_of(spark, path):
    return feed.read_feed(spark, path, spark.read.parquet(path).schema, 1)


def positions(spark, path):
    return sorted(r.feed_pos for r in spark.read.parquet(path).collect())


def test_labels_from_state_equal_the_batch(spark, tmp_path):
    path, out = str(tmp_path / "landing"), str(tmp_path / "labelled")
    today = dt.datetime.combine(spark.sql("select current_date() d").first().d, dt.time(12))
    days = [today.date() - dt.timedelta(days=i) for i in range(200)]
    prices = spark.createDataFrame([(t, d, 100.0 + (i * 37) % 11) for t in "AB" for i, d in enumerate(days)], "ticker string, trade_date date, close double")
    # Ages around the 39 days, one old and late, one undated, one without ticker, one row twice; half under one key.
    ages = [10, 38, 39, 40, 90, 60, 150, 120]
    rows = [(i, "A" if i % 4 else "B", f"title {i}", today - dt.timedelta(days=a)) for i, a in enumerate(ages * 4)]
    rows += [(100, "A", "undated", None), (101, None, "nobody's", today - dt.timedelta(days=50)), rows[2]]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    write = waiting.label_complete(out, lambda: prices, lambda: None)
    for _ in range(2):
        drain(waiting.complete_headlines(stream_of(spark, path)).writeStream.foreachBatch(write), tmp_path / "state")
        late = [(200, "B", "late", today - dt.timedelta(days=170)), (201, "B", "early", today)]
        spark.createDataFrame(late, SCHEMA).write.mode("append").parquet(path)
    everything = spark.createDataFrame(rows + late, SCHEMA)
    told = everything.where(F.col("published_at").isNull()).union(feed.ready(everything, today.date()))
    columns = ["feed_pos", "news_reaction", "skip_reason"]
    expected = label_headlines(told, prices).select(columns).collect()
    assert len(expected) > 20
    assert sorted(map(str, spark.read.parquet(out).select(columns).collect())) == sorted(map(str, expected))


def test_waiting_headlines_survive_a_restart_and_come_out_once(spark, tmp_path):
    path, out = str(tmp_path / "landing"), str(tmp_path / "out")
    soon = dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=25)
    start = soon - dt.timedelta(days=1)
    rows = [(i, "AB"[i % 2], f"title {i}", start + dt.timedelta(days=300 * (i % 3 == 2))) for i in range(30)]
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.parquet(path)
    due = F.col("published_at") + F.expr("interval 1 day")

    def run():
        found = waiting.complete_headlines(stream_of(spark, path), due=due)
        drain(found.writeStream.format("parquet").option("path", out), tmp_path / "state")

    run()
    assert dt.datetime.now(dt.timezone.utc) < soon and positions(spark, out) == []
    while dt.datetime.now(dt.timezone.utc) <= soon:
        time.sleep(1)
    spark.createDataFrame([(90, "A", "late", start - dt.timedelta(days=9))], SCHEMA).write.mode("append").parquet(path)
    run()
    spark.createDataFrame([(91, "C", "late", start - dt.timedelta(days=9))], SCHEMA).write.mode("append").parquet(path)
    run()
    assert positions(spark, out) == sorted([i for i in range(30) if i % 3 != 2] + [90, 91])
