import datetime as dt

from pyspark.sql import functions as F

from newsquake.plans.label import label_headlines
from newsquake.streaming import feed

SCHEMA = "feed_pos long, ticker string, title string, published_at timestamp"


def arrivals(spark):
    rows = [
        (i, "AB"[i % 2], f"title {i % 40}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i)) for i in range(120)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    arrivals(spark).repartitionByRange(4, "published_at").write.parquet(path)
    return path


def drain(writer, tmp_path, name):
    run = writer.option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True).start()
    run.awaitTermination(240)
    assert run.exception() is None


def test_weekly_counts_equal_the_batch(spark, tmp_path):
    path = landing(spark, tmp_path)
    stream = feed.weekly_counts(feed.read_feed(spark, path, spark.read.parquet(path).schema, 1))
    drain(stream.writeStream.outputMode("complete").format("memory").queryName("weeks"), tmp_path, "weeks")
    batch = feed.weekly_counts(spark.read.parquet(path))
    assert sorted(map(tuple, spark.table("weeks").collect())) == sorted(map(tuple, batch.collect()))


def test_titles_are_seen_once(spark, tmp_path):
    path = landing(spark, tmp_path)
    stream = feed.unseen_titles(feed.read_feed(spark, path, spark.read.parquet(path).schema, 1))
    drain(stream.writeStream.outputMode("append").format("memory").queryName("titles"), tmp_path, "titles")
    got = [(r["ticker"], r["title"]) for r in spark.table("titles").collect()]
    assert len(got) == len(set(got)) == feed.unseen_titles(spark.read.parquet(path)).count()


def test_titles_are_remembered_for_good(spark, tmp_path):
    out, index = str(tmp_path / "out"), str(tmp_path / "index")
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    batches = [[(k * 10 + i, "AB"[i % 2], f"title {(k * 3 + i) % 17}", day(40 * k)) for i in range(6)] for k in range(9)]
    batches[2] += [(90, "A", None, day(80)), (91, None, "title 1", day(80)), (92, "A", "", None), (93, "A", "", day(1))]
    batches[8] += [(94, "A", None, day(320)), (95, "A", "title 0", day(320))]  # the same title 320 days later
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in batches]
    write = feed.first_titles(index, out, buckets=5, merge_every=3)
    for n, frame in enumerate(frames):
        write(frame, n)
        if n in (3, 6):  # a batch that is run again, once right after a merge
            write(frame, n)
        assert len([p for p in (tmp_path / "index" / "runs").iterdir()]) <= 3
    got = sorted((str(r.ticker), str(r.title), r.batch) for r in spark.read.parquet(out).collect())
    first = {}
    for n, rows in enumerate(batches):
        for _, ticker, title, _ in rows:
            first.setdefault((str(ticker), str(title)), n)
    assert got == sorted((*key, n) for key, n in first.items())
    assert {r.feed_pos for r in spark.read.parquet(out).where("title = ''").collect()} == {93}


def test_a_stream_restarted_in_between_remembers_titles(spark, tmp_path):
    path = landing(spark, tmp_path)
    write = feed.first_titles(str(tmp_path / "index"), str(tmp_path / "out"), merge_every=2)
    schema = spark.read.parquet(path).schema
    for _ in range(2):  # the second run sees files that arrived after the first
        drain(feed.read_feed(spark, path, schema, 1).writeStream.foreachBatch(write), tmp_path, "all-titles")
        late = [(500 + i, "A", f"title {30 + i}", dt.datetime(2024, 9, 1)) for i in range(20)]
        spark.createDataFrame(late, SCHEMA).write.mode("append").parquet(path)
    got = [(r.ticker, r.title) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    everything = {(r.ticker, r.title) for r in spark.read.parquet(path).collect()}
    assert len(got) == len(set(got)) and set(got) == everything


def test_labels_wait_for_their_forward_window(spark, tmp_path):
    path = landing(spark, tmp_path)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(-3, 90)]
    prices = spark.createDataFrame([(t, d, 100.0 + (i * 37) % 11) for t in "AB" for i, d in enumerate(days)], "ticker string, trade_date date, close double")
    clock = {"today": dt.date(2024, 2, 20)}
    out = str(tmp_path / "labelled")
    write = feed.label_when_complete(str(tmp_path / "pending"), out, lambda: prices, lambda: None, lambda: clock["today"])
    stream = feed.read_feed(spark, path, spark.read.parquet(path).schema, 1)
    drain(stream.writeStream.foreachBatch(write), tmp_path, "labels")
    ready = spark.read.parquet(path).where(F.to_date("published_at") <= F.date_sub(F.lit(clock["today"]), 39))
    done = spark.read.parquet(out)
    columns = ["feed_pos", "news_reaction", "skip_reason"]
    assert sorted(map(str, done.select(columns).collect())) == sorted(map(str, label_headlines(ready, prices).select(columns).collect()))
    noted = spark.read.parquet(str(tmp_path / "pending_complete"))
    assert {r["until"] for r in noted.collect()} == {dt.date(2024, 1, 12)}
    clock["today"] = dt.date(2025, 1, 1)
    write(arrivals(spark).limit(0), 4)
    write(arrivals(spark).limit(0), 4)
    assert sorted(r["feed_pos"] for r in spark.read.parquet(out).collect()) == list(range(120))
