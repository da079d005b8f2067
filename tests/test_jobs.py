"""Versioned folders, the row store and the jobs made of them, cut off at every step and run again."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from newsquake.plans import jobs, rows
from newsquake.schemas import ROW, ROW_FIELDS
from newsquake.sources import versions
from newsquake.sources.store import RowStore
from newsquake.sources.tables import Tables

DATA = "/root/testdata/sf0.001"
TODAY = "2002-01-01"
HELD = ["NATION_3", "NATION_7"]


def day():
    return F.lit(TODAY).cast("date")


def contents(spark, path):
    return sorted(r.v for r in versions.current(spark, path).collect())


def test_versions_replace_each_other_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = lambda *values: spark.createDataFrame([(v,) for v in values], "v int")
    assert versions.current_path(spark, path) is None
    with pytest.raises(FileNotFoundError):
        versions.current(spark, path)
    assert versions.publish(frame(1, 2), path) == 1
    reader = versions.current(spark, path)
    assert versions.publish(versions.current(spark, path).select((F.col("v") + 10).alias("v")), path) == 2  # computed from itself
    assert sorted(r.v for r in reader.collect()) == [1, 2] and contents(spark, path) == [11, 12]  # a reader that began before
    assert versions.publish(frame(5), path) == 3 and versions.versions(spark, path) == [2, 3]
    assert not os.path.exists(versions.version_path(path, 1)) and contents(spark, path) == [5]


def test_a_writer_that_stops_leaves_nothing_that_counts(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    versions.publish(spark.range(3).select(F.col("id").alias("v")), path)
    other = spark.range(100, 200).select(F.col("id").alias("v"))
    with monkeypatch.context() as m:
        m.setattr(versions, "mark", lambda *a: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            versions.publish(other, path)  # rows written, mark missing
    assert contents(spark, path) == [0, 1, 2]
    assert versions.publish(spark.range(1).select(F.col("id").alias("v")), path) == 2 and contents(spark, path) == [0]
    versions.mark(spark, f"{path}/{versions.MARKERS}/00000003")
    with pytest.raises(Exception, match="(?i)exist"):
        versions.mark(spark, f"{path}/{versions.MARKERS}/00000003")  # the second of two writers


def some(spark, ticker, n, split="train", text="t"):
    told = {"task": F.lit("reaction"), "ticker": F.lit(ticker), "news_reaction": F.lit("good"), "news": F.concat(F.lit(text), F.col("id").cast("string"))}
    return spark.range(n).select(*[told.get(f, F.lit("")).alias(f) for f in ROW_FIELDS], F.lit(split).alias("split"))


def counted(store):
    return sorted((r.split, r.ticker, r.news) for r in store.rows().collect())


def test_steps_count_once_however_often_they_run(spark, tmp_path, monkeypatch):
    store = RowStore(spark, str(tmp_path / "rows"))
    assert store.rows().count() == 0 and store.done().count() == 0 and store.rows("val").columns == list(ROW_FIELDS)
    assert store.write(some(spark, "A", 5).union(some(spark, "B", 3, "val"))) == 1
    first = counted(store)
    assert len(first) == 8 and {r.ticker for r in store.done().collect()} == {"A", "B"}
    assert store.write(some(spark, "A", 5)) == 2 and counted(store) == first  # the same entity again
    for broken in ("place", "finish"):
        with monkeypatch.context() as m:
            real = getattr(RowStore, broken)

            def cut(self, staged, real=real):
                real(self, staged) if broken == "place" else None
                raise OSError("cut off")

            m.setattr(RowStore, broken, cut)
            with pytest.raises(OSError):
                store.write(some(spark, "C", 4))  # rows may lie there, but do not count
        assert counted(store) == first and "C" not in {r.ticker for r in store.done().collect()}
    assert store.write(some(spark, "C", 4)) == 3 and len(counted(store)) == 12
    store.write(some(spark, "B", 2, "train", "u"))  # an entity that moved to the other split leaves nothing behind
    assert [r for r in counted(store) if r[1] == "B"] == [("train", "B", "u0"), ("train", "B", "u1")] and store.rows("val").count() == 0
    assert sorted(map(tuple, store.manifest().collect())) == [("train", "A", 5), ("train", "B", 2), ("train", "C", 4)]


def test_folders_hold_plain_rows(spark, tmp_path):
    store = RowStore(spark, str(tmp_path / "rows"))
    store.write(some(spark, "a/b=c", 2).union(some(spark, "7", 1)))
    assert sorted(r.ticker for r in store.rows().collect()) == ["7", "a/b=c", "a/b=c"]
    assert store.rows("train").schema == ROW
    plain = spark.read.schema(ROW).json(f"{tmp_path}/rows/rows/split=train/entity=7")
    assert plain.count() == 1 and plain.first().ticker == "7"


@pytest.fixture(scope="module")
def tables(spark):
    if not os.path.isdir(DATA):
        pytest.skip("sample tables are not here")
    return Tables(spark, DATA)


def listed(frame):
    return sorted(tuple(r) for r in frame.select("split", *ROW_FIELDS).collect())


def test_interrupted_runs_and_a_clean_run_store_the_same_rows(spark, tmp_path, tables, monkeypatch):
    clean = RowStore(spark, str(tmp_path / "clean"))
    assert jobs.generate_rows(tables, clean, day(), HELD, groups=2) == 2
    wanted = listed(clean.rows())
    assert wanted == listed(rows.finished_rows(jobs.kept_headlines(tables), day(), HELD)) and len(wanted) > 20
    store, calls = RowStore(spark, str(tmp_path / "cut")), []
    real = RowStore.finish

    def finish(self, staged):
        calls.append(1)
        if len(calls) in (1, 3):  # the first step of the first run and the second of the next one
            raise OSError("cut off")
        return real(self, staged)

    monkeypatch.setattr(RowStore, "finish", finish)
    for _ in range(2):
        with pytest.raises(OSError):
            jobs.generate_rows(tables, store, day(), HELD, groups=2)
    assert 0 < store.done().count() < clean.done().count()
    assert jobs.generate_rows(tables, store, day(), HELD, groups=2) >= 1
    assert listed(store.rows()) == wanted
    before = store.steps()
    jobs.generate_rows(tables, store, day(), HELD, groups=2)
    assert listed(store.rows()) == wanted and len(store.steps()) - len(before) <= 2  # only entities without rows are tried


def test_balanced_rows_are_published(spark, tmp_path):
    store = RowStore(spark, str(tmp_path / "rows"))
    store.write(some(spark, "A", 70).union(some(spark, "B", 9, "val")))
    path = str(tmp_path / "train")
    assert jobs.balance_rows(store, path) == 1 and jobs.balance_rows(store, path) == 2
    texts = [[r.news for r in spark.read.schema(ROW).json(versions.version_path(path, n)).collect()] for n in (1, 2)]
    assert texts[0] == texts[1] and len(texts[0]) == 30 and texts[0] != sorted(texts[0])
    shutil.rmtree(tmp_path / "train" / versions.MARKERS)
    assert versions.current_path(spark, path) is None
