"""The corpus pipeline against plain loops, stage by stage, on documents with planted copies, passages and abuse."""

import random

import duckdb
import pytest

import corpus_pipeline
from newsquake.llm import automaton
from newsquake.llm.common import Shelf, clearing, free
from newsquake.llm.oracle import ORACLE
from tests.llm.test_near_copies import kept_by_brute_force
from tests.llm.test_operators import edited, prose, removed

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, _id string, places string, _hash int, _scores int, _seen int, _cut int, scores int"


def planted():
    r = random.Random(2)
    shared, leak = prose("shared passage", 110, 4000), prose("leaked item", 40, 4000)
    docs = {i: prose(f"doc {i}", r.randrange(60, 160), 4000) for i in range(60)}
    docs |= {100 + i: edited(docs[i], i, 120) for i in range(12)} | {120 + i: docs[30 + i] for i in range(5)}
    docs |= {200 + i: f"{prose(f"a {i}", 120, 4000)} {shared} {prose(f"b {i}", 120, 4000)}" for i in range(4)}
    docs |= {300: f"{prose('c', 90, 4000)} {leak} {prose('d', 90, 4000)}", 301: leak, 302: None, 303: ""}
    toxic = {400 + i: f"{prose(f'e {i}', 40, 4000)} {w} {w} {prose(f'f {i}', 20, 4000)}" for i, w in enumerate(["wretch", "vermin"] * 20)}
    return docs, toxic, leak


@pytest.fixture
def folder(spark, tmp_path):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    docs, toxic, leak = planted()
    rows = [(i, t, "en", ("b", "a", None)[i % 3], len(t or ""), "r", "i", "p", 1, 2, 3, 4, 5) for i, t in (docs | toxic).items()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in docs if i % 2] + [(i, 1, 1) for i in toxic if i % 4 < 2]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def cut_by_loop(rows):
    texts = [(t or "").encode() for _, t in rows]
    return {i: bytes(b for b, g in zip(t, gone) if not g).decode("utf-8", "ignore") for (i, _), t, gone in zip(rows, texts, removed(texts, 200))}


def without_leak(text, leak):
    words, item = automaton.words_of((text or "").encode()), automaton.words_of(leak.encode())
    windows = {tuple(item[k : k + 10]) for k in range(len(item) - 9)}
    return {p for k in range(len(words) - 9) if tuple(words[k : k + 10]) in windows for p in range(k, k + 10)}, words


def test_every_stage_is_what_loops_find(spark, folder):
    docs, toxic, leak = planted()
    stages, held = dict(corpus_pipeline.STAGES), Shelf(spark, "held")
    assert list(stages) == ["toxicity", "near_dedup", "suffix_array_dedup", "benchmark_decontamination", "mixing_sources"]
    first = held.put(stages["toxicity"](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder))
    assert {r.doc_id for r in first.collect()} == set(docs)  # half of the toxic ones have no label
    second = held.put(stages["near_dedup"](spark, first, folder))
    assert sorted(r.doc_id for r in second.collect()) == kept_by_brute_force(list(docs.items())) and second.columns == first.columns
    rows = [(r.doc_id, r.text) for r in second.collect()]
    third = held.put(stages["suffix_array_dedup"](spark, second, folder))
    wanted = cut_by_loop(rows)
    assert {r.doc_id: r.text or "" for r in third.collect()} == wanted and any(len(wanted[i]) < len(t or "") for i, t in rows)
    assert all(r.n_chars is None or r.n_chars == len(r.text or "") for r in third.collect())
    fourth = held.put(stages["benchmark_decontamination"](spark, third, folder))
    stay = {r.doc_id: r.text for r in fourth.collect()}
    for i, text in wanted.items():
        hit, words = without_leak(text, leak)
        if 2 * len(hit) > len(words):
            assert i not in stay
        else:
            assert [w for k, w in enumerate(words) if k not in hit] == automaton.words_of((stay[i] or "").encode())
    assert 301 not in stay and len(stay) == len(wanted) - 1
    last = stages["mixing_sources"](spark, fourth, folder)
    fourth.write.parquet(f"{folder}/fourth.parquet")
    with duckdb.connect() as sql:
        sql.execute(f"create view documents as select * from '{folder}/fourth.parquet/*.parquet'")
        mix = {r[0]: r[4] for r in sql.execute(ORACLE["op4_mixing_sources"]).fetchall() if r[4]}
    taken = {r.doc_id: r.mix_taken for r in last.collect()}
    assert taken == mix
    whole = corpus_pipeline.run(spark, folder)
    assert {r.doc_id: r.mix_taken for r in whole.collect()} == mix and whole.columns == last.columns


def test_shelves_are_cleared_and_names_free(spark, folder, tmp_path):
    kept = Shelf(spark, "kept")
    with clearing():
        inner = Shelf(spark, "inner")
        written = kept.put(inner.put(spark.range(5)))
    assert written.count() == 5 and inner.paths == {} and kept.paths and Shelf.watched == []
    frame = spark.createDataFrame([(1, 2)], "_ID int, _id_ int")
    assert free("_id", frame) == "_id__" and free("other", frame) == "other"
