"""The classifier chain: groups of words from the sample, scores against plain arithmetic, held-out accuracy."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsquake.llm import toxicity as T
from newsquake.llm.common import Shelf, table

DATA = "/root/testdata/sf0.1"


@pytest.fixture
def shelf(spark, tmp_path):
    return Shelf(spark, str(tmp_path.name))


def made_rows(spark):
    """Toxic rows of two kinds, each with words the other lacks, none of them in any list; clean rows have neither."""
    kinds = (["zorbly", "quixnark", "flumpet"], ["gribbit", "snarfle", "wozzled"])
    rows, labels = [], []
    for i in range(240):
        told = [f"plain{i % 7}", f"common{i % 5}"]
        if i % 2:
            kind = kinds[(i // 2) % 2]
            told += [kind[(i // 4) % 3], kind[(i // 4 + 1) % 3]]
        rows.append((i, " ".join(told)))
        labels.append((i, i % 2))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), kinds


def test_kinds_come_from_the_sample(spark, shelf):
    docs, labels, kinds = made_rows(spark)
    scored = {r.doc_id: r.scores for r in T.score(docs, T.train(docs, labels, shelf)).collect()}
    mine = {i: tuple(round(p) for p in (s.p_kind_a, s.p_kind_b, s.p_toxic)) for i, s in scored.items()}
    assert {mine[i] for i in mine if i % 2 == 0} == {(0, 0, 0)}
    assert {mine[i] for i in mine if i % 4 == 1} | {mine[i] for i in mine if i % 4 == 3} == {(1, 0, 1), (0, 1, 1)}
    assert len({mine[i] for i in mine if i % 4 == 1}) == 1


def test_groups_by_hand():
    words = ["a", "a*", "b", "c", "d", "x"]
    x = np.array([[1, 1, 1, 0, 0, 1], [1, 1, 0, 0, 0, 1], [1, 1, 1, 0, 0, 0], [0, 0, 0, 1, 1, 0], [0, 0, 0, 1, 0, 1], [0, 0, 0, 0, 0, 1], [0, 0, 0, 0, 0, 1]])
    toxic = np.array([1, 1, 1, 1, 1, 0, 0])
    assert T.split_words(words, x, toxic) == ([0, 2], [3, 4])  # the beginning and the word of clean rows are left out
    assert T.split_words(words, x, np.zeros(7)) == ([], [])
    assert T.split_words(["a"], x[:, :1], toxic) == ([0], [])
    assert T.split_words([], x[:, :0], toxic) == ([], [])


def test_scores_against_plain_arithmetic(spark, shelf):
    docs, labels, _ = made_rows(spark)
    chain = T.train(docs, labels, shelf)
    texts = [(0, None), (1, ""), (2, "ZORBLY Quixnark plain1"), (3, "wozzled snarfle " + "plain2 " * 200_000), (4, "?!")]
    extra = spark.createDataFrame([(i, t, "own", 7) for i, t in texts], "doc_id bigint, text string, scores_ string, words int")
    got = {r.doc_id: r for r in T.score(extra, chain).collect()}
    for i, text in texts:
        words = set(re.findall(T.LETTER_WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or "")))
        bag = words | {w[:n] + "*" for w in words for n in T.PREFIXES}
        p = []
        for weights in chain.weights:
            z = weights[-1] + sum(weights[k] for k, w in enumerate(chain.words) if w in bag)
            z += sum(v * weights[len(chain.words) + k] for k, v in enumerate(p))
            p.append(1 / (1 + math.exp(-min(30, max(-30, z)))))
        s = got[i].scores
        assert [s.p_kind_a, s.p_kind_b, s.p_toxic] == pytest.approx(p)
        assert s.toxic == (bool(words) and p[-1] >= T.LIMIT) and got[i].scores_ == "own" and got[i].words == 7
    assert got[2].scores.toxic and got[3].scores.toxic and not any(got[i].scores.toxic for i in (0, 1, 4))


def test_held_out_rows(spark, shelf):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    chain = T.train(docs, labels.where(half == 0), shelf)
    judged = T.score(docs, chain).join(labels.where(half == 1).select("doc_id", "toxic"), "doc_id").select("toxic", F.col("scores.toxic").cast("int").alias("said")).collect()
    caught = [r.said for r in judged if r.toxic == 1]
    clean = [r.said for r in judged if r.toxic == 0]
    assert len(caught) > 200 and len(clean) > 1500
    # Measured 0.947 and 0.041, with the word lists used before 0.934 and 0.041.
    assert sum(caught) / len(caught) >= 0.9 and sum(clean) / len(clean) <= 0.05
    # The two finer categories have rows on both sides, so the chain carries something.
    assert all(np.abs(w[:-1]).sum() > 0 for w in chain.weights)


def test_no_labels_ties_and_repeats(spark, shelf):
    docs, labels, _ = made_rows(spark)
    none = T.score(docs, T.train(docs, labels.limit(0), shelf))
    assert none.where("scores.toxic").count() == 0 and none.count() == 240
    assert T.score(docs.limit(0), T.train(docs, labels, shelf)).count() == 0
    once = T.train(docs, labels, shelf)
    again = T.train(docs.union(docs).repartition(7), labels.union(labels).repartition(3), shelf)
    assert once.words == again.words and all(np.array_equal(a, b) for a, b in zip(once.weights, again.weights))
