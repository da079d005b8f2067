"""The near-dedup stage against all pairs: scattered, block and appended edits, short texts and crowded families."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsquake.llm import overlap
from newsquake.llm.common import Shelf
from tests.llm.test_operators import edited, prose


@pytest.fixture
def shelf(spark, tmp_path):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    return Shelf(spark, "near")


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_texts():
    texts, r = [], random.Random(5)
    line = prose("line", 9)
    for seed, n in enumerate([6, 8, 12, 20, 20, 40, 60, 90, 150, 150, 300, 700]):
        words = prose(f"near {seed}", n).split()
        cut = r.randrange(n // 2)
        block = [*words[:cut], *(f"b{seed}x{i}" for i in range(n // 12)), *words[cut + n // 12 :]]
        texts += [" ".join(words), " ".join(block), " ".join(words + [f"a{seed}x{i}" for i in range(n // 5)])]
        texts += [" ".join(words[: n - n // 6]), " ".join(words + [f"one{seed}"]), edited(" ".join(words), seed, 45), edited(" ".join(words), -seed, 30)]
    family = prose("family", 80)
    texts += [f"{edited(family, f'member {i}', 25)} {line}" for i in range(40)]
    texts += [f"{prose(f'far {i}', 30)} {line}" for i in range(40)] + [None, "", " \n", texts[0].upper(), texts[8]]
    return texts


def kept_by_brute_force(rows):
    root = list(range(len(rows)))
    sets = [shingles(t) for _, t in rows]
    for a, b in itertools.combinations(range(len(rows)), 2):
        both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if union == 0 or both >= 0.8 * union - 1e-9:
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = [new if x == old else x for x in root]
    return sorted(rows[k][0] for k in set(root))


def test_all_pairs_of_the_similarity_link(spark, shelf, monkeypatch):
    rows = list(enumerate(near_texts()))
    wanted = kept_by_brute_force(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in overlap.one_of_each(docs, shelf).collect()) == wanted
    monkeypatch.setattr(overlap, "SAMPLE", 1)  # with shingles that come late
    assert sorted(r.doc_id for r in overlap.one_of_each(docs, shelf).collect()) == wanted


def test_bounds_lose_no_pair():
    r = np.random.default_rng(3)
    for n, share in itertools.product([1, 4, 5, 9, 50, 400], [0.5, 0.8, 0.9]):
        for _ in range(50):
            pool = r.integers(0, 2**63, 2 * n).astype(np.uint64)
            a, b = np.unique(pool[: n + r.integers(0, n // 4 + 1)]), np.unique(pool[r.integers(0, n // 4 + 1) : n])
            both = len(np.intersect1d(a, b))
            apart = len(a) + len(b) - 2 * both
            assert sum(int(x).bit_count() for x in (overlap.sketch(a) ^ overlap.sketch(b)).view(np.uint64)) <= apart
            if both and both >= share * (apart + both):
                firsts = [x[: overlap.prefix_length(len(x), share)] for x in (a, b)]
                assert len(np.intersect1d(*firsts))


def test_simhash_search_links_close_texts_before_the_exact_one(spark, shelf):
    words = prose("soup", 200, 4000).split()
    same_words = [" ".join(random.Random(i).sample(words, len(words))) for i in range(30)]  # one SimHash of words, unlike shingles
    base = [prose(f"long {i}", 300, 4000) for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(base + [edited(t, i, 200) for i, t in enumerate(base)] + same_words)), "doc_id bigint, text string")
    nodes = shelf.put(overlap.signed(docs, shelf, 5, 0.8, "doc_id", "text").withColumnRenamed("row", "node"))
    asked = []

    def confirm(pairs):
        asked.extend(pairs.collect())
        return pairs

    found = {r.node: r.root for r in overlap.simhash_classes(nodes, confirm, shelf).collect()}
    ids = {r.id: r.node for r in nodes.collect()}
    assert sum(ids[i] in found and found[ids[i]] == found.get(ids[i + 12]) for i in range(12)) >= 7
    unlike = {ids[i] for i in range(24, 54)}
    assert len(asked) <= 24 and sum({r.a, r.b} <= unlike for r in asked) <= 20  # of 435 such pairs, which all have one SimHash of words


def test_prefixes_share_as_many_as_are_needed():
    r = np.random.default_rng(4)
    close = 0
    for n, share in itertools.product([1, 4, 5, 9, 50, 400], [0.5, 0.8, 0.9]):
        for _ in range(100):
            pool = r.integers(0, 2**63, 2 * n).astype(np.uint64)
            a, b = np.unique(pool[: n + r.integers(0, n // 4 + 1)]), np.unique(pool[r.integers(0, n // 4 + 1) : n])
            both = len(np.intersect1d(a, b))
            if both and both >= share * (len(a) + len(b) - both):
                close += 1
                firsts = [x[: overlap.prefix_length(len(x), share)] for x in (a, b)]
                assert len(np.intersect1d(*firsts)) >= overlap.needed(len(a), len(b), share)
    assert close > 300 and overlap.needed(1000, 1000, 0.8) > 80


def test_crowd_of_edited_copies_is_not_compared_pair_by_pair(spark, shelf):
    base = prose("crowd", 300, 4000)
    docs = shelf.put(spark.createDataFrame([(i, edited(base, f"member {i}", 60)) for i in range(240)], "doc_id bigint, text string"))
    signed = overlap.signed(docs, shelf, 5, 0.8, "doc_id", "text").withColumnRenamed("row", "node")
    nodes = shelf.put(signed.withColumn("folded", F.lit(1).cast("bigint")))
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    confirm = overlap.as_similar(texts, nodes.select("node", "id", "text_hash", "folded"), 5, 0.8, shelf)
    asked = []

    def counted(pairs):
        asked.append(pairs.count())
        return confirm(pairs)

    found = overlap.simhash_classes(nodes, counted, shelf)
    assert max(n for _, n in found.groupBy("root").count().collect()) >= 100
    assert sum(asked) <= 3 * 240
