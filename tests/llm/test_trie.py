"""The conversation trie against one built turn by turn, with deep and repeated conversations, nulls, ties and weak bases."""

import hashlib
import math
import random
import re
import zlib

import pytest

from newsquake.llm import trie
from newsquake.llm.common import Shelf

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, depth int, conv string"


@pytest.fixture
def shelf(spark, tmp_path):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    return Shelf(spark, "trie")


def rows_of(convs):
    return [(c, k, role, text, "n", 1, "c") for c, turns in convs.items() for k, (role, text) in enumerate(turns)]


def rebuilt(convs):
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4 if c is not None else 0
        head = convs.get(c - int(math.fmod(c, 20)), [])[:h] if c is not None else []
        yield c, [(r or "", t or "") for r, t in head + turns[h:]]


def by_loop(convs):
    if not convs:
        return []
    root = {"kids": {}, "members": [], "ends": [], "words": 0, "up": None, "depth": 0}
    every = [root]
    for c, turns in rebuilt(convs):
        at = root
        at["members"].append(c)
        for turn in turns:
            if turn not in at["kids"]:
                at["kids"][turn] = {"kids": {}, "members": [], "ends": [], "words": len(re.findall(r"[^\x20\x09-\x0D]+", turn[1])), "up": at, "depth": at["depth"] + 1}
                every.append(at["kids"][turn])
            at = at["kids"][turn]
            at["members"].append(c)
        at["ends"].append(c)
    for node in reversed(every):
        kids = node["kids"].values()
        node["leaves"] = sum(k["leaves"] for k in kids) or 1
        node["saved"] = sum(k["saved"] for k in kids) + (len(node["members"]) - 1) * node["words"]
        node["least"] = min((c for c in node["members"] if c is not None), default=None)
    told = []
    for n in every:
        ends = ",".join("" if c is None else str(c) for c in sorted(n["ends"], key=lambda c: (c is not None, c)))
        up = n["up"]["least"] if n["up"] else None
        told.append((n["least"], n["depth"], up, len(n["members"]), len(n["kids"]), n["leaves"], n["saved"], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(told, key=str)


def as_rows(frame):
    return sorted((tuple(r)[:8] for r in frame.collect()), key=str)


def many():
    r = random.Random(3)
    turn = lambda: (r.choice(["user", "assistant", None, ""]), r.choice(["hello there", "go on", "", None, "1:user", " two  words\n", "ok"]))
    convs = {c: [turn() for _ in range(r.choice([1, 1, 2, 3, 5, 8]))] for c in range(0, 400) if c % 7}
    for c in range(1000, 1100):  # copies, and a first turn most share
        convs[c] = [("user", "the same start")] * 3 + [turn() for _ in range(2)] if c % 3 else [("user", "a"), ("assistant", "b"), ("user", "c"), ("user", "d")]
    convs[-1], convs[-20], convs[None] = [turn()], [turn() for _ in range(4)], [turn() for _ in range(3)]
    return convs


def test_nodes_are_those_of_a_trie(spark, shelf):
    convs = many()
    rows = rows_of(convs)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert as_rows(trie.prefix_trie(docs, shelf)) == by_loop(convs)


def test_conversations_spread_over_partitions(spark, shelf, monkeypatch):
    r = random.Random(8)
    long = [("user", f"turn {r.randrange(50)}") for _ in range(900)]
    convs = {5: long, 25: long[:700] + [("user", "else")] + long[700:], 40: long[:3] + [("user", "x")], 47: [("a", "b")], 65: long[:2]}
    monkeypatch.setattr(trie, "PIECE", 2)
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame(rows_of(convs), SCHEMA)
        turns = trie.stored_turns(docs, "conv_id", "turn", "role", "text")
        products = trie.prefix_products(turns, shelf, trie.base_of(0)).orderBy("conv", "pos").collect()
        assert [(p.conv, p.pos) for p in products] == [(c, k) for c, turns in sorted(convs.items()) for k in range(len(turns))]
        assert as_rows(trie.prefix_trie(docs, shelf)) == by_loop(convs)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_equal_fingerprints_of_different_prefixes_are_told_apart(spark, shelf):
    convs = {1: [("u", "a"), ("u", "b"), ("u", "c"), ("u", "d")], 2: [("u", "a"), ("u", "b"), ("u", "d"), ("u", "c")], 3: [("u", "b"), ("u", "a")]}
    convs |= {k: [("u", x) for x in y] for k, y in zip(range(4, 30), ["abcd", "bacd", "dcba", "cabd", "dabc"] * 6)}
    tried = []

    def weak(attempt):
        tried.append(attempt)
        return trie.base_of(attempt) if attempt else 1  # in base 1 a product does not know the order of its turns

    docs = spark.createDataFrame(rows_of(convs), SCHEMA)
    assert as_rows(trie.prefix_trie(docs, shelf, base_for=weak)) == by_loop(convs) and tried == [0, 1]


def test_ties_repeats_and_long_texts(spark, shelf):
    rows = [(1, 0, "u", "x", "n", 1, "c")] * 3 + [(2, 5, "u", t, "n", 1, "c") for t in ("b", "a", "w " * 200_000)] + [(3, None, "u", "late", "n", 1, "c"), (3, 1, "u", "x", "n", 1, "c")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = as_rows(trie.prefix_trie(docs, shelf))
    assert found == as_rows(trie.prefix_trie(docs.orderBy("text").repartition(3), shelf))
    assert max(r[1] for r in found) <= 3 and found[0][3] == 3


def test_nothing_and_monoid(spark, shelf):
    docs = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(docs, shelf).count() == 0
    r, base = random.Random(1), trie.base_of(0)
    a, b, c = ((pow(base, n, trie.PRIME), r.getrandbits(127) % trie.PRIME) for n in (2, 5, 1))
    assert trie.combine(trie.combine(a, b), c) == trie.combine(a, trie.combine(b, c))
    assert trie.after(trie.combine(a, b), a, 5, base) == b
