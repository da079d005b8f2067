"""Exact duplicates against a loop, with heavy groups, nulls, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import pytest

from newsquake.llm import exact
from newsquake.llm.common import Shelf

SCHEMA = "doc_id bigint, text string, row string, digest string, tie int, `a.b` string, keep_id int"


@pytest.fixture
def shelf(spark, tmp_path):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    return Shelf(spark, "exact")


def rows_of(pairs):
    return [(i, t, f"r{k}", "d", k, "x", 1) for k, (i, t) in enumerate(pairs)]


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def by_loop(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(plain(t), []).append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted((str(i), str(least[plain(t)]), len(groups[plain(t)]), hashlib.sha256(plain(t).encode()).hexdigest()) for i, t in pairs)


def pairs():
    r = random.Random(1)
    heavy = [(900 + k, "the  same\ttext" if k % 2 else "the same\n\ntext") for k in range(300)]
    light = [(k, f"text {r.randrange(200)}{' ' * (1 + k % 3)}end") for k in range(500)]
    odd = [(2000, None), (2001, ""), (2002, " "), (2003, "\n\t"), (2004, " "), (2005, "é x"), (2006, "é  x"), (2007, "Text 1 end"), (2008, "a" * 300_000), (2009, "a" * 300_000)]
    twice = [(3000, "twice"), (3000, "twice"), (None, "twice"), (None, "no id"), (None, "no id"), (None, "text 1 end")]
    return heavy + light + odd + twice


@pytest.mark.parametrize("counters, heavy", [(1024, 256), (8, 4), (1, 1), (4000, 4000)])
def test_groups_are_those_of_a_loop(spark, shelf, counters, heavy):
    docs = spark.createDataFrame(rows_of(pairs()), SCHEMA).repartition(5)
    found = exact.find_copies(docs, shelf, counters=counters, heavy=heavy).collect()
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.digest.hex()) for r in found) == by_loop(pairs())
    kept = Counter(r.digest for r in found if r.kept)
    assert set(kept) == {r.digest for r in found} and set(kept.values()) == {1}
    assert all(r.id == r.keep_id for r in found if r.kept)


def test_heavy_digests_are_exact_and_few(spark, shelf):
    texts = [(k, "hot" if k % 3 == 0 else "warm" if k % 10 == 1 else f"t{k}") for k in range(3000)]
    rows = exact.numbered(spark.createDataFrame(rows_of(texts), SCHEMA).repartition(7), shelf)
    found = exact.heavy_digests(rows, shelf, counters=20, heavy=20).collect()
    names = {hashlib.sha256(t.encode()).digest(): t for _, t in texts}
    assert {names[bytes(r.digest)]: r.group_size for r in found} == {"hot": 1000, "warm": sum(t == "warm" for _, t in texts)}


def test_summary_loses_at_most_its_share():
    r = random.Random(4)
    stream = [int(r.paretovariate(0.7)) for _ in range(5000)]
    held = {}
    for at in range(0, len(stream), 100):
        for k, n in Counter(stream[at : at + 100]).items():
            held[k] = held.get(k, 0) + n
        held = exact.lighter(held, 9)
    true = Counter(stream)
    assert len(held) <= 9 and all(0 <= true[k] - n <= len(stream) / 10 for k, n in held.items())
    assert all(k in held for k, n in true.items() if n > len(stream) / 10)


def test_rows_that_stay_are_unchanged(spark, shelf):
    docs = spark.createDataFrame(rows_of(pairs()), SCHEMA).repartition(3)
    kept = exact.without_copies(docs, shelf)
    assert kept.schema == docs.schema
    rows = {tuple(r) for r in docs.collect()}
    once = kept.collect()
    assert all(tuple(r) in rows for r in once) and len(once) == len({plain(t) for _, t in pairs()}) == len({plain(r.text) for r in once})
    again = exact.without_copies(docs.repartition(6), shelf).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in once}


def test_nothing_gives_nothing(spark, shelf):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact.find_copies(docs, shelf).count() == 0 and exact.without_copies(docs, shelf).columns == docs.columns
