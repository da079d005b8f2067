"""Spelling variants against all pairs of words, with runs of equal letters, long words, ties, nulls and chains."""

import random
import re
import zlib
from collections import Counter

import pytest

from newsquake.llm import variants
from newsquake.llm.common import Shelf, table
from newsquake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, word string, rank int, n int, kind string"
DATA = "/root/testdata/sf0.001"


@pytest.fixture
def shelf(spark, tmp_path):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    return Shelf(spark, "variants")


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_loop(rows, ratio=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], counts[form[w]] if form[w] else None, root))
    return sorted(out, key=str)


def as_rows(frame):
    return sorted((tuple(r) for r in frame.select("word", "n", "n_near", "form", "form_n", "root").collect()), key=str)


def crowd():
    """Words a few edits around some roots, from an alphabet of few letters, so that runs and ties are common."""
    r = random.Random(7)
    words = []
    for root in ["aabbaabb", "abababab", "ééÿÿàà", "aaaaaaa", "letterhead", "×÷×÷×÷", "banana" * 3, "z" * 60, "mississippi" * 9]:
        for _ in range(60):
            w = list(root)
            for _ in range(r.choice([0, 1, 1, 1, 2])):
                at = r.randrange(len(w))
                w[at : at + r.randrange(2)] = r.choice(["", root[at % len(root)], "a", "b", "é", root[at % len(root)] * 2])
            words += ["".join(w)] * r.choice([1, 2, 5, 5, 30, 160])
    r.shuffle(words)
    return words


def test_near_words_forms_and_roots_are_those_of_all_pairs(spark, shelf):
    words = crowd()
    texts = [(k, " ".join(words[k::40]) + " Letterhead LETTERHEAD, É-é") for k in range(40)]
    texts += [(40, None), (41, ""), (42, " 12 āĂ "), (None, "aabbaabb " * 9), (43, texts[0][1]), (43, texts[0][1]), (44, ("aabbaabb" + " letterhead") * 4000)]
    docs = spark.createDataFrame([(i, t, "w", 1, 2, "k") for i, t in texts], SCHEMA)
    found = as_rows(variants.group_variants(docs.repartition(5), shelf))
    assert found == by_loop(texts) and len(found) > 150 and any(r[3] and r[3] != r[5] for r in found)


def test_words_of_the_tables(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, DATA, "documents").select("doc_id", "text").collect()]
    assert as_rows(QUERIES["op12_spelling_variants"](spark, DATA)) == by_loop(rows)


def test_very_long_words_and_nothing(spark, shelf):
    long = "xy" * 20_000
    rows = [(k, f"{long} {long}q {long[1:]}") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.word: r.n_near for r in variants.group_variants(docs, shelf).collect() if r.n >= 5}
    wanted = {w: n for w, _, n, *_ in by_loop(rows)}
    assert found == wanted and len(wanted) == 3
    assert variants.group_variants(docs.limit(0), shelf).count() == 0
