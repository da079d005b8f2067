"""Spelling variants by a dictionary of trie-node pairs.

Every prefix of a word is a node of the trie of all words, every suffix a node of the trie of the reversed words, and
both tries' nodes are numbered. A word has two kinds of integer pairs (prefix node, suffix node):

* split pairs: the prefix up to a place and the suffix from it, which together are the word;
* skip pairs: the prefix up to a place and the suffix after the next code point, which leave that code point out.

Two words with one skip pair differ in that code point only, and a word whose split pair is another's skip pair lacks
that code point. So one grouping of all pairs finds exactly the words one replaced, inserted or deleted code point
apart. A group holds at most one word by its split pair and, as its members differ in one code point, no more words by
skip pairs than there are code points to choose from; each member is told its count and its best partner, so pairs of
words are never written out. A skip within a run of equal code points gives the same rest at each of its places, and
only the run's first place meets split pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsquake.llm.common import Shelf

# What a word is made of, and how often one is misspelt on purpose.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
DAMAGED = 199
FIRST, LAST = ord("a"), 0xFF
BASE = LAST - FIRST + 2  # digits 1 to 159 for the code points of words
NEAR_ROOT = 8  # so many digits of that base fit in a bigint
HELD = 200_000  # words counted in memory before they are handed on


def damaged(doc_id, run: str) -> str:
    """The run without one code point where its checksum asks for it."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % DAMAGED else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, least_length: int = 6, least_count: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): all words of at least so many code points and occurrences."""

    def count(frames):
        held: Counter = Counter()
        for frame in frames:
            for doc_id, text in zip(frame["id"].tolist(), frame["text"].tolist()):
                if not text:
                    continue
                doc_id = None if pd.isna(doc_id) else doc_id
                for run, n in Counter(RUN.findall(text.encode("utf-8", "replace").lower().decode())).items():
                    if len(run) >= least_length and len(word := damaged(doc_id, run)) >= least_length:
                        held[word] += n
                if len(held) > HELD:
                    yield pd.DataFrame({"word": held.keys(), "n": held.values()})
                    held.clear()
        yield pd.DataFrame({"word": pd.Series(list(held), dtype=object), "n": pd.Series(list(held.values()), dtype="int64")})

    read = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    counts = read.mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def node_codes(word: str) -> tuple[list, list]:
    """(numbers, names) of the trie nodes on the word's path, root first: a number near the root, a name beyond it."""
    numbers, names, code, digest = [0], [None], 0, xxhash.xxh3_128()
    for depth, c in enumerate(word, 1):
        digest.update(c.encode("utf-8"))
        if depth <= NEAR_ROOT:
            code = code * BASE + ord(c) - FIRST + 1
            numbers.append(code)
            names.append(None)
        else:
            numbers.append(None)
            names.append(digest.digest())
    return numbers, names


PAIRS = pa.schema([("rank", pa.int64()), ("kind", pa.int32()), ("p", pa.int64()), ("p_name", pa.binary()), ("s", pa.int64()), ("s_name", pa.binary())])
SPLIT, SKIP, RUN_START = 0, 1, 2


def _pairs_of(rank: int, word: str) -> list[tuple]:
    p, p_name = node_codes(word)
    s, s_name = (x[::-1] for x in node_codes(word[::-1]))
    rows = [(rank, SPLIT, p[i], p_name[i], s[i], s_name[i]) for i in range(len(word) + 1)]
    for i, c in enumerate(word):
        kind = RUN_START if i == 0 or word[i - 1] != c else SKIP
        rows.append((rank, kind, p[i], p_name[i], s[i + 1], s_name[i + 1]))
    return rows


def node_pairs(words: DataFrame) -> DataFrame:
    """(rank, kind, p, p_name, s, s_name): the pairs of each word; nodes far from the root have a name and no number yet."""

    def pairs(batches):
        for batch in batches:
            rows: list[tuple] = []
            for rank, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += _pairs_of(rank, word)
                if len(rows) > 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PAIRS)], schema=PAIRS)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PAIRS)], schema=PAIRS)

    return words.select("rank", "word").mapInArrow(pairs, "rank bigint, kind int, p bigint, p_name binary, s bigint, s_name binary")


def _with_numbers(pairs: DataFrame, shelf: Shelf) -> DataFrame:
    """(rank, kind, p, s): both nodes of each pair by number.

    Near the root, where a node lies on the path of a large share of all words, its number is its spelling in base
    159 and nothing is joined. Beyond, the distinct nodes are numbered downwards from -1 in a stored table.
    """
    for end in ("p", "s"):
        name = f"{end}_name"
        far = pairs.where(F.col(name).isNotNull())
        nodes = shelf.put(far.select(name).distinct().withColumn("number", -1 - F.monotonically_increasing_id()))
        rest = [c for c in pairs.columns if c not in (end, name)]
        joined = far.drop(end).join(nodes, name).select(*rest, F.col("number").alias(end))
        after = shelf.put(pairs.where(F.col(name).isNull()).select(*rest, end).union(joined))
        shelf.drop(pairs, nodes)
        pairs = after
    return pairs


def near_words(pairs: DataFrame) -> DataFrame:
    """(rank, n_near, best): of each word with words one code point apart, how many and the one of smallest rank."""
    skipped = F.when(F.col("kind") != SPLIT, F.struct("rank", (F.col("kind") == RUN_START).alias("start")))
    group = pairs.groupBy("p", "s").agg(
        F.array_sort(F.collect_list(skipped)).alias("skips"),  # one per code point that fits the gap
        F.max(F.when(F.col("kind") == SPLIT, F.col("rank"))).alias("shorter"),
    )
    group = group.where((F.size("skips") > 1) | ((F.size("skips") > 0) & F.col("shorter").isNotNull()))
    group = group.withColumn("starts", F.filter("skips", lambda x: x["start"] & F.col("shorter").isNotNull()))
    first, second = F.get("skips", F.lit(0))["rank"], F.get("skips", F.lit(1))["rank"]
    told = F.transform(
        "skips",
        lambda x: F.struct(
            x["rank"].alias("rank"),
            (F.size("skips") - 1 + F.when(x["start"] & F.col("shorter").isNotNull(), 1).otherwise(0)).cast("bigint").alias("n"),
            F.least(F.when(x["rank"] == first, second).otherwise(first), F.when(x["start"], F.col("shorter"))).alias("best"),
        ),
    )
    longer = F.struct(F.col("shorter").alias("rank"), F.size("starts").cast("bigint").alias("n"), F.get("starts", F.lit(0))["rank"].alias("best"))
    every = F.concat(told, F.when(F.size("starts") > 0, F.array(longer)).otherwise(F.expr("array()").cast("array<struct<rank:bigint,n:bigint,best:bigint>>")))
    rows = group.select(F.explode(every).alias("x")).select("x.*").where("n > 0")
    return rows.groupBy("rank").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, shelf: Shelf) -> DataFrame:
    """(rank, root): the end of each chain of forms (rank, form), by doubling the steps until no chain goes on."""
    now = shelf.put(forms.select("rank", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        after = shelf.put(now.join(on, "root", "left").select("rank", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        shelf.drop(now)
        now = after
        if now.where("moved").isEmpty():
            return now.select("rank", "root")


def group_variants(
    docs: DataFrame, shelf: Shelf, least_length: int = 6, least_count: int = 5, ratio: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of at least so many code points and occurrences.

    Words are ranked by count, ties in code-point order, and the near word of smallest rank is a word's form where its
    count is at least `ratio` times the word's. Null and empty texts have no words, a null id reads as an empty one,
    rows that repeat count again, and an empty table gives an empty result. Other columns of `docs` are not read.
    """
    counted = word_counts(docs, least_length, least_count, id_col, text_col)
    words = shelf.put(counted.orderBy(F.col("n").desc(), "word").withColumn("rank", F.monotonically_increasing_id()))
    near = shelf.put(near_words(_with_numbers(shelf.put(node_pairs(words)), shelf)))
    other = words.select(F.col("rank").alias("best"), F.col("n").alias("best_n"), F.col("word").alias("best_word"))
    placed = shelf.put(words.join(near, "rank", "left").join(other, "best", "left"))
    close = F.col("best_n") >= ratio * F.col("n")
    forms = placed.where(close).select("rank", F.col("best").alias("form"))
    ends = roots(forms, shelf).join(words.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root").select("rank", "root_word")
    out = placed.join(ends, "rank", "left")
    return out.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(close, F.col("best_word")).alias("form"),
        F.when(close, F.col("best_n")).alias("form_n"),
        F.coalesce("root_word", "word").alias("root"),
    )
