"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton accepts every run of consecutive words of any item. Training texts stream through it word by
word; the state and the length of the longest match at each word tell whether a window of an item ends there.
Words that no item holds reset the match, so texts only enter it where enough item words stand in a row.

Items reach the executors as broadcast automata of a bounded number of words. A larger benchmark is split into
blocks by a hash of its rows, and the texts are scanned once for each block, which keeps memory bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsquake.llm.common import Shelf, free

BLOCK_CHARS = 1_000_000  # of item text in one automaton: some 150,000 words, about 100 MB in a Python worker

# A-Z lower-cased; all other ASCII but digits and letters parts words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a UTF-8 text, A-Z lower-cased."""
    return data.translate(_WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.token = {w: i for i, w in enumerate(sorted({w for _, words in items for w in words}))}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        sequences = [(name, [self.token[w] for w in words]) for name, words in items if words]
        for _, tokens in sequences:
            last = 0
            for t in tokens:
                last = self._extend(last, t)
        self.shortest = min((min(len(t), window) for _, t in sequences), default=window)
        self.items: dict[int, set[str]] = {}  # of each state that holds a window of full length
        self.short: dict[int, list[tuple[int, str]]] = {}  # shorter items: their length, by state
        for name, tokens in sequences:
            for state, length in self._stream(tokens):
                if length >= window:
                    self.items.setdefault(self._suffix(state, window), set()).add(name)
            if len(tokens) < window:
                self.short.setdefault(state, []).append((len(tokens), name))

    def _extend(self, last: int, t: int) -> int:
        if t in self.next[last]:
            there = self.next[last][t]
            return there if self.length[there] == self.length[last] + 1 else self._split(last, t, there)
        new = self._state({}, -1, self.length[last] + 1)
        at = last
        while at != -1 and t not in self.next[at]:
            self.next[at][t] = new
            at = self.link[at]
        if at == -1:
            self.link[new] = 0
        else:
            there = self.next[at][t]
            self.link[new] = there if self.length[there] == self.length[at] + 1 else self._split(at, t, there)
        return new

    def _state(self, follow: dict[int, int], link: int, length: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, t: int, there: int) -> int:
        """Parts the strings that end at `at` from the longer ones of state `there`."""
        new = self._state(dict(self.next[there]), self.link[there], self.length[at] + 1)
        self.link[there] = new
        while at != -1 and self.next[at].get(t) == there:
            self.next[at][t] = new
            at = self.link[at]
        return new

    def _stream(self, tokens: list[int]):
        """(state, length of the longest match) after each token."""
        state = length = 0
        for t in tokens:
            while state and t not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if t in self.next[state]:
                state, length = self.next[state][t], length + 1
            yield state, length

    def _suffix(self, state: int, length: int) -> int:
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _whole(self, state: int, length: int):
        """(length, name) of the shorter items that end here."""
        while state > 0:
            for n, name in self.short.get(state, ()):
                if n <= length:
                    yield n, name
            state = self.link[state]
            length = self.length[state]

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Word ranges inside occurrences of windows, the items they are from, and the longest match."""
        get = self.token.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = np.concatenate(([0], (ids >= 0).view(np.int8), [0]))
        turns = np.flatnonzero(np.diff(known))
        ranges: list[tuple[int, int]] = []
        names: set[str] = set()
        longest = 0
        for start, end in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if end - start < self.shortest:
                continue
            for at, (state, length) in enumerate(self._stream(ids[start:end].tolist()), start + 1):
                longest = max(longest, length)
                if length >= self.window:
                    ranges.append((at - self.window, at))
                    names |= self.items[self._suffix(state, self.window)]
                if self.short:
                    for n, name in self._whole(state, length):
                        ranges.append((at - n, at))
                        names.add(name)
        return ranges, names, longest


def _united(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def without_ranges(data: bytes, spans: list[tuple[int, int]]) -> str:
    """A text without the given ranges of its words, each from its first to its last word."""
    # The plain form has the length of the text, so the words' places hold in both.
    plain = np.frombuffer(data.translate(_WORD_BYTES), np.uint8)
    turns = np.flatnonzero(np.diff(np.concatenate(([0], (plain != 32).view(np.int8), [0]))))
    at, kept = 0, []
    for start, end in spans:
        kept.append(data[at : turns[2 * start]])
        at = turns[2 * end - 1]
    kept.append(data[at:])
    return b"".join(kept).decode("utf-8", "ignore")


SEEN = "n_words bigint, n_hit bigint, longest bigint, ranges array<bigint>, items array<string>, rest string"


def _scan(broadcast, cut: bool):
    """One block: adds its ranges (start << 32 | end, in words) and items to those of the blocks before."""

    @F.pandas_udf(SEEN)
    def scan(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton = cloudpickle.loads(broadcast.value)
        for texts, ranges, items, longest in batches:
            rows = []
            for data, before, named, most in zip(texts, ranges, items, longest):
                words = words_of(data or b"")
                found, names, reach = automaton.matches(words)
                if before is not None:
                    found += [(r >> 32, r & 0xFFFFFFFF) for r in before.tolist()]
                    names |= set(named.tolist())
                    reach = max(reach, int(most))
                found = _united(found)
                rest = without_ranges(data, found) if cut and found else None
                rows.append((len(words), sum(b - a for a, b in found), reach, [a << 32 | b for a, b in found], sorted(names), rest))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "longest", "ranges", "items", "rest"])

    return scan


def find_items(docs: DataFrame, items: DataFrame, shelf: Shelf, window: int = 10, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", into: str = "seen", cut: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`docs` with a struct `into`: n_words, n_hit (words inside windows), longest (match, in words), ranges, items,
    and, with `cut`, rest: the text without the ranges, null where nothing is hit.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is one window.
    items lists, sorted, the ids as strings of items that have an occurring window (a null id is empty);
    rows that repeat an id are one item with the windows of each. Null texts have no words. Without items,
    or for an empty table, nothing is hit. Other columns of `docs` pass through.
    """
    spark = docs.sparkSession
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("body")).where("body is not null")
    chars = rows.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = 1 + int(chars) // block_chars
    out = docs.withColumn(into, F.lit(None).cast(f"struct<{SEEN.replace(' ', ':').replace(',:', ',')}>"))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("name", "body"), F.lit(blocks)) == b).collect()
        automaton = Automaton([(r.name, words_of(r.body.encode("utf-8", "replace"))) for r in sorted(part)], window)
        scan = _scan(spark.sparkContext.broadcast(cloudpickle.dumps(automaton)), cut and b == blocks - 1)
        if b:
            out = shelf.put(out)
        found = scan(F.col(text_col).cast("binary"), F.col(f"{into}.ranges"), F.col(f"{into}.items"), F.col(f"{into}.longest"))
        out = out.withColumn(into, found)
    return out


def without_items(docs: DataFrame, items: DataFrame, shelf: Shelf, window: int = 10, most: float = 0.5, text_col: str = "text", **settings) -> DataFrame:
    """`docs` without the passages they share with items.

    Every span of words inside windows goes, from its first to its last word; what stands between words at the
    cut stays. A document with over `most` of its words inside windows goes as a whole. Documents without a hit
    are unchanged, null and empty texts included.
    """
    name = free("_seen", docs)
    seen = find_items(docs, items, shelf, window, text_col, into=name, cut=True, **settings)
    stay = seen.where(F.col(f"{name}.n_hit") <= F.lit(most) * F.col(f"{name}.n_words"))
    text = F.when(F.col(f"{name}.n_hit") > 0, F.col(f"{name}.rest")).otherwise(F.col(text_col)).alias(text_col)
    return stay.select(*[text if c == text_col else F.col(c) for c in docs.columns])
