"""URL filters with a Bloom filter cascade, in DataFrame functions only.

Level 1 encodes the listed keys. Keys of the universe that it takes for listed though they are not go into level 2,
listed keys that level 2 takes for those go into level 3, and so on until no false positive is left. A key of the
universe is then decided exactly by the first level that does not hold it, without a join: the levels are a few
bits per listed key, carried as scalars. A scalar has a bounded size: keys are cut into blocks by a hash, so many that
no level of a block holds more than LARGEST keys, and each block has a cascade of its own and judges its own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake.llm.common import Shelf, free

BITS_PER_KEY = 8
HASHES = 3
LARGEST = 4_000_000  # keys in one level of a block: 4 MB of bits


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first `://`, A-Z lower-cased, and the path up to query or fragment; else both empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (host, path, verdict) that fits, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _places(key: Column, level: int, bits: int) -> list[Column]:
    one = F.shiftrightunsigned(F.xxhash64(F.lit(level), key), 4)  # room to add without overflow
    two = F.shiftrightunsigned(F.xxhash64(F.lit(-1 - level), key), 8)
    return [F.pmod(one + F.lit(i) * two, F.lit(bits)) for i in range(HASHES)]


class Cascade:
    """The levels of one cascade: a stored one-row table of 64-bit words each."""

    def __init__(self, levels: list[tuple[DataFrame, int]]):
        self.levels = levels

    def holds(self, key: Column, level: int) -> Column:
        words, bits = self.levels[level]
        array = words.select("words").scalar()
        test = F.lit(True)
        for place in _places(key, level, bits):
            word = F.get(array, F.shiftright(place, 6).cast("int"))
            test = test & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return test

    def listed(self, key: Column) -> Column:
        """Whether a key of the universe is listed; null keys are not."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            answer = F.when(self.holds(key, level), answer).otherwise(F.lit(level % 2 == 1))
        return F.coalesce(answer, F.lit(False))


def marked_keys(listed: DataFrame, universe: DataFrame, shelf: Shelf) -> DataFrame:
    """Each key of both frames (a column `key`; repeats and nulls do not matter) once, `on` 1 where it is listed."""
    marked = universe.select("key", F.lit(0).alias("on")).union(listed.select("key", F.lit(1).alias("on")))
    return shelf.put(marked.where("key is not null").groupBy("key").agg(F.max("on").alias("on")))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks)).cast("int")


def build_cascade(keys: DataFrame, shelf: Shelf, largest: int) -> Cascade | None:
    """The cascade over marked keys; null where a level would pass `largest` keys, so that they need more blocks.

    Without a listed key the cascade has no level and lists nothing.
    """
    inside, outside = keys.where("on = 1").select("key"), keys.where("on = 0").select("key")
    levels: list[tuple[DataFrame, int]] = []
    while True:
        n = inside.count()
        if n == 0:
            return Cascade(levels)
        if n > largest:
            return None
        words = -(-n * BITS_PER_KEY // 64)
        level = len(levels)
        places = inside.select(F.explode(F.array(*_places(F.col("key"), level, words * 64))).alias("place"))
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
        filled = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(mask).alias("bits"))
        empty = shelf.spark.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
        whole = filled.union(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        packed = whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))
        levels.append((shelf.put(packed), words * 64))
        inside, outside = shelf.put(outside.where(Cascade(levels).holds(F.col("key"), level))), inside


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], shelf: Shelf, url_col: str = "url", largest: int = LARGEST) -> DataFrame:
    """`pages` with a struct `judged` (with underscores added where that name is taken): host, path, rule, verdict.

    listed: a column `key` of host + path strings to block, exact. The longest fitting rule decides; without one,
    a listed page is blocked, any other allowed. Null urls and urls without `://` have empty host and path and
    are allowed, unless the empty key is listed. Rows that repeat are judged alike; other columns pass through.
    """
    host, path = host_and_path(F.col(url_col))
    named = pages.select(F.struct(*pages.columns).alias("row"), host.alias("host"), path.alias("path"))
    named = named.withColumn("key", F.concat("host", "path"))
    keys = marked_keys(listed, named, shelf)
    cascade = build_cascade(keys, shelf, largest)
    if cascade is not None:
        return _verdicts(named, cascade, rules)
    blocks, parts = -(-keys.where("on = 1").count() // largest), None
    while parts is None:
        blocks *= 2  # as hashes are even, a block then has half the keys
        parts = _by_block(named, keys, blocks, rules, shelf, largest)
    return parts


def _by_block(named: DataFrame, keys: DataFrame, blocks: int, rules: list[tuple[str, str, str]], shelf: Shelf, largest: int) -> DataFrame | None:
    """The rows judged block by block, each read from a folder of its own; null where a level of a block is too large."""
    split = shelf.put(keys.withColumn("block", block_of(F.col("key"), blocks)), by="block")
    cascades = []
    for block in range(blocks):
        cascade = build_cascade(split.where(F.col("block") == block), shelf, largest)
        if cascade is None:
            return None
        cascades.append(cascade)
    rows = shelf.put(named.withColumn("block", block_of(F.col("key"), blocks)), by="block")
    # Written one by one, so that the scalars of one block at a time are in memory.
    done = [shelf.put(_verdicts(rows.where(F.col("block") == block), cascade, rules)) for block, cascade in enumerate(cascades)]
    whole = done[0]
    for part in done[1:]:
        whole = whole.union(part)
    return whole


def _verdicts(named: DataFrame, cascade: Cascade, rules: list[tuple[str, str, str]]) -> DataFrame:
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(verdict, F.when(cascade.listed(F.col("key")), F.lit("block")).otherwise(F.lit("allow")))
    judged = F.struct("host", "path", rule.alias("rule"), verdict.alias("verdict")).alias("judged")
    into = free("judged", named.select("row.*"))
    return named.select("row", judged).select("row.*", F.col("judged").alias(into))
