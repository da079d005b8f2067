"""Exact duplicates by splitting off heavy hitters.

Texts are compared by the SHA-256 of their normalised form. Misra-Gries counters, one small summary per partition,
find every digest that could hold a large share of the rows; their exact counts decide which do. Those winners are
few by construction, are broadcast, and settle their rows where they lie. All other digests are shuffled in the
ordinary way, and none of them holds more than a small share of the rows.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake.llm.common import Shelf

COUNTERS = 1024  # of a partition's summary
HEAVY = 256  # a digest is heavy when it holds one of so many rows, so there are so many heavy digests at most
# Fixed value: the blanks that count as one space. Single spaces need no replacing, so they are not matched.
BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Every run of blanks as one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def lighter(counts: dict, counters: int) -> dict:
    """A Misra-Gries summary cut to so many counters: all lose what the largest counter beyond them holds."""
    if len(counts) <= counters:
        return counts
    off = sorted(counts.values(), reverse=True)[counters]
    return {k: n - off for k, n in counts.items() if n > off}


def summaries(rows: DataFrame, column: str, counters: int) -> DataFrame:
    """(digest, n): the counters of each partition, each short of the true count by at most rows / (counters + 1)."""

    def count(batches):
        held: dict[bytes, int] = {}
        for batch in batches:
            for seen in pc.value_counts(batch.column(0)).to_pylist():
                held[seen["values"]] = held.get(seen["values"], 0) + seen["counts"]
            held = lighter(held, counters)
        yield pa.RecordBatch.from_pydict({"digest": pa.array(held.keys(), pa.binary()), "n": pa.array(held.values(), pa.int64())})

    return rows.select(column).mapInArrow(count, "digest binary, n bigint")


def heavy_digests(rows: DataFrame, shelf: Shelf, counters: int = COUNTERS, heavy: int = HEAVY) -> DataFrame:
    """(digest, group_size, first) of the digests that hold at least one in `heavy` of the rows; at most `heavy` rows.

    Counters of all partitions together fall short of a true count by at most total / (counters + 1). So a heavy
    digest keeps at least total / heavy - total / (counters + 1), and as counters sum to the total at most, no more
    than heavy * (counters + 1) / (counters + 1 - heavy) digests are counted exactly.
    """
    if counters < heavy:
        raise ValueError("a summary needs at least as many counters as there may be heavy digests")
    total = rows.count()
    kept = summaries(rows, "digest", counters).groupBy("digest").agg(F.sum("n").alias("n"))
    bound = F.lit(counters + 1 - heavy).cast("decimal(38,0)") * total
    candidates = shelf.put(kept.where(F.col("n").cast("decimal(38,0)") * (heavy * (counters + 1)) >= bound).select("digest"))
    exact = rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*_group())
    return shelf.put(exact.where(F.col("group_size") * heavy >= total))


def _group() -> list[Column]:
    order = F.struct(F.col("id").isNull().alias("none"), "id", "tie", "row")
    return [F.count(F.lit(1)).alias("group_size"), F.min(order).alias("first")]


def numbered(docs: DataFrame, shelf: Shelf, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Every row under a number of its own (`row`), with id, digest and a tie hash of its other columns, stored.

    keep=True stores the row itself as well, in the struct column `doc`.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    tie = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0).cast("bigint")
    digest = F.unhex(F.sha2(normalised(F.col(f"`{text_col}`")), 256))
    columns = [F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), digest.alias("digest"), tie.alias("tie")]
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if keep else []
    return shelf.put(docs.select(*columns, *whole))


def copies(rows: DataFrame, shelf: Shelf, counters: int = COUNTERS, heavy: int = HEAVY) -> DataFrame:
    """(row, id, digest, keep_id, group_size, kept) of every row of `numbered`.

    Of the rows of one digest the smallest id stays, null ids last; rows equal in id and text are told apart by a
    hash of their other columns and then by their place, so exactly one stays of each group.
    """
    winners = heavy_digests(rows, shelf, counters, heavy)
    own = rows.select("row", "id", "digest", "tie")
    large = own.join(F.broadcast(winners), "digest")
    rest = own.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    small = rest.join(rest.groupBy("digest").agg(*_group()), "digest")
    settled = [
        part.select("row", "id", "digest", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"))
        for part in (large, small)
    ]
    return settled[0].union(settled[1])


def find_copies(docs: DataFrame, shelf: Shelf, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS, heavy: int = HEAVY) -> DataFrame:
    """(row, id, digest, keep_id, group_size, kept) of every row: its group of equal texts and whether it stays.

    Null texts count as empty. Of null ids one stays only where the group has no other; keep_id is null then. An
    empty table gives an empty result. Other columns serve as tie-break for rows equal in id and text.
    """
    return copies(numbered(docs, shelf, id_col, text_col), shelf, counters, heavy)


def without_copies(docs: DataFrame, shelf: Shelf, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS, heavy: int = HEAVY) -> DataFrame:
    """The rows of `docs` that stay, all columns and the text unchanged; columns of any name pass through."""
    rows = numbered(docs, shelf, id_col, text_col, keep=True)
    stay = copies(rows.drop("doc"), shelf, counters, heavy).where("kept").select("row")
    return rows.select("row", "doc").join(stay, "row", "left_semi").select("doc.*")
