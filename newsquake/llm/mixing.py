"""Mixing sources to target weights, in DataFrame functions only.

Each document gets a hash-random key. Within a source, documents are ordered by key through ranges: keys are
uniform, so ranges of their leading digits sort the source in bounded pieces. Words are summed per (source,
range), those few sums are accumulated over the ranges, and inside a range a window adds up the rest. A source's
budget is then cut at its exact word, after as many whole epochs as it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsquake.llm.common import SPACED_WORD, Shelf

DIGITS = 3  # of the hexadecimal key that name a range: 4,096 per source, more for sources of over some billion documents
WEIGHTS = (3, 1, 2)  # by rank of the source, repeating


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words, null 0."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("bigint")


def targets(totals: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> plus weight, cap and target.

    Sources in code point order, null last, take the weights in turn and split `share` of all words by them. No
    target passes `most` times its source's size; what is above goes to the others by weight until none is. That
    ends where the sources with the least cap per weight are full and the rest share what they leave, so one pass
    in the order of cap per weight finds it. The frames have one row per source, whatever the documents count.
    """
    turn = Window.orderBy(F.col("source").isNull(), "source")
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    ranked = totals.withColumn("weight", F.element_at(weights, (F.pmod(F.row_number().over(turn) - 1, F.lit(len(WEIGHTS))) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.lit(most) * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # The level is final at the first source whose cap is not below its share; later ones inherit it.
    level = F.when(left / open_weight * F.col("weight") <= F.col("cap"), left / open_weight)
    leveled = ranked.withColumn("level", F.first(level, ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, 0)))
    return leveled.select("source", "source_size", "weight", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")).alias("target"))


def mix(docs: DataFrame, shelf: Shelf, share: float = 1.5, most: float = 2.0, digits: int = DIGITS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", whole: str | None = None) -> DataFrame:
    """One row per document: id, source, size, source_size, weight, target, taken (words, repeats counted).

    With `whole`, a struct of that name holds all columns of the row.

    taken is size times the whole epochs of its source plus what the last epoch still takes from it: all before
    the cut, part of the document at the cut, nothing after. The sum over a source is its target, rounded down.
    The order within a source is a hash of id and size, so reruns agree; rows that tie in both take the same in
    sum, in any order. Null texts have size 0 and take nothing; the null source is a source of its own, ranked
    last; with no words at all every target is 0. Other columns of `docs` are not read.
    """
    key = F.md5(F.concat_ws(":", F.lit("mix"), F.col("id").cast("string"), F.col("size").cast("string")))
    carried = [F.struct(*docs.columns).alias(whole)] if whole else []
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *carried)
    rows = rows.withColumn("key", key).withColumn("range", F.substring("key", 1, digits))
    if not whole:
        rows = shelf.put(rows)  # else texts would be stored; counting their words twice costs less
    pieces = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    totals = targets(pieces.groupBy("source").agg(F.sum("words").alias("source_size")), share, most)
    over = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.withColumn("before", F.coalesce(F.sum("words").over(over), F.lit(0)))
    plan = starts.alias("p").join(totals.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
    plan = shelf.put(plan.select(F.col("p.source").alias("p_source"), F.col("range").alias("p_range"), "before", "source_size", "weight", "target"))
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("range") == F.col("p_range")))
    inside = Window.partitionBy("source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")).cast("bigint")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    taken = F.col("size") * epochs + F.greatest(F.lit(0), F.least(F.col("size"), rest - ahead))
    return joined.select("id", "source", *([whole] if whole else []), "size", "source_size", "weight", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, shelf: Shelf, text_col: str = "text", **settings) -> DataFrame:
    """The documents of the mix: the rows of `docs` of which words are taken, with size, target and taken.

    A row whose taken exceeds its size appears in more than one epoch; one below it is cut after `taken` words.
    The three columns are named mix_size, mix_target and mix_taken, with underscores added while a name is taken.
    """
    mixed = mix(docs, shelf, text_col=text_col, whole="whole", **settings).where("taken > 0")
    names = []
    for name in ("mix_size", "mix_target", "mix_taken"):
        while name in docs.columns:
            name += "_"
        names.append(name)
    columns = [F.col("whole").getField(c).alias(c) for c in docs.columns]
    return mixed.select(*columns, *[F.col(c).alias(n) for c, n in zip(("size", "target", "taken"), names)])
