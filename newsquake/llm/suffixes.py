"""Exact removal of repeated byte strings by a depth-limited radix sort of suffixes.

A window is a string of `threshold` bytes; a byte goes if a window over it also starts anywhere else. Sorting the
suffixes to that depth, most significant digit first, brings equal windows into one group, and a suffix that is
alone in its group after any pass needs no further pass. Three things keep the passes small:

* Digits are taken from the window's anchor outward. The anchor is the 8-byte gram of least hash in the window, so
  equal windows have it at the same offset, and neighbouring windows share one: about two anchors per `threshold`
  bytes stand for all suffixes. A node is an anchor with a range of offsets, that is a run of neighbouring windows.
* The digit of a node is its core, the bytes that all its windows have in common. If no other node has that core,
  none of its windows is repeated and the node drops out.
* If another node has the same hull (all bytes of all its windows), every window is repeated and the node is
  settled without going deeper. Only the rest, at the edges of repeated passages, is split into narrower ranges
  for the next pass, down to single windows, whose core is the whole window: equal groups are the repeated windows.

Groups are counted with partial aggregation and joined back, so a passage that a third of all documents hold is
never gathered in one task. Digits are 64-bit hashes: for cores a collision only costs work; hulls are compared
within one core, and single windows by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsquake.llm.common import Shelf, free

GRAM = 8
CHUNK = 1 << 22
LOW = np.uint64((1 << 24) - 1)
# Odd multipliers that spread the grams over 64 bits.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

NODE = "row bigint, place bigint, core bigint, hull bigint"


def anchors(data: bytes, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, least offset, largest offset) of each run of windows with one anchor."""
    found = []
    span = threshold - GRAM + 1
    for at in range(0, len(data) - threshold + 1, CHUNK):
        part = data[at : at + CHUNK + threshold - 1]
        grams = np.ndarray((len(part) - GRAM + 1,), "<u8", part, strides=(1,)) * MIX_A
        grams ^= grams >> np.uint64(29)
        grams *= MIX_B
        grams &= ~LOW
        grams |= np.arange(len(grams), dtype=np.uint64)  # the first of equal grams
        width = 1
        while width * 2 <= span:
            grams = np.minimum(grams[:-width], grams[width:])
            width *= 2
        if width < span:
            grams = np.minimum(grams[: len(grams) - (span - width)], grams[span - width :])
        where = (grams & LOW).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(where[1:] != where[:-1]) + 1))
        last = np.concatenate((first[1:] - 1, [len(where) - 1]))
        found.append((where[first] + at, where[first] - last, where[first] - first))
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*found))


def cut_ranges(anchor: np.ndarray, low: np.ndarray, high: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs cut where the offset passes a multiple of width, each after the number of its run."""
    pieces = high // width - low // width + 1
    source = np.repeat(np.arange(len(anchor)), pieces)
    rank = np.arange(len(source)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cell = low[source] // width + rank
    return source, anchor[source], np.maximum(low[source], cell * width), np.minimum(high[source], cell * width + width - 1)


def hashes(texts: list[bytes], source, base, anchor, low, high, width: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Core and hull digits of the nodes; a node's text starts at byte `base` of the document."""
    digest = xxhash.xxh3_64_intdigest
    cell = low // width * width
    top = np.minimum(cell + width - 1, threshold - GRAM)
    ends = [x.tolist() for x in (source, anchor - cell - base, anchor - top - base + threshold, cell, anchor - high - base, anchor - low - base + threshold, low << 12 | high)]
    core = np.fromiter((digest(texts[i][a:b], c) for i, a, b, c in zip(*ends[:4])), np.uint64, len(source))
    hull = np.fromiter((digest(texts[i][a:b], r) for i, a, b, r in zip(ends[0], *ends[4:])), np.uint64, len(source))
    return core.view(np.int64), hull.view(np.int64)


def packed(anchor, low, high):
    return anchor << 24 | low << 12 | high


def unpacked(place: np.ndarray):
    return place >> 24, place >> 12 & 0xFFF, place & 0xFFF


def first_width(threshold: int) -> int:
    """The largest power of two under the number of offsets."""
    return 1 << max(0, (threshold - GRAM).bit_length() - 1)


def _batch(columns: list, names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)


def _node_batches(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    """rows: one tuple per text of (row, arrays of one length ...)."""
    sizes = [len(r[1]) for r in rows]
    columns = [pa.array(np.repeat(np.array([r[0] for r in rows], np.int64), sizes))]
    columns += [pa.array(np.concatenate([r[i] for r in rows]) if rows else [], t) for i, t in enumerate(types, 1)]
    return pa.RecordBatch.from_arrays(columns, names=names)


NODES = 1 << 17


def _first_nodes(threshold: int):
    width = first_width(threshold)
    names, types = ["row", "place", "core", "hull"], [pa.int64()] * 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(1)[i].as_py()
                if data is None or len(data) < threshold:
                    continue
                source, *cuts = cut_ranges(*anchors(data, threshold), width)
                rows.append((batch.column(0)[i].as_py(), packed(*cuts), *hashes([data], np.zeros_like(source), 0, *cuts, width, threshold)))
                held += len(source)
                if held > NODES:
                    yield _node_batches(rows, names, types)
                    rows, held = [], 0
        if rows:
            yield _node_batches(rows, names, types)

    return run


def _repeated(nodes: DataFrame, shelf: Shelf) -> DataFrame:
    """The nodes whose core another node has too. The counts are written first, so that Spark may split a hot core in the join."""
    often = shelf.put(nodes.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"))
    return nodes.join(often, "core", "left_semi")


def _sorted_out(nodes: DataFrame, shelf: Shelf) -> DataFrame:
    """Repeated nodes with `settled` (its hull has a twin) and `deeper` (to be split for the next pass).

    A node without a twin goes deeper if other hulls share its core; so does one of each set of twins, as a partner.
    """
    twins = shelf.put(nodes.groupBy("core", "hull").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "place")).alias("one")))
    cores = shelf.put(twins.groupBy("core").agg(F.count(F.lit(1)).alias("hulls"), F.count_if(F.col("n") == 1).alias("single")).where("hulls > 1 and single > 0").select("core", F.lit(True).alias("mixed")))
    judged = shelf.put(twins.join(cores, "core", "left"))
    shelf.drop(twins)
    told = nodes.join(judged, ["core", "hull"])
    deeper = F.coalesce("mixed", F.lit(False)) & (F.col("one") == F.struct("row", "place"))
    return told.select(*nodes.columns, (F.col("n") > 1).alias("settled"), deeper.alias("deeper"))


def _edges(threshold: int):
    """Bytes of all windows of the nodes that a text holds; reads (row, data, places)."""
    names = ["row", "place", "base", "data"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for i in range(batch.num_rows):
                data = batch.column(1)[i].as_py()
                places = batch.column(2)[i].values.to_numpy()
                anchor, low, high = unpacked(places)
                row = batch.column(0)[i].as_py()
                for place, a, b in zip(places.tolist(), (anchor - high).tolist(), (anchor - low + threshold).tolist()):
                    for column, value in zip(columns, (row, place, a, data[a:b])):
                        column.append(value)
                if len(columns[0]) > NODES // 8:
                    yield _batch(columns, names, types)
                    columns = [[], [], [], []]
            if columns[0]:
                yield _batch(columns, names, types)

    return run


def _deeper_nodes(threshold: int, width: int):
    """The nodes of the next pass; reads (row, place, base, data), outer is the place they come from."""
    names = ["row", "outer", "place", "core", "hull"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, NODES // 64):  # a node has some 16 parts
                part = batch.slice(at, NODES // 64)
                places = part.column("place").to_numpy()
                source, anchor, low, high = cut_ranges(*unpacked(places), width)
                digits = hashes(part.column("data").to_pylist(), source, part.column("base").to_numpy()[source], anchor, low, high, width, threshold)
                index = pa.array(source)
                columns = [part.column("row").take(index), pa.array(places[source]), pa.array(packed(anchor, low, high)), *map(pa.array, digits)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def repeated_windows(texts: DataFrame, shelf: Shelf, threshold: int = 200) -> DataFrame:
    """(row, places): for each row of texts with repeated windows, the packed runs of them.

    texts: (row, data), read more than once, so stored; row is a bigint that no two texts share.
    A run (anchor, low, high) stands for the windows that start at anchor - high to anchor - low.
    """
    if not GRAM <= threshold < 4096:
        raise ValueError("threshold must lie between 8 and 4095 bytes")
    width = first_width(threshold)
    first = shelf.put(texts.mapInArrow(_first_nodes(threshold), NODE))
    nodes = shelf.put(_repeated(first, shelf))
    shelf.drop(first)
    told = shelf.put(_sorted_out(nodes, shelf))
    shelf.drop(nodes)
    settled = [told.where("settled").select("row", "place")]
    wanted = told.where("deeper").groupBy("row").agg(F.collect_list("place").alias("places"))
    held = texts.join(wanted, "row").select("row", "data", "places")
    edges = shelf.put(held.mapInArrow(_edges(threshold), "row bigint, place bigint, base bigint, data binary"))
    while width > 1:
        width = max(1, width // 8)
        split = shelf.put(edges.mapInArrow(_deeper_nodes(threshold, width), "row bigint, outer bigint, place bigint, core bigint, hull bigint"))
        nodes = shelf.put(_repeated(split, shelf))
        shelf.drop(split)
        told = shelf.put(_sorted_out(nodes, shelf))
        shelf.drop(nodes)
        settled.append(told.where("settled").select("row", "place"))
        if width > 1:
            inner = told.where("deeper").select("row", "outer", "place")
            outer = edges.withColumnRenamed("place", "outer")
            after = shelf.put(inner.join(outer, ["row", "outer"]).select("row", "place", "base", "data"))
            shelf.drop(edges)
            edges = after
    runs = settled[0]
    for more in settled[1:]:
        runs = runs.union(more)
    found = shelf.put(runs.groupBy("row").agg(F.collect_list("place").alias("places")))
    return found


def merged(places: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """The maximal byte ranges that the windows cover, in order."""
    anchor, low, high = unpacked(np.asarray(places, np.int64))
    order = np.argsort(anchor - high, kind="stable")
    starts, ends = (anchor - high)[order], np.maximum.accumulate((anchor - low + threshold)[order])
    fresh = np.concatenate(([True], starts[1:] > ends[:-1]))
    return list(zip(starts[fresh].tolist(), ends[np.concatenate((fresh[1:], [True]))].tolist()))


def remove_repeats(docs: DataFrame, shelf: Shelf, threshold: int = 200, text_col: str = "text", into: str = "cut", as_text: bool = False) -> DataFrame:
    """`docs` with a struct column `into`: kept (binary, the bytes that remain), n_bytes, n_removed, n_spans.

    Every byte under a repeated window of `threshold` bytes goes, all copies alike; windows are judged on the
    whole input, in and across documents, and never cross documents. Null texts are empty; texts shorter than
    the threshold stay whole. Rows that repeat are documents of their own, so each loses everything from the
    threshold on. Rows are told apart by a number given here; ids are not read. An empty table gives an empty result.
    Other columns of `docs` pass through, whatever their names but `into`. With `as_text`, kept is a string, without
    the pieces of characters that were cut in two.
    """
    number, places = free("_row", docs), free("_places", docs)
    stored = shelf.put(docs.withColumn(number, F.monotonically_increasing_id()))
    data = F.col(text_col).cast("binary")
    found = repeated_windows(stored.select(F.col(number).alias("row"), data.alias("data")), shelf, threshold)
    shelf.keep_only(stored, found)

    @F.pandas_udf(f"kept {'string' if as_text else 'binary'}, n_bytes bigint, n_removed bigint, n_spans bigint")
    def cut(texts, runs):
        import pandas as pd

        rows = []
        for data, places in zip(texts, runs):
            data = data or b""
            spans = merged(places, threshold) if places is not None else []
            at, kept = 0, []
            for start, end in spans:
                kept.append(data[at:start])
                at = end
            kept.append(data[at:])
            kept = b"".join(kept)
            rows.append((kept.decode("utf-8", "ignore") if as_text else kept, len(data), len(data) - len(kept), len(spans)))
        return pd.DataFrame(rows, columns=["kept", "n_bytes", "n_removed", "n_spans"])

    joined = stored.join(found.select(F.col("row").alias(number), F.col("places").alias(places)), number, "left")
    return joined.select(*docs.columns, cut(data, places).alias(into))


def without_repeats(docs: DataFrame, shelf: Shelf, threshold: int = 200, text_col: str = "text") -> DataFrame:
    """`docs` with the repeated bytes removed from the text; a character cut in two goes whole.

    Null texts stay null; a text that is repeated throughout becomes empty. Nothing else changes.
    """
    name = free("_cut", docs)
    cut = remove_repeats(docs, shelf, threshold, text_col, into=name, as_text=True)
    text = F.when(F.col(f"{name}.n_removed") > 0, F.col(f"{name}.kept")).otherwise(F.col(text_col)).alias(text_col)
    return cut.select(*[text if c == text_col else F.col(c) for c in docs.columns])
