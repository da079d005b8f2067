"""The prefix trie of rebuilt conversations, by composable fingerprints.

A rebuilt conversation is the head of its base conversation followed by its own later turns. A sequence of turns is an
element (B^n, s) of a monoid: s is the polynomial in B of its turns' digests, modulo a prime of 127 bits, and
(a, s) * (b, u) = (a * b, s * b + u). The product of a base's head and of a conversation's own turns gives the
fingerprint of every rebuilt prefix from two stored prefix products, so no rebuilt conversation is ever put together:
a row holds a fingerprint and a reference (conversation, position) to the stored turn that ends the prefix.

* Products over turns are scans: turns are sorted in ranges, every partition multiplies its own, and what a
  conversation brings along from earlier partitions, one row per partition, is multiplied in afterwards. A conversation
  may spread over any number of partitions.
* Equal fingerprints are one node once the digests of the turns referred to are equal too. By induction over depths
  the whole prefixes are equal then; if any group fails, all is done again in another base.
* Sums over subtrees double their reach each round: what lies 2^k below joins what lies less than 2^k below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake.llm.common import SPACED_WORD, Shelf

PRIME = (1 << 127) - 1
PIECE = 50_000  # conversations whose numbers are written as one text
NONE = bytes(16)  # the product of no turns

Element = tuple[int, int]


def combine(left: Element, right: Element) -> Element:
    """The product of two sequences: the element of one after the other."""
    return left[0] * right[0] % PRIME, (left[1] * right[0] + right[1]) % PRIME


def after(whole: Element, head: Element, n: int, base: int) -> Element:
    """The element of what follows a head, n turns, from the elements of both."""
    power = pow(base, n, PRIME)
    return power, (whole[1] - head[1] * power) % PRIME


def base_of(attempt: int) -> int:
    return int.from_bytes(hashlib.sha256(f"base {attempt}".encode()).digest()[:15], "big") | 1


def turn_value(digest: bytes) -> int:
    return int.from_bytes(digest[:16], "big") % PRIME


def stored_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, digest, words) of every turn; the digest keeps role and text apart."""
    who, said = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    digest = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256))
    words = F.size(F.regexp_extract_all(said, F.lit(SPACED_WORD), F.lit(0))).cast("bigint")
    return rows.select(F.col(f"`{conv}`").cast("bigint").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"), digest.alias("digest"), words.alias("words"))


PLACED = "part int, run bigint, conv bigint, i bigint, product binary, digest binary, words bigint"


def _scan(base: int) -> Callable[[Iterator], Iterator]:
    """Positions and products within the runs of one conversation that a partition holds."""

    def scan(batches):
        part, run, conv, i, s = TaskContext.get().partitionId(), -1, None, 0, 0
        for batch in batches:
            at, runs, places, products = batch.to_pydict(), [], [], []
            for c, d in zip(at["conv"], at["digest"]):
                if run < 0 or c != conv:
                    run, conv, i, s = run + 1, c, 0, 0
                i, s = i + 1, (s * base + turn_value(d)) % PRIME
                runs.append(run)
                places.append(i)
                products.append(s.to_bytes(16, "big"))
            columns = [pa.array([part] * len(runs), pa.int32()), pa.array(runs, pa.int64()), batch.column("conv"), pa.array(places, pa.int64())]
            columns += [pa.array(products, pa.binary()), batch.column("digest"), batch.column("words")]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "run", "conv", "i", "product", "digest", "words"])

    return scan


def _carried(placed: DataFrame, base: int) -> dict[int, tuple[int, int]]:
    """{part: (turns, product)} of the conversation that goes on in a partition from the ones before; one row of each is read."""
    ends = placed.groupBy("part").agg(F.min(F.struct("run", "conv")).alias("first"), F.max(F.struct("run", "i", "product", "conv")).alias("last"))
    carried, before = {}, None
    for row in sorted(ends.collect(), key=lambda r: r.part):
        n, s = row.last.i, int.from_bytes(row.last.product, "big")
        if before and before[0] == row.first.conv:
            carried[row.part] = before[1:]
            if row.last.run == 0:
                n, s = n + before[1], combine((0, before[2]), (pow(base, n, PRIME), s))[1]
        before = (row.last.conv, n, s)
    return carried


def prefix_products(turns: DataFrame, shelf: Shelf, base: int) -> DataFrame:
    """(conv, pos, product, digest, words): of each turn its position from 0 and the product of all turns up to it."""
    order = ["conv", "turn", "digest"]
    placed = shelf.put(turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_scan(base), PLACED))
    carried = _carried(placed, base)
    rows = placed.select("part", "run", "conv", (F.col("i") - 1).alias("pos"), "product", "digest", "words")
    if not carried:
        return rows.drop("part", "run")
    goes_on = F.col("part").isin(list(carried)) & (F.col("run") == 0)

    @F.pandas_udf("pos bigint, product binary")
    def moved(part: pd.Series, pos: pd.Series, product: pd.Series) -> pd.DataFrame:
        out = []
        for p, i, s in zip(part, pos, product):
            n, ahead = carried[p]
            out.append((n + i, combine((0, ahead), (pow(base, i + 1, PRIME), int.from_bytes(s, "big")))[1].to_bytes(16, "big")))
        return pd.DataFrame(out, columns=["pos", "product"])

    late = rows.where(goes_on).select("conv", moved("part", "pos", "product").alias("m"), "digest", "words")
    return rows.where(~goes_on).drop("part", "run").union(late.select("conv", "m.pos", "m.product", "digest", "words"))


def plans(products: DataFrame, heads: int, group: int) -> DataFrame:
    """One row per conversation: how it is rebuilt, from the first turns of its base and its own later ones.

    conv, n (own turns), h (own turns left out), base, head (the base's first turns taken: pos, product, digest,
    words) and cut (product of the own turns left out). No more than `heads` - 1 turns of a conversation are read.
    """
    first = F.when(F.col("pos") < heads - 1, F.struct("pos", "product", "digest", "words"))
    convs = products.groupBy("conv").agg((F.max("pos") + 1).alias("n"), F.array_sort(F.collect_list(first)).alias("own"))
    convs = convs.withColumns(
        {
            "h": F.coalesce(F.crc32(F.col("conv").cast("string")) % heads, F.lit(0)).cast("int"),
            "base": F.col("conv") - F.col("conv") % group,
        }
    )
    bases = convs.where(F.col("conv") == F.col("base")).select("base", F.col("own").alias("base_turns"))
    taken = F.when(F.col("base_turns").isNull(), F.slice("own", 1, 0)).otherwise(F.slice("base_turns", 1, F.col("h")))
    cut = F.when(F.col("h") > 0, F.get("own", F.col("h") - 1)["product"])
    return convs.join(bases, "base", "left").select("conv", "n", "h", "base", taken.alias("head"), F.coalesce(cut, F.lit(NONE)).alias("cut"))


def members(products: DataFrame, plan: DataFrame, base: int) -> DataFrame:
    """(conv, depth, node, parent, digest, words, ref, last) of every prefix of every rebuilt conversation but the empty one.

    node and parent are fingerprints, ref is the stored turn that ends the prefix, and last tells whole conversations.
    """

    @F.pandas_udf("node binary, parent binary")
    def joined(head: pd.Series, cut: pd.Series, n: pd.Series, product: pd.Series, digest: pd.Series) -> pd.DataFrame:
        back, out = pow(base, -1, PRIME), []
        for h, c, k, s, d in zip(head, cut, n, product, digest):
            own = after((0, int.from_bytes(s, "big")), (0, int.from_bytes(c, "big")), k, base)
            node = combine((0, int.from_bytes(h, "big")), own)[1]
            out.append((node.to_bytes(16, "big"), ((node - turn_value(d)) * back % PRIME).to_bytes(16, "big")))
        return pd.DataFrame(out, columns=["node", "parent"])

    size, of = F.size("head"), F.coalesce(F.get("head", F.size("head") - 1)["product"], F.lit(NONE))
    info = plan.select(F.col("conv").alias("c"), "n", F.col("h").cast("bigint").alias("h"), size.cast("bigint").alias("taken"), of.alias("head_product"), "cut").where("n > h")
    own = products.join(info, F.col("conv").eqNullSafe(F.col("c"))).where("pos >= h").withColumn("k", F.col("pos") + 1 - F.col("h"))
    own = own.withColumn("m", joined("head_product", "cut", "k", "product", "digest"))
    ref = lambda c, p: F.struct(F.col(c).alias("conv"), F.col(p).alias("pos")).alias("ref")
    own = own.select("conv", (F.col("taken") + F.col("k")).alias("depth"), "m.node", "m.parent", "digest", "words", ref("conv", "pos"), (F.col("pos") + 1 == F.col("n")).alias("last"))
    shown = plan.select("conv", "base", (F.col("n") <= F.col("h")).alias("short"), "head", F.posexplode("head").alias("at", "t"))
    parent = F.when(F.col("at") > 0, F.get("head", F.col("at") - 1)["product"]).otherwise(F.lit(NONE))
    depth = (F.col("at") + 1).cast("bigint").alias("depth")
    last = (F.col("short") & (F.col("at") + 1 == F.size("head"))).alias("last")
    heads = shown.select("conv", depth, F.col("t.product").alias("node"), parent.alias("parent"), "t.digest", "t.words", F.struct(F.col("base").alias("conv"), F.col("t.pos").alias("pos")).alias("ref"), last)
    return own.union(heads)


def _ids_in_pieces(batches):
    """Sorted (depth, node, conv) as pieces of the comma-joined numbers of one node, in order."""
    part, seq, key, ids = TaskContext.get().partitionId(), 0, None, []
    names = ["depth", "node", "part", "seq", "ids"]

    def piece():
        return (*key, part, seq, ",".join("" if c is None else str(c) for c in ids))

    for batch in batches:
        out, at = [], batch.to_pydict()
        for depth, node, conv in zip(at["depth"], at["node"], at["conv"]):
            if key != (depth, node) or len(ids) >= PIECE:
                if ids:
                    out.append(piece())
                    seq += 1
                key, ids = (depth, node), []
            ids.append(conv)
        yield _batch(out, names)
    yield _batch([piece()] if ids else [], names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = {"depth": pa.int64(), "node": pa.binary(), "part": pa.int32(), "seq": pa.int64(), "ids": pa.string(), "ends_sha256": pa.string()}
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, types[n]) for c, n in zip(columns, names)], names=names)


def _hashed(batches):
    """The digest of each node's pieces, one piece in memory at a time."""
    key, state = None, None
    names = ["depth", "node", "ends_sha256"]
    for batch in batches:
        out, at = [], batch.to_pydict()
        for depth, node, ids in zip(at["depth"], at["node"], at["ids"]):
            if key != (depth, node):
                if state:
                    out.append((*key, state.hexdigest()))
                key, state = (depth, node), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _batch(out, names)
    yield _batch([(*key, state.hexdigest())] if state else [], names)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, node, ends_sha256) from (depth, node, conv): SHA-256 of a node's conversations, ascending, comma-joined.

    A digest must run over a node's conversations in order, so its last step is one task per node; that task streams
    joined pieces of 50,000 numbers, made in parallel, and holds one of them at a time. Null numbers come first, as
    empty texts.
    """
    order = ["depth", "node", "conv"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = pieces.mapInArrow(_ids_in_pieces, "depth bigint, node binary, part int, seq bigint, ids string")
    dealt = pieces.repartition("depth", "node").sortWithinPartitions("depth", "node", "part", "seq")
    return dealt.mapInArrow(_hashed, "depth bigint, node binary, ends_sha256 string")


def subtree_sums(nodes: DataFrame, columns: list[str], shelf: Shelf) -> DataFrame:
    """(id, *columns): each column summed over a node and all below it, from (id, up, depth, *columns).

    up is the parent's id, null for the topmost nodes. A round doubles the reach, so a chain of d nodes takes log2(d).
    """
    now, reach = shelf.put(nodes.select("id", "up", "depth", *columns)), 1
    deepest = now.agg(F.max("depth") - F.min("depth")).first()[0] or 0
    while reach <= deepest:
        below = now.where("up is not null").groupBy("up").agg(*[F.sum(c).alias(f"_{c}") for c in columns])
        higher = now.where("up is not null").select(F.col("id").alias("up"), F.col("up").alias("next"))
        jumps = now.where("up is not null").select("id", "up").join(higher, "up").select("id", "next")
        summed = now.drop("up").join(below.withColumnRenamed("up", "id"), "id", "left").join(jumps, "id", "left")
        next_sums = [(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in columns]
        later = shelf.put(summed.select("id", F.col("next").alias("up"), "depth", *next_sums))
        shelf.drop(now)
        now, reach = later, reach * 2
    return now.select("id", *columns)


def _nodes(rows: DataFrame) -> DataFrame:
    same = (F.min("digest") == F.max("digest")) & (F.min("parent") == F.max("parent"))
    return rows.groupBy("depth", "node").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.min("parent").alias("parent"), F.min("words").alias("words"), F.min("ref").alias("ref"), same.alias("same")
    )


def prefix_trie(
    rows: DataFrame, shelf: Shelf, heads: int = 4, group: int = 20, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    base_for: Callable[[int], int] = base_of,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    A conversation c takes the first h turns of conversation c - c % group in place of its own first h, where
    h = crc32(decimal c) % heads; % keeps the sign of c, as in SQL. Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256 and ref, the stored turn (conversation, position) that ends the prefix.

    Turns are ordered by turn, null first, ties by digest; rows that repeat are turns of their own; null role or text
    is empty. Rows of null conversation are one conversation that keeps all its turns; its number is null and left out
    of minima. An empty table gives an empty result. Other columns are not read.
    """
    turns = shelf.put(stored_turns(rows, conv, turn, role, text))
    attempt = 0
    while True:
        base = base_for(attempt)
        products = shelf.put(prefix_products(turns, shelf, base))
        plan = shelf.put(plans(products, heads, group))
        held = shelf.put(members(products, plan, base))
        found = shelf.put(_nodes(held).withColumn("id", F.monotonically_increasing_id()))
        if found.where("not same").isEmpty():
            break
        shelf.drop(products, plan, held, found)
        attempt += 1
    return _answers(plan, held, found, shelf)


def _answers(plan: DataFrame, held: DataFrame, found: DataFrame, shelf: Shelf) -> DataFrame:
    turnless = plan.where((F.col("n") <= F.col("h")) & (F.size("head") == 0))
    ends = held.where("last").select("depth", "node", "conv").union(turnless.select(F.lit(0).cast("bigint"), F.lit(NONE), "conv"))
    hashed = shelf.put(ends_digests(ends))
    below = found.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single")
    )
    below = shelf.put(below)
    tops = found.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("id").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    # All topmost nodes have the root as parent: one row, which is not joined.
    whole = plan.agg(F.min("conv").alias("c"), F.count(F.lit(1)).alias("n")).first()
    deep = found.where("depth > 1").join(tops, ["depth", "parent"])
    first = found.where("depth = 1").withColumns({"up": F.lit(None).cast("bigint"), "parent_conv_id": F.lit(whole.c).cast("bigint")})
    zero = F.lit(0).cast("bigint")
    nodes = deep.select(*first.columns).union(first).join(below, ["depth", "node"], "left").join(hashed, ["depth", "node"], "left")
    nodes = shelf.put(nodes.withColumns({"n_children": F.coalesce("n_children", zero), "single": F.coalesce("single", zero)}))
    # Below a node of one conversation there is one path to one leaf and nothing to save.
    shared = nodes.where("n_convs > 1").select(
        "id", "up", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"), (F.col("single") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves")
    )
    sums = subtree_sums(shared, ["saved_tokens", "n_leaves"], shelf)
    empty = hashlib.sha256(b"").hexdigest()
    told = nodes.join(sums, "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("bigint").alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "ref",
    )
    total = nodes.agg(
        F.count_if(F.col("depth") == 1).alias("n_children"), F.count_if(F.col("n_children") == 0).alias("leaves"),
        F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("words")), zero).alias("saved_tokens"),
    ).first()
    own = hashed.where("depth = 0").first()
    null, number = F.lit(None).cast("bigint"), lambda value, name: F.lit(value).cast("bigint").alias(name)
    root = plan.sparkSession.range(1 if whole.n else 0).select(
        number(whole.c, "conv_id"), number(0, "depth"), null.alias("parent_conv_id"), number(whole.n, "n_convs"), number(total.n_children, "n_children"),
        number(max(total.leaves, 1), "n_leaves"), number(total.saved_tokens, "saved_tokens"), F.lit(own.ends_sha256 if own else empty).alias("ends_sha256"),
        F.struct(null.alias("conv"), null.alias("pos")).alias("ref"),
    )
    return told.union(root)
