"""The trie of conversations that share their first turns: preorder intervals.

Distinct conversations are sorted by the digests of their turns, one after another, so
those that share a beginning stand together. A node (a distinct beginning) is known by
the first and the last of these that have it; first place and depth rank the nodes in
preorder. A node's subtree is then an interval of ranks: from its own to the end of
the last place. Leaves and savings of a subtree are differences of two running sums, which
are made in parts: in a part, among a partition's parts, and among the partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaybook.llm.common import drop, small_batches, table, tidily

#: Hex digits that stand for a turn: 128 bits of SHA-256.
DIGITS = 32
#: 2**PART_BITS places, those of distinct conversations, make a part of the running sums.
PART_BITS = 8
#: Bits of a place that count within its partition, as monotonically_increasing_id() has it.
PLACE_BITS = 33
#: Characters of joined ids that go to a hash at once.
CHUNK = 1 << 15
#: Nodes in a batch that leaves Python.
NODES = 20_000


def turn_lists(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): a row for each conversation, its turns as structs (k: digest, n: bytes of text) in order of `turn`, null first.

    Null roles and texts count as empty. Turns of equal number stand in the order of role,
    then digest; repeated rows are turns each. Rows without conv_id belong to no
    conversation and are left out. A conversation's turns meet as digests, its texts don't.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256), 1, DIGITS)
    rows = conversations.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), by.alias("role"), digest.alias("k"), F.octet_length(said).cast("long").alias("n")).alias("turn"))
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda x: F.struct(x["k"].alias("k"), x["n"].alias("n"))).alias("turns"))


def rebuilt(lists: DataFrame, step: int = 5, longest: int = 8) -> DataFrame:
    """turn_lists() where conversation c begins with the first h turns of c - c % step (h: crc32 of c, modulo longest + 1), in place of its own first h."""
    first = lists.select(F.col("conv_id").alias("_base"), F.col("turns").alias("_first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)).cast("int")
    joined = lists.join(first, F.col("conv_id") - F.col("conv_id") % step == F.col("_base"), "left")
    own = F.slice("turns", h + 1, F.size("turns"))
    return joined.select("conv_id", F.when(F.col("_base").isNull(), own).otherwise(F.concat(F.slice("_first", F.lit(1), h), own)).alias("turns"))


def _node(path: Column) -> Column:
    return F.unhex(F.substring(F.sha2(path, 256), 1, 32))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each sequence (place, path, sizes, n, least) its nodes, the root first."""
    schema = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("size", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("least", pa.int64()), ("more", pa.int64())])
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        rows.clear()
        return made

    for batch in batches:
        for place, path, sizes, n, least in zip(*(batch.column(c).to_pylist() for c in ("place", "path", "sizes", "n", "least")), strict=True):
            known, parent = hashlib.sha256(), None
            for depth in range(len(sizes) + 1):
                if depth:
                    known.update(path[(depth - 1) * DIGITS : depth * DIGITS].encode())
                node = known.digest()[:16]
                rows.append((node, parent, depth, sizes[depth - 1] if depth else 0, place, n, least, int(depth < len(sizes))))
                parent = node
                if len(rows) == NODES:
                    yield out()
    if rows:
        yield out()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, first, ids): of sorted (node, conv_id) the decimal ids joined by commas, in pieces of about CHUNK characters."""
    node, ids, size = None, [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([int(ids[0])], pa.int64()), pa.array([",".join(ids)])], ["node", "first", "ids"])

    for batch in batches:
        made = []
        for new, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if ids and (new != node or size > CHUNK):
                made.append(out())
                ids, size = [], 0
            node = new
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if made:
            yield pa.Table.from_batches(made).combine_chunks().to_batches()[0]
    if ids:
        yield out()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends_sha256) of sorted (node, first, ids)."""
    node, digest = None, None
    for batch in batches:
        made = []
        for new, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if digest is not None and new == node:
                digest.update(b",")
            else:
                if digest is not None:
                    made.append((node, digest.hexdigest()))
                node, digest = new, hashlib.sha256()
            digest.update(ids.encode())
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made])], ["node", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])


def _ends(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end. A node's ids are joined in parallel; what is left to one task is to hash them in order, a piece at a time."""
    ids = paths.select(_node(F.col("path")).alias("node"), "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ids.mapInArrow(tidily(_joined), "node binary, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(tidily(_hashed), "node binary, ends_sha256 string")


def prefix_trie(lists: DataFrame) -> DataFrame:
    """A row for each node of the trie of (conv_id, turns), as turn_lists() has them.

    Columns: node, parent (keys; the root has no parent), rank (its place in preorder, from 1), end (the last
    rank of its subtree), conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (summed over the subtree, each node's (n_convs - 1) times bytes of its last text), ends_sha256
    (of the ids, joined by commas, of the conversations that end there). Conversations without turns end at
    the root. Without conversations there is no node.
    """
    small_batches(lists.sparkSession)
    paths = table(lists.select("conv_id", F.array_join(F.transform("turns", lambda x: x["k"]), "").alias("path"), F.transform("turns", lambda x: x["n"]).alias("sizes")), "paths")
    distinct = paths.groupBy("path", "sizes").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    placed = table(distinct.repartitionByRange("path").sortWithinPartitions("path").withColumn("place", F.monotonically_increasing_id()), "places")
    each = placed.select("place", "path", "sizes", "n", "least").mapInArrow(tidily(_nodes), "node binary, parent binary, depth long, size long, place long, n long, least long, more long")
    nodes = each.groupBy("node", "parent", "depth", "size").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"), F.max("more").alias("more"))
    nodes = nodes.withColumns({"leaf": 1 - F.col("more"), "saves": (F.col("n_convs") - 1) * F.col("size"), "one": F.lit(1).cast("long"), "part": F.shiftright("first", PART_BITS)})
    sums = {"rank": "one", "leaves": "leaf", "saved": "saves"}
    within = Window.partitionBy("part").orderBy("first", "depth").rowsBetween(Window.unboundedPreceding, 0)
    within_parts = table(nodes.withColumns({name: F.sum(c).over(within) for name, c in sums.items()}), "parts")
    ranked = within_parts.join(_offsets(within_parts, sums), "part").withColumns({name: F.col(name) + F.col(f"_{name}") for name in sums})
    ranked = table(ranked.select("node", "parent", "depth", "conv_id", "n_convs", "first", "last", "leaf", "saves", *sums), "ranked")
    drop(placed, within_parts)
    after = ranked.groupBy(F.col("first").alias("last")).agg(*(F.max(name).alias(f"end_{name}") for name in sums))
    children = ranked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    parents = ranked.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = ranked.join(after, "last").join(parents, "parent", "left").join(children, "node", "left").join(_ends(paths), "node", "left")
    return out.select(
        "node", "parent", "rank", F.col("end_rank").alias("end"), "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        (F.col("end_leaves") - F.col("leaves") + F.col("leaf")).alias("n_leaves"),
        (F.col("end_saved") - F.col("saved") + F.col("saves")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _offsets(ranked: DataFrame, sums: dict[str, str]) -> DataFrame:
    """(part, _name ...): what stands before each part. The last window has a row for each partition of `placed`."""
    parts = ranked.groupBy("part").agg(*(F.sum(c).alias(c) for c in sums.values())).withColumn("of", F.shiftright("part", PLACE_BITS - PART_BITS))
    whole = parts.groupBy("of").agg(*(F.sum(c).alias(c) for c in sums.values()))
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("of", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_of_{name}") for name, c in sums.items()))
    earlier = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("of", "part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{name}") for name, c in sums.items()))
    return parts.join(whole, "of").select("part", *((F.col(f"_{name}") + F.col(f"_of_{name}")).alias(f"_{name}") for name in sums))
