"""The trie of all prefixes of sequences, built by van Emde Boas recursion over their lengths.

Every sequence is cut at half the (power of two) length, its halves are cut again, and so on; the
name of a part is a digest of the names of its two halves. A prefix that ends at a cut is named by
the node that its part hangs on, and by the part. Parts that hang on one node and have one name are
one from then on, represented by the smallest member and the number of members: the upper trie is
made of the distinct upper halves, the lower forests of the distinct lower ones under each cut
prefix. All parts of one size are cut by one job, so that ``log2`` of the longest length is the number of
rounds, and the rows of a round are about half those of the next.

Each part that is whole is also an edge of that size, from the node it hangs on to the node it ends at.
Totals of subtrees are grafted along these edges, small ones first: what hangs between two cuts is
added to the upper one. Then large ones first: a node's total is what hangs above the next cut, and the
totals of the nodes at that cut.

No sequence and no group of equal sequences is ever in one task: items are numbered by range
partitions, a part has two halves, and members are counted before they are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import left_lookup
from ..operators.keys import with_dense_id
from ..session import materialize
from .common import small_batches

#: Name of the node that all sequences start from.
ROOT = bytes(16)
#: Keys of members are put together before they are hashed, those that differ only in so many low bits.
KEY_BITS = 12


def _named(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def numbered(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0) within their ``key`` in the order of ``order``, nulls first.

    Rows without a key are left out. Rows are sorted by range partitions, so one key may have
    any share of them. Rows equal in ``order`` are ordered by all other columns.
    """
    rows = rows.where(F.col(key).isNotNull())
    ranked = with_dense_id(rows, [key, *order], "_rank", start=0, unique=False)
    firsts = ranked.groupBy(key).agg(F.min("_rank").alias("_first"))
    placed = left_lookup(ranked, materialize(firsts, "trie-firsts"), key)
    return placed.select(*rows.columns, (F.col("_rank") - F.col("_first")).alias("place"))


def _halves(parts: DataFrame) -> DataFrame:
    """Parts of twice the size: ``key``, ``at``, ``name``, ``whole``, and the names of their halves."""
    left = F.col("at") % 2 == 0
    both = parts.groupBy("key", F.shiftright("at", 1).alias("at")).agg(
        F.max(F.when(left, F.col("name"))).alias("left"),
        F.max(F.when(~left, F.col("name"))).alias("right"),
        F.bool_or(left & F.col("whole")).alias("left_whole"),
        F.bool_or(~left & F.col("whole")).alias("whole"),
    )
    name = _named(F.col("left"), F.coalesce("right", F.lit(b"")))
    return both.select("key", "at", name.alias("name"), "whole", "left", "right", "left_whole")


def _cut(held: DataFrame, halves: DataFrame) -> DataFrame:
    """The parts that the halves of ``held`` are, each with the node it hangs on and the one it ends at.

    ``held`` has ``root``, ``end`` (null unless the part is whole), ``at``, ``member``, ``n``.
    """
    parts = halves.select(F.col("key").alias("member"), "at", "left", "right", "left_whole")
    cut = held.join(parts, ["member", "at"])
    end = F.when(F.col("left_whole"), _named(F.col("root"), F.col("left")))
    at = F.col("at") * 2
    upper = F.struct("root", end.alias("end"), at.alias("at"), F.col("left").alias("name"), "member", "n")
    lower = F.struct(end.alias("root"), "end", (at + 1).alias("at"), F.col("right").alias("name"), "member", "n")
    rows = cut.select(F.explode(F.array(upper, F.when(F.col("right").isNotNull(), lower))).alias("part")).where("part IS NOT NULL")
    # Lower halves are distinct already, as whole parts were; they only pass through.
    merged = rows.select("part.*").groupBy("root", "end", "at", "name").agg(F.min("member").alias("member"), F.sum("n").alias("n"))
    return merged.select("root", "end", "at", "member", "n")


def _endings(lengths: DataFrame, sizes: list[DataFrame]) -> DataFrame:
    """``key`` and ``node`` it ends at: the parts that a length is the sum of, named one after the other."""
    steps = []
    for level, parts in enumerate(sizes):
        has = lengths.where(F.shiftright("length", level) % 2 == 1)
        at = F.shiftright("length", level) - 1
        wanted = has.select("key", at.alias("at"))
        steps.append(wanted.join(parts.select("key", "at", "name"), ["key", "at"]).select("key", F.struct(F.lit(-level).alias("o"), "name").alias("s")))
    named = reduce(lambda a, b: a.union(b), steps).groupBy("key").agg(F.sort_array(F.collect_list("s")).alias("s"))
    node = F.aggregate("s", F.lit(ROOT), lambda node, step: _named(node, step["name"]))
    found = lengths.select("key").join(named.select("key", node.alias("node")), "key", "left")
    return found.select("key", F.coalesce("node", F.lit(ROOT)).alias("node"))


def _subtree_totals(values: DataFrame, edges: list[DataFrame], names: list[str]) -> DataFrame:
    """``values`` (``node``, ``depth``, and a number per name) summed over each node's subtree.

    ``edges[l]`` are the edges ``(root, end)`` of size ``2**l``.
    """
    def add(nodes: DataFrame, more: DataFrame) -> DataFrame:
        """What hangs on a node is added to it."""
        sums = more.groupBy("root").agg(*[F.sum(name).alias(f"_{name}") for name in names])
        sums = sums.withColumnRenamed("root", "node")
        both = [(F.col(name) + F.coalesce(F.col(f"_{name}"), F.lit(0))).cast("long").alias(name) for name in names]
        return nodes.join(sums, "node", "left").select("node", "depth", *both)

    # bands[l]: nodes at depths that 2**l divides, with the sums of the 2**l depths from theirs on.
    bands = [values]
    for level, pairs in enumerate(edges):
        below = bands[-1].where(F.shiftright("depth", level) % 2 == 1)
        above = bands[-1].where(F.shiftright("depth", level) % 2 == 0)
        grafts = pairs.join(below.withColumnRenamed("node", "end"), "end").select("root", *names)
        bands.append(materialize(add(above, grafts), "trie-bands"))
    totals = bands[-1]
    for level in reversed(range(len(edges))):
        own = bands[level].where(F.shiftright("depth", level) % 2 == 1)
        grafts = edges[level].join(totals.withColumnRenamed("node", "end"), "end").select("root", *names)
        totals = materialize(totals.unionByName(add(own, grafts)), "trie-totals")
    return totals


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, which come one after the other."""
    node, state = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]}, pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())]))

    for batch in batches:
        for here, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if here != node:
                if state is not None:
                    yield out()
                node, state = here, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
    if state is not None:
        yield out()


def ends_digest(ends: DataFrame) -> DataFrame:
    """``node`` and ``ends_sha256``: the digest of the keys that end there, ascending, comma-joined.

    Keys that are close are put together, ``2**KEY_BITS`` at most. A digest is made in one pass over a
    node's pieces by one task, which holds one batch of them: SHA-256 can't be put together from parts.
    """
    small_batches(ends.sparkSession)
    # Keys are distinct, so a piece is small.
    pieces = ends.groupBy("node", F.shiftright("key", KEY_BITS).alias("piece")).agg(F.sort_array(F.collect_set("key")).alias("keys"))
    text = F.array_join(F.transform("keys", lambda k: k.cast("string")), ",")
    placed = pieces.select("node", "piece", text.alias("text")).repartition("node").sortWithinPartitions("node", "piece")
    return placed.select("node", "text").mapInArrow(_hashed, "node binary, ends_sha256 string")


def prefix_trie(items: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of sequences, and where each sequence ends.

    ``items`` has ``key`` (a long), ``place`` (0, 1, 2, … without gaps within a key), ``symbol`` (16
    bytes that tell items apart) and ``weight`` (a long, the same for equal symbols). ``keys`` has each
    ``key`` once, also those without items, which end at the root; a null key is left out.

    Nodes have ``node`` (a name of 16 bytes), ``parent`` (null for the root), ``depth``, ``member`` (the
    smallest key of the sequences that start with the node's), ``n_members``, ``n_children``, ``n_leaves``
    (nodes without children in its subtree, itself included) and ``saved``: the sum over its subtree of
    each node's ``weight`` times its members but one. The item that a node ends with is the one of
    ``member`` at place ``depth - 1``. Without keys there is no node, not even the root.
    """
    keys = materialize(keys.where("key IS NOT NULL").select("key").distinct(), "trie-keys")
    parts = materialize(items.where("key IS NOT NULL").select("key", F.col("place").alias("at"), F.col("symbol").alias("name"), F.lit(True).alias("whole"), "weight"), "trie-items")
    longest = parts.agg(F.max("at")).first()[0]
    # The whole is longer than any sequence, so no sequence is a whole part.
    rounds = 0 if longest is None else (longest + 1).bit_length()
    sizes = [parts]
    for level in range(rounds):
        sizes.append(materialize(_halves(sizes[-1]), f"trie-parts-{level + 1}"))

    n_all = keys.agg(F.min("key").alias("member"), F.count(F.lit(1)).alias("n_members")).where("n_members > 0")
    root = n_all.select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "member", "n_members", F.lit(0).cast("long").alias("weight"))
    edges: list[DataFrame] = []
    if rounds:
        held = sizes[-1].groupBy("name").agg(F.min("key").alias("member"), F.count(F.lit(1)).alias("n"))
        held = held.select(F.lit(ROOT).alias("root"), F.lit(None).cast("binary").alias("end"), F.lit(0).cast("long").alias("at"), "member", "n")
        for level in reversed(range(rounds)):
            held = materialize(_cut(held, sizes[level + 1]), f"trie-cut-{level}")
            edges.append(held.where("end IS NOT NULL").select("root", "end"))
        edges.reverse()
        lasts = parts.select(F.col("key").alias("member"), "at", "weight")
        below = held.join(lasts, ["member", "at"]).select(F.col("end").alias("node"), F.col("root").alias("parent"), (F.col("at") + 1).alias("depth"), "member", F.col("n").alias("n_members"), "weight")
        nodes = materialize(root.unionByName(below), "trie-nodes")
        lengths = keys.join(parts.groupBy("key").agg(F.count(F.lit(1)).alias("length")), "key", "left")
        ends = materialize(_endings(lengths.select("key", F.coalesce("length", F.lit(0)).alias("length")), sizes[:-1]), "trie-ends")
    else:
        nodes = materialize(root, "trie-nodes")
        ends = keys.select("key", F.lit(ROOT).alias("node"))

    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    counted = materialize(counted, "trie-children")
    values = counted.select("node", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_members") - 1) * F.col("weight")).alias("saved"))
    totals = _subtree_totals(values, edges, ["n_leaves", "saved"]).drop("depth")
    return counted.drop("weight").join(totals, "node"), ends


def symbol(*parts: Column) -> Column:
    """A name of 16 bytes for an item made of texts; the lengths keep them apart."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return _named(F.concat(*[F.concat(F.octet_length(text).cast("string"), F.lit(":"), text) for text in texts]).cast("binary"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that start like others: the items and keys that ``prefix_trie`` takes.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % 5`` (all if it has fewer,
    none if there is no such conversation) in place of its own first ``h``; ``h`` is the unsigned
    CRC-32 of ``c`` as text, modulo 9. Turns are ordered by ``turn``, null first; equal numbers
    by the MD5 of role and text, as ``symbol`` has it. Null role and text are empty; rows without a
    ``conv_id`` are in no conversation. Texts are never shuffled.
    """
    items = turns.select(
        F.col("conv_id").cast("long").alias("key"), F.col("turn").alias("turn"), symbol(F.col("role"), F.col("text")).alias("symbol"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("weight"),
    )
    items = materialize(numbered(items, "key", ["turn", "symbol"]).select("key", "place", "symbol", "weight"), "trie-turns")
    base = F.col("key") - F.col("key") % 5
    first = (F.crc32(F.col("key").cast("string").cast("binary")) % 9).cast("long")
    counts = items.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select("key", "n", base.alias("base"), first.alias("h"))
    counts = materialize(counts, "trie-conversations")
    of_base = counts.select(F.col("key").alias("base"), F.col("n").alias("n_base"))
    facts = counts.join(of_base, "base", "left").select("key", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken"))
    facts = materialize(facts, "trie-taken")
    # The first turns: at most eight of each base, for the few that start like it.
    starts = items.where(F.col("place") < 8).withColumnRenamed("key", "base")
    starts = facts.join(starts, "base").where("place < h").select("key", "place", "symbol", "weight")
    rest = left_lookup(items.where(F.col("place") >= first), facts.select("key", "h", "taken"), "key")
    rest = rest.select("key", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "symbol", "weight")
    return starts.unionByName(rest), facts.select("key")


def conversation_trie(turns: DataFrame) -> DataFrame:
    """A row per node of the trie of all ``rebuilt`` conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``, the digest of the ids of the
    conversations that end at the node. Repeated rows are turns like any other. A table without
    a conversation gives no row. Other columns are ignored.
    """
    nodes, ends = prefix_trie(*rebuilt(turns))
    nodes = materialize(nodes, "trie-totalled")
    parents = nodes.select(F.col("node").alias("parent"), F.col("member").alias("parent_conv_id"))
    found = left_lookup(nodes, parents, "parent").join(ends_digest(ends), "node", "left")
    return found.select(
        F.col("member").alias("conv_id"), "depth", "parent_conv_id", F.col("n_members").alias("n_convs"), "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
