"""Near-duplicate vectors by cover trees, traversed two at a time.

Vectors are scaled to unit length; a cosine is then a distance, ``sqrt(2 - 2 cos)``. Those of a label are
dealt to blocks of bounded size, in the order of the direction (of some fixed ones) that they are closest to.
Each block gets a cover tree: a node's children are picked from its vectors such that each vector is
within half the node's radius (the next power of two below it) of one of them; a node is its own
first child, so levels are nested. Each node knows how far its farthest vector really is.

Two trees are searched from their roots down. Nodes whose centers are farther apart than their radii and the
threshold together have no pair. Nodes that lie within the threshold as a whole link all their vectors, which
are counted and not listed. Others are replaced by their children, whose distances come from one
matrix product, down to single vectors, whose cosine decides. A tree is searched against itself, and
against the other trees of its label whose roots are close enough.

What comes out of a search is, for each vector, the number of its links, and another vector that it reaches,
so that a group of near copies gives as many rows as it has vectors (per pair of blocks) and not as pairs.
"""

from __future__ import annotations

import hashlib
import io
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import left_lookup
from ..operators.keys import with_dense_id
from ..session import materialize
from .common import components, small_batches

#: Numbers in the vectors of a block at most (and so its bytes / 8).
BLOCK_VALUES = 1 << 17
#: Fixed directions, by which alike vectors come into one block.
DIRECTIONS = 64
#: Rounding errors of distances stay below this; bounds are widened by it, and closer vectors are not told apart.
SLACK = 1e-7
#: Nodes of one tree whose distances to the other's are taken at a time.
TILE = 256

FOUND = "array<struct<id:bigint,n:bigint,reached:bigint>>"


class Linked:
    """Links found between numbered vectors: how many each has, and which vectors hang together."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.counts = np.zeros(len(weights), np.int64)
        self.parent = np.arange(len(weights))

    def _roots(self, at: np.ndarray) -> np.ndarray:
        roots = self.parent[at]
        while True:
            above = self.parent[roots]
            if (above == roots).all():
                self.parent[at] = roots
                return roots
            roots = above

    def join(self, at: np.ndarray) -> None:
        roots = self._roots(at)
        self.parent[roots] = roots.min()

    def rows(self, ids: np.ndarray) -> list[dict]:
        hit = np.flatnonzero(self.counts)
        reached = ids[self._roots(hit)]
        return [{"id": int(i), "n": int(n), "reached": int(r)} for i, n, r in zip(ids[hit], self.counts[hit], reached)]


@dataclass
class Tree:
    """A cover tree of unit vectors. Node 0 is the root; the vectors of a node, and its children, are consecutive."""

    ids: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def packed(self, given: np.ndarray) -> bytes:
        """The tree as bytes, with its vectors as they were ``given``."""
        out = io.BytesIO()
        np.savez(out, **{**vars(self), "vectors": given})
        return out.getvalue()

    @staticmethod
    def unpacked(raw: bytes) -> Tree:
        with np.load(io.BytesIO(raw)) as found:
            return Tree(**{**found, "vectors": _units(found["vectors"])})


def _units(vectors: np.ndarray) -> np.ndarray:
    """Vectors at unit length. They are scaled first, so that squares neither overflow nor vanish."""
    found = vectors.astype(np.float64)
    found /= np.abs(found).max(axis=1, keepdims=True)
    return found / np.linalg.norm(found, axis=1, keepdims=True) + 0.0


def _apart(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosines))


def _children(vectors: np.ndarray, rows: np.ndarray, away: np.ndarray, within: float) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Centers among ``rows``, the first of which is the node's own, with the rows near them and their distances."""
    found, rest = [], rows
    while len(rest):
        center = rest[0]
        if found:
            away = _apart(vectors[rest] @ vectors[center])
            away[0] = 0.0
        near = away <= within
        found.append((center, rest[near], away[near]))
        rest = rest[~near]
    return found


def cover_tree(ids: np.ndarray, weights: np.ndarray, vectors: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The cover tree of unit vectors, and the order that it has them in; its root is the one closest to their mean."""
    root = int(np.argmax(vectors @ vectors.mean(axis=0)))
    away = _apart(vectors @ vectors[root])
    away[root] = 0.0
    rows = np.concatenate([[root], np.delete(np.arange(len(vectors)), root)])
    order = np.empty(len(rows), np.int64)
    # A node as (center, vectors, their distances, place of its first vector in the order).
    nodes = [(root, rows, away[rows], 0)]
    center, radius, start, end, first, last = [], [], [], [], [], []
    at = 0
    while at < len(nodes):
        own, rows, away, place = nodes[at]
        reach = float(away.max())
        center.append(own)
        radius.append(reach)
        start.append(place)
        end.append(place + len(rows))
        first.append(len(nodes))
        if reach > SLACK:
            # The largest power of two that leaves at least one vector out.
            within = 2.0 ** (np.ceil(np.log2(reach)) - 1)
            for child in _children(vectors, rows, away, within):
                nodes.append((*child, place))
                place += len(child[1])
        else:
            order[place : place + len(rows)] = rows
        last.append(len(nodes))
        nodes[at] = None
        at += 1
    where = np.empty(len(order), np.int64)
    where[order] = np.arange(len(order))
    numbers = [np.array(x, np.int64) for x in (start, end, first, last)]
    return Tree(ids[order], weights[order], vectors[order], where[np.array(center)], np.array(radius), *numbers), order


@dataclass
class Side:
    """Nodes (-1 for a vector by itself) with their centers, radii and the spans of their vectors."""

    nodes: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    spans: np.ndarray

    def cut(self, a: int, b: int) -> Side:
        return Side(*[values[a:b] for values in vars(self).values()])


def _side(tree: Tree, first: int, last: int) -> Side:
    at = slice(first, last)
    return Side(np.arange(first, last), tree.center[at], tree.radius[at], np.stack([tree.start[at], tree.end[at]], axis=1))


def _vectors(tree: Tree, node: int) -> Side:
    rows = np.arange(tree.start[node], tree.end[node])
    return Side(np.full(len(rows), -1), rows, np.zeros(len(rows)), np.stack([rows, rows + 1], axis=1))


def _sides(one: Tree, i: int, two: Tree, j: int) -> tuple[Side, Side]:
    """What is compared next for two nodes: their children, but a leaf, or a node much smaller than the other, waits."""
    leaves = one.first[i] == one.last[i], two.first[j] == two.last[j]
    if all(leaves):
        return _vectors(one, i), _vectors(two, j)
    left, right = _side(one, one.first[i], one.last[i]), _side(two, two.first[j], two.last[j])
    if leaves[0] or not leaves[1] and two.radius[j] > 2 * one.radius[i]:
        left = _side(one, i, i + 1)
    elif leaves[1] or one.radius[i] > 2 * two.radius[j]:
        right = _side(two, j, j + 1)
    return left, right


def search(one: Tree, two: Tree, linked: Linked, least: float, shift: int) -> None:
    """Add the links between the vectors of two trees, or within one if they are the same.

    In ``linked`` the second tree's vectors are numbered from ``shift`` on.
    """
    limit = float(_apart(np.float64(least)))
    same = one is two
    stack = [(0, 0)]
    while stack:
        i, j = stack.pop()
        left, right = _sides(one, i, two, j)
        inner = same and i == j
        for at in range(0, len(left.nodes), TILE):
            tile = left.cut(at, at + TILE)
            cosines = one.vectors[tile.center] @ two.vectors[right.center].T
            reach = tile.radius[:, None] + right.radius[None, :]
            away = _apart(cosines)
            single = reach == 0.0
            all_linked = np.where(single, cosines >= least, away + reach <= limit - SLACK)
            waiting = ~single & ~all_linked & (away <= limit + reach + SLACK)
            if inner:  # each pair once
                all_linked, waiting = np.triu(all_linked, at + 1), np.triu(waiting, at + 1)
            _add(linked, all_linked, tile.spans, right.spans + shift)
            stack.extend((int(tile.nodes[a]), int(right.nodes[b])) for a, b in zip(*np.nonzero(waiting)))
        if inner:
            # A child with itself: all its vectors are that close, or it is searched within.
            for k in np.flatnonzero(left.spans[:, 1] - left.spans[:, 0] > 1):
                a, b = left.spans[k]
                if 2 * left.radius[k] <= limit - SLACK:
                    linked.counts[a:b] += linked.weights[a:b].sum() - linked.weights[a:b]
                    linked.join(np.arange(a, b))
                else:
                    stack.append((int(left.nodes[k]), int(left.nodes[k])))


def _add(linked: Linked, pairs: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Link the spans of ``left`` and ``right`` that ``pairs`` has."""
    rows = np.flatnonzero(pairs.any(axis=1))
    columns = np.flatnonzero(pairs.any(axis=0))
    if not len(rows):
        return
    pairs, left, right = pairs[np.ix_(rows, columns)], left[rows], right[columns]
    counted = np.concatenate([[0], np.cumsum(linked.weights)])
    weights = [counted[spans[:, 1]] - counted[spans[:, 0]] for spans in (left, right)]
    for spans, sums in ((left, pairs @ weights[1]), (right, weights[0] @ pairs)):
        # Spans of one side do not overlap.
        linked.counts[_within(spans)] += np.repeat(sums, spans[:, 1] - spans[:, 0])
    rest = np.ones(len(left), bool)
    while rest.any():
        # All that hangs together with the first row that is left.
        columns = pairs[np.argmax(rest)]
        while True:
            rows = pairs[:, columns].any(axis=1)
            wider = pairs[rows].any(axis=0)
            if (wider == columns).all():
                break
            columns = wider
        rest &= ~rows
        linked.join(np.concatenate([_within(left[rows]), _within(right[columns])]))


def _within(spans: np.ndarray) -> np.ndarray:
    sizes = spans[:, 1] - spans[:, 0]
    return np.repeat(spans[:, 1] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())


def _unit(vector) -> np.ndarray | None:
    """A vector at unit length; None if it has none, or is not all finite numbers."""
    if vector is None:
        return None
    found = np.array([np.nan if x is None else x for x in vector] if vector.dtype == object else vector, np.float64)
    if not len(found) or not np.isfinite(found).all() or not found.any():
        return None
    return _units(found[None])[0]


def _directions(size: int) -> np.ndarray:
    found = np.random.default_rng(size).standard_normal((DIRECTIONS, size))
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _prepared(labels: pd.Series, vectors: pd.Series) -> pd.DataFrame:
    """For each vector that can link: a digest of it and its label, its length, and its closest direction."""
    out: list[tuple] = []
    known: dict[int, np.ndarray] = {}
    for label, vector in zip(labels, vectors):
        unit = None if label is None else _unit(vector)
        if unit is None:
            out.append((None, None, None))
            continue
        name = label.encode()
        digest = hashlib.blake2b(b"%d:%b" % (len(name), name) + unit.tobytes(), digest_size=16).digest()
        if len(unit) not in known:
            known[len(unit)] = _directions(len(unit))
        out.append((digest, len(unit), int(np.argmax(known[len(unit)] @ unit))))
    return pd.DataFrame(out, columns=["digest", "size", "direction"]).astype({"size": "Int32", "direction": "Int32"})


def _tree_of(least: float):
    schema = pa.schema([
        ("label", pa.string()), ("size", pa.int32()), ("block", pa.int64()), ("center", pa.list_(pa.float64())), ("radius", pa.float64()), ("tree", pa.binary()),
        ("found", pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64()), ("reached", pa.int64())]))),
    ])

    def build(rows: pa.Table) -> pa.Table:
        ids, weights = rows["id"].to_numpy(), rows["copies"].to_numpy()
        given = np.stack(rows["vector"].to_numpy(zero_copy_only=False))
        tree, order = cover_tree(ids, weights, _units(given))
        linked = Linked(tree.weights)
        if len(ids) > 1:
            search(tree, tree, linked, least, 0)
        one = {name: rows[name][:1].to_pylist() for name in ("label", "size", "block")}
        one |= {"center": [tree.vectors[tree.center[0]]], "radius": [float(tree.radius[0])], "tree": [tree.packed(given[order])], "found": [linked.rows(tree.ids)]}
        return pa.table(one, schema)

    return build


def _searched(least: float):
    schema = pa.schema([("found", pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64()), ("reached", pa.int64())])))])

    def work(rows: pa.Table) -> pa.Table:
        one, two = [Tree.unpacked(raw.as_py()) for raw in rows["tree"]]
        linked = Linked(np.concatenate([one.weights, two.weights]))
        search(one, two, linked, least, len(one.ids))
        return pa.table({"found": [linked.rows(np.concatenate([one.ids, two.ids]))]}, schema)

    return work


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98) -> DataFrame:
    """A row for each row of ``df``: ``key``, ``n_links``, ``component_id`` and ``kept``.

    Rows link if their labels are equal and their vectors' cosine, in double precision, is ``least``
    or more. ``n_links`` counts the other rows that a row is linked to, copies included;
    ``component_id`` is the smallest key that links reach, its own included, and a row is kept if that is its own.

    Nothing links with a null label, or with a vector that is null, empty, zero, or has a null, an infinity or
    a NaN; vectors of unlike lengths don't link. A row without a key is like any other, but
    its key is not the smallest: ``component_id`` is null, and the row kept, if nothing it reaches has one.
    Rows that repeat, or share a key, are copies or rows like any other. Other columns are ignored.

    Equal vectors are one, with a count, before they meet. Blocks have ``BLOCK_VALUES`` numbers at most, whatever share of
    the rows a label has; each pair of blocks is searched by a task of its own. All pairs of blocks whose
    roots are close enough are searched: of vectors without structure, these are all of a label's.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be over 0 and at most 1")
    spark = df.sparkSession
    small_batches(spark)
    rows = df.select(F.col(key).alias("key"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector"))
    prepare = F.pandas_udf(_prepared, "digest binary, size int, direction int")
    rows = rows.withColumn("p", prepare("label", "vector")).select("key", "label", "vector", "p.*")
    known = rows.where("digest IS NOT NULL").groupBy("label", "size", "direction", "digest").agg(
        F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector")
    )
    known = with_dense_id(known, ["label", "size", "direction", "digest"], "id", start=0)
    per_block = F.greatest(F.lit(16), F.floor(F.lit(BLOCK_VALUES) / F.col("size"))).cast("long")
    known = known.withColumn("block", F.floor(F.col("id") / per_block))
    kinds = ["label", "size", "block"]
    trees = known.select(*kinds, "id", "copies", "vector").groupBy(*kinds).applyInArrow(
        _tree_of(least), f"label string, size int, block bigint, center array<double>, radius double, tree binary, found {FOUND}"
    )
    trees = materialize(trees, "vectors-trees")

    # Blocks of a label have consecutive numbers.
    roots = trees.select(*kinds, "center", "radius")
    last = roots.groupBy("label", "size").agg(F.max("block").alias("last"))
    each = left_lookup(roots, last, ["label", "size"]).where("block < last")
    each = each.select("label", "size", F.col("block").alias("one"), F.explode(F.sequence(F.col("block") + 1, F.col("last"))).alias("block"), F.col("center").alias("c1"), F.col("radius").alias("r1"))
    cosine = F.aggregate(F.zip_with("c1", "center", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    limit = float(_apart(np.float64(least)))
    close = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * cosine)) <= F.col("r1") + F.col("radius") + limit + SLACK
    pairs = each.join(roots, kinds).where(close).select("label", "size", "one", F.col("block").alias("two"))
    pairs = materialize(pairs, "vectors-pairs")
    sides = F.explode(F.array(F.col("one"), F.col("two"))).alias("block")
    shipped = pairs.select("label", "size", "one", "two", sides).join(trees.select(*kinds, "tree"), kinds)
    across = shipped.groupBy("label", "size", "one", "two").applyInArrow(_searched(least), f"found {FOUND}")
    found = trees.select("found").union(across).select(F.explode("found").alias("f")).select("f.*")
    found = materialize(found, "vectors-links")

    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    reached = components(found.select(F.col("id").alias("a"), F.col("reached").alias("b")), "vectors-components")
    facts = known.select("id", "digest", "least", "copies").join(counts, "id", "left")
    facts = facts.join(reached.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    facts = materialize(facts, "vectors-facts")
    smallest = facts.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = facts.join(smallest, "component").select("digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", F.lit(True).alias("known"))
    out = left_lookup(rows.select("key", "digest"), materialize(facts, "vectors-components"), "digest")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("key"))
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )
