"""SimHash near-duplicates, found by tables of distances to reference fingerprints.

A fingerprint's bits are cut into blocks, two more than the bits that may differ, so that linked
fingerprints agree in at least two blocks. In each block every fingerprint has its Hamming
distances to reference fingerprints; where two blocks agree, so do all these coordinates, and
equal coordinates of two blocks are the key that pairs meet by. A pair is discarded if any of its
coordinates over the whole length differ by more than the allowed bits (the triangle inequality),
and the survivors are verified bit by bit.

A key with many fingerprints gives no pairs. Its members are linked through the fingerprints
around them instead: two that differ in at most ``d`` bits share a point which is at most
``ceil(d/2)`` bits from either, and a point has a bounded number of fingerprints around it. This is
exact, and grows with the number of members, not with its square.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import components, small_batches

BITS = 64
#: Reference fingerprints of each block, and of the whole length.
BLOCK_REFERENCES = 12
REFERENCES = 24
#: Members up to which the fingerprints of a key are compared pair by pair.
PAIRWISE = 32


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """The fingerprint of one text: bit by bit, whether over half of its shingles' hashes have it."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(token) + 1 for token in tokens]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    hashed = xxhash.xxh64_intdigest
    spans = zip(starts, ends[words - 1 :]) if len(tokens) >= words else [(0, len(joined))]
    hashes = np.array([hashed(joined[a:b], 42) for a, b in spans], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: Column | str, df: DataFrame, words: int = 3) -> Column:
    """The fingerprint of a text column, as a long with the same bits."""
    small_batches(df.sparkSession)

    def work(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(text, words) for text in texts], np.uint64).astype(np.int64))

    return F.pandas_udf(work, "long")(text)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _reference(i: int) -> int:
    return xxhash.xxh64_intdigest(str(i), 0)


def _distance(fp: Column, mask: int, reference: int) -> Column:
    return F.bit_count(fp.bitwiseAND(F.lit(_signed(mask))).bitwiseXOR(F.lit(_signed(reference & mask))))


def _blocks(n: int) -> list[int]:
    """Masks of ``n`` blocks that have all bits between them."""
    edges = [BITS * i // n for i in range(n + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def _block_key(fp: Column, mask: int, first: int) -> Column:
    """The distances to a block's references, as the digits of one number."""
    base, key = bin(mask).count("1") + 1, F.lit(0).cast("long")
    for i in range(BLOCK_REFERENCES):
        if base ** (i + 1) < 1 << 62:
            key = key * base + _distance(fp, mask, _reference(first + i))
    return key


def _ball(radius: int) -> list[tuple[int, int]]:
    """Masks with at most so many bits, and the number of their bits."""
    return [
        (_signed(sum(1 << bit for bit in bits)), size)
        for size in range(radius + 1)
        for bits in combinations(range(BITS), size)
    ]


def fingerprint_links(fps: DataFrame, max_bits: int = 2, pairwise: int = PAIRWISE) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct ``fp`` which differ in at most ``max_bits`` bits.

    Every link joins two such fingerprints; of a large group, enough links come out to connect
    all of it, not all its pairs.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be from 0 to 4")
    masks = _blocks(max_bits + 2)
    fp = F.col("fp")
    keys = F.array(*[
        F.struct(
            F.lit(i).alias("pair"),
            _block_key(fp, masks[a], 100 * a).alias("k1"),
            _block_key(fp, masks[b], 100 * b).alias("k2"),
        )
        for i, (a, b) in enumerate(combinations(range(len(masks)), 2))
    ])
    keyed = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.*")
    on = ["pair", "k1", "k2"]
    crowded = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = materialize(keyed.join(crowded, on), "simhash-keys")

    everywhere = (1 << BITS) - 1
    table = F.array(*[_distance(fp, everywhere, _reference(1000 + i)).cast("tinyint") for i in range(REFERENCES)])
    few = keyed.where(F.col("n") <= pairwise).withColumn("table", table)
    left = few.select(*on, fp.alias("a"), F.col("table").alias("ta"))
    right = few.select(*on, fp.alias("b"), F.col("table").alias("tb"))
    apart = F.greatest(*[F.abs(F.col("ta")[i] - F.col("tb")[i]) for i in range(REFERENCES)])
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = left.join(right, on).where(F.col("a") < F.col("b")).where(apart <= max_bits).where(near).select("a", "b")

    ball = F.array(*[F.struct(F.lit(mask).alias("mask"), F.lit(size).alias("r")) for mask, size in _ball(-(-max_bits // 2))])
    around = keyed.where(F.col("n") > pairwise).select("fp").distinct().select("fp", F.explode(ball).alias("m"))
    around = around.select(fp.bitwiseXOR(F.col("m.mask")).alias("z"), F.struct(F.col("m.r"), fp).alias("x"))
    points = around.groupBy("z").agg(F.min("x").alias("c"), F.collect_list("x").alias("xs"))
    stars = points.select("c", F.explode("xs").alias("x")).where(F.col("c.r") + F.col("x.r") <= max_bits)
    stars = stars.select(F.col("c.fp").alias("a"), F.col("x.fp").alias("b")).where("a <> b")
    return pairs.union(stars).distinct()


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3, max_bits: int = 2) -> DataFrame:
    """``key``, ``fingerprint`` and ``component_id`` of each row of ``df``.

    ``component_id`` is the smallest key that a row reaches through links, itself included. Texts
    that are null or have no word have fingerprint zero and link like any other. Repeated rows
    come out as often as they go in. A row without a key gets the smallest key of its component,
    null if there is none. An empty table gives an empty one.
    """
    prints = df.select(F.col(key).alias("key"), fingerprint(F.col(text), df, words).alias("fp"))
    prints = materialize(prints, "simhash-prints")
    fps = prints.groupBy("fp").agg(F.min("key").alias("least"))
    found = components(fingerprint_links(fps.select("fp"), max_bits), "simhash-links")
    labelled = fps.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left")
    labelled = labelled.select("fp", "least", F.coalesce("component", "fp").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    to_component = labelled.join(smallest, "label").select("fp", "component_id")
    return prints.join(to_component, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
