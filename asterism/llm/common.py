"""What the text operators share: batch limits, word spans and hashes, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship_package

#: Rows handed to a Python task at a time; texts are long, so far fewer than Spark's default.
BATCH_ROWS = 256
#: Bytes of text that numpy works on at a time (a longer text is taken by itself).
PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95
_INVERSE = {base: pow(base, -1, 1 << 64) for base in (_BASE, _WORD_BASE)}
_POWERS: dict[int, np.ndarray] = {}

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def beside(df: DataFrame, found: Column, names: list[str]) -> DataFrame:
    """``df`` with the fields ``names`` of the struct ``found``; its own columns of those names go."""
    kept = [F.col(f"_row.`{name}`") for name in df.columns if name not in names]
    rows = df.select(F.struct("*").alias("_row"), found.alias("_found"))
    return rows.select(*kept, *[F.col(f"_found.{name}").alias(name) for name in names])


def small_batches(spark: SparkSession) -> None:
    """Let Python tasks take few rows at a time, so that memory is bounded by a few long texts.

    Also makes sure that they can import this package, wherever the driver was started.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 ... base ** (n - 1)`` modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(n, PIECE_BYTES + 1)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 8 * PIECE_BYTES:
            _POWERS[base] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _running(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes start and end."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    running = _running(data.astype(np.uint64) + np.uint64(1), _BASE)
    return mixed((running[ends] - running[starts]) * powers(_INVERSE[_BASE], len(data) + 1)[starts])


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` words, given the words' hashes."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    running = _running(words, _WORD_BASE)
    n = len(words) - k + 1
    return mixed((running[k:] - running[:n]) * powers(_INVERSE[_WORD_BASE], n))


def pieces(raws: Iterable[bytes | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive UTF-8 texts as one piece: first row, end row, bytes, and each text's end in them.

    Texts are followed by a line feed, so that no word spans two of them. Nulls are empty.
    """
    rows, size, first = [], 0, 0
    for i, raw in enumerate(raws):
        raw = (raw or b"") + b"\n"
        if rows and size + len(raw) > PIECE_BYTES:
            yield _piece(first, rows)
            rows, size, first = [], 0, i
        rows.append(raw)
        size += len(raw)
    if rows:
        yield _piece(first, rows)


def _piece(first: int, rows: list[bytes]) -> tuple[int, int, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(raw) for raw in rows])
    return first, first + len(rows), np.frombuffer(b"".join(rows), np.uint8), ends


def packed(raws: pd.Series) -> pd.Series:
    """Texts compressed, so that a shuffle of whole texts moves less."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return pd.Series([None if raw is None else squeeze(bytes(raw)) for raw in raws], dtype=object)


def unpacked(raw: bytes | None) -> bytes:
    """What ``packed`` made of a text; empty for null."""
    return b"" if raw is None else zstandard.ZstdDecompressor().decompress(raw)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """The smallest number that each number reaches: ``(node, component)`` of ``(a, b)`` links.

    Alternating stars: each round, numbers link to the smallest number of their neighbourhood,
    first those above themselves, then the others. The rows never grow beyond the links, a
    number's neighbours are reduced by ``min`` before they are shuffled, and each round is
    written to the shared folder. Ends when a round changes nothing, after about log(n) rounds.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, label)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        following = materialize(small, label)
        changed = following.exceptAll(edges).limit(1).count() + edges.exceptAll(following).limit(1).count()
        edges = following
        if not changed:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
