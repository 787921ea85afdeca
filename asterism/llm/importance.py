"""Documents drawn by how much they look like a target corpus.

A text's words are cut out by an untrained ``Split`` of the tokenizers library over the text in lower case
(A-Z only), which gives each word with its offsets. Runs of consecutive words are windows from one
word's start to another's end; what stands between the words counts as one space. The CRC-32 of a run is
its bucket, so that a corpus is a histogram of bounded size, which tasks sum by themselves before
buckets are summed across tasks. The logarithm of a bucket's share in the target over its share in the
documents is its gain, and a document's weight the mean gain of its runs. Weights get
a noise that hangs on the document's key alone (Gumbel's, so that the highest sums are a draw without
replacement), and the highest scores are drawn.

Texts are tokenised once for histograms and weights: a document's buckets are written, two bytes for each run, or
as counts of all buckets if these are fewer.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from ..operators.keys import with_dense_id
from ..session import materialize
from .common import beside, small_batches

#: Digits, lower-case letters, and all that is not ASCII; what else there is.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OTHER = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Characters tokenised at a time; a piece ends where a word does.
PIECE_CHARS = 1 << 16

_SPLIT: list = []


def word_offsets(raw: bytes | None) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Pieces of a UTF-8 text in lower case, each with its words' offsets. Bytes that are no UTF-8 are words of U+FFFD."""
    if not _SPLIT:
        _SPLIT.append(pre_tokenizers.Split(Regex(WORD), "removed", invert=True))
    text = (raw or b"").lower().decode("utf-8", "replace")  # of bytes, only A-Z have a lower case
    at = 0
    while at < len(text):
        end = at + PIECE_CHARS
        edge = OTHER.search(text, end) if end < len(text) else None
        end = edge.start() if edge else len(text)
        piece = text[at:end]
        yield piece, [span for _, span in _SPLIT[0].pre_tokenize_str(piece)]
        at = end


def run_hashes(raw: bytes | None, longest: int) -> Iterator[tuple[int, list[int]]]:
    """For each piece of a text its number of words, and the CRC-32 of all runs of 1 to ``longest`` words that end in it.

    A run is a window of as many offsets one after the other, of which the next word makes a longer one.
    """
    open_: deque[int] = deque(maxlen=longest - 1)  # checksums of the windows that end at the word before
    for piece, offsets in word_offsets(raw):
        hashes: list[int] = []
        for start, end in offsets:
            word = piece[start:end].encode()
            spaced = b" " + word
            ends = [zlib.crc32(word), *[zlib.crc32(spaced, window) for window in open_]]
            hashes += ends
            open_ = deque(ends[: longest - 1], maxlen=longest - 1)
        yield len(offsets), hashes


@dataclass(frozen=True)
class Runs:
    """Which runs are counted: of 1 to ``longest`` words, in so many buckets."""

    longest: int = 2
    buckets: int = 10_000

    def of(self, raw: bytes | None) -> tuple[int, int, bytes | None, bytes | None]:
        """Numbers of words and runs; the runs' buckets, or if there are more than buckets, the count of each."""
        n_words = n_runs = 0
        parts: list[np.ndarray] = []
        counts = None
        for n, hashes in run_hashes(raw, self.longest):
            n_words += n
            n_runs += len(hashes)
            parts.append((np.array(hashes, np.uint32) % self.buckets).astype("<u4" if self.buckets > 1 << 16 else "<u2"))
            if counts is not None or n_runs > self.buckets:
                sums = np.bincount(np.concatenate(parts), minlength=self.buckets).astype("<i8")
                counts = sums if counts is None else counts + sums
                parts = []
        if counts is not None:
            return n_words, n_runs, None, counts.tobytes()
        return n_words, n_runs, b"".join(part.tobytes() for part in parts), None

    def numbers(self, runs: bytes) -> np.ndarray:
        return np.frombuffer(runs, "<u4" if self.buckets > 1 << 16 else "<u2")


def counted(df: DataFrame, text: str, how: Runs) -> DataFrame:
    """``df`` with ``n_words``, ``n_features`` and what ``Runs.of`` gives for its texts; the text goes."""
    small_batches(df.sparkSession)

    def work(raws: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([how.of(raw) for raw in raws], columns=["n_words", "n_features", "runs", "counts"])

    count = F.pandas_udf(work, "n_words long, n_features long, runs binary, counts binary")
    found = beside(df, count(F.col(text).cast("binary")), ["n_words", "n_features", "runs", "counts"])
    return found.select(*[name for name in found.columns if name != text])


def histogram(rows: DataFrame, how: Runs) -> np.ndarray:
    """How many runs of all ``rows`` (as ``counted`` made them) fall into each bucket."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(how.buckets, np.int64)
        for batch in batches:
            for runs, counts in zip(batch.column(0), batch.column(1)):
                if counts.is_valid:
                    sums += np.frombuffer(counts.as_buffer(), "<i8")
                elif runs.is_valid:
                    sums += np.bincount(how.numbers(runs.as_buffer()), minlength=how.buckets)
        hit = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": hit, "n": sums[hit]})

    sums = rows.select("runs", "counts").mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(how.buckets, np.int64)
    for row in sums.collect():  # a row for each bucket at most
        total[row["bucket"]] = row["n"]
    return total


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths, rounded down; one is added to every count."""
    n, all_documents, all_target = len(documents), int(documents.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float(t + 1) * float(all_documents + n) / (float(s + 1) * float(all_target + n))))
        for s, t in zip(documents.tolist(), target.tolist())
    ], np.int64)


def _weights(gain: np.ndarray, how: Runs):
    def work(n: pd.Series, runs: pd.Series, counts: pd.Series) -> pd.Series:
        out = []
        for size, own, all_ in zip(n, runs, counts):
            total = int(np.frombuffer(all_, "<i8") @ gain) if all_ is not None else int(gain[how.numbers(own)].sum())
            out.append(total // size if size else 0)
        return pd.Series(out, dtype="int64")

    return F.pandas_udf(work, "long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the first 32 bits of the SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _scored(docs: DataFrame, target: DataFrame, key: str, text: str, how: Runs, seed: int) -> tuple[DataFrame, np.ndarray]:
    rows = materialize(counted(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", how), "importance-runs")
    wanted = counted(target.select(F.col(text).alias("text")), "text", how)
    gain = gains(histogram(rows, how), histogram(wanted, how))
    weight = _weights(gain, how)("n_features", "runs", "counts")
    scored = rows.select("key", "n_words", "n_features", weight.alias("weight")).withColumn("score", F.col("weight") + noise(F.col("key"), seed))
    return materialize(scored, "importance-scores"), gain


def _ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` with ``rank``, from 1, of those drawn. Scores are ordered by range partitions."""
    eligible = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    n_drawn = scored.where(eligible).count() * percent // 100
    order = scored.where(eligible).withColumns({"_down": -F.col("score"), "_last": F.col("key").isNull()})
    placed = with_dense_id(order, ["_down", "_last", "key"], "rank", unique=False)
    placed = placed.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    rest = scored.where(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return placed.select(*rest.columns).unionByName(rest)


def importance(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", how: Runs = Runs(), percent: int = 25, least_words: int = 20, seed: int = 7
) -> DataFrame:
    """A row for each row of ``docs``: ``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Drawn are the highest scores of rows with ``least_words`` words or more, ``percent`` of a hundred of these, rounded
    down; ``rank`` orders them from 1 and is null for the rest. Equal scores go by the smaller key (none comes last), then
    by the other columns, so that rows which share key and score may be drawn in part.

    A null or empty text has no run and weight 0. Without target texts, or without documents, counts
    are zero. Other columns of both tables are ignored; the target's texts are in its column ``text`` too.
    """
    scored, _ = _scored(docs, target, key, text, how, seed)
    return _ranked(scored, percent, least_words).withColumnRenamed("key", key)


def resampled(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", how: Runs = Runs(), percent: int = 25, least_words: int = 20, seed: int = 7
) -> DataFrame:
    """The rows of ``docs`` that ``importance`` draws, with all their columns, and their ``weight`` and ``score``.

    The driver gets the last one drawn, and each row is held against it: texts are tokenised once more, and
    never shuffled. Rows that share key and score with the last one are all drawn. Columns of ``docs`` with the new names
    are replaced.
    """
    scored, gain = _scored(docs, target, key, text, how, seed)
    last = _ranked(scored, percent, least_words).where("rank IS NOT NULL").orderBy(F.desc("rank")).select("score", "key").first()
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"), F.col(key).alias("key"), F.col(text).alias("text"))
    rows = counted(rows, "text", how).withColumn("weight", _weights(gain, how)("n_features", "runs", "counts"))
    rows = rows.withColumn("score", F.col("weight") + noise(F.col("key"), seed))
    if last is None:
        drawn = F.lit(False)
    else:
        # A missing key is the last of its score.
        before = F.lit(True) if last["key"] is None else F.coalesce(F.col("key") <= F.lit(last["key"]), F.lit(False))
        drawn = (F.col("score") > last["score"]) | (F.col("score") == last["score"]) & before
    kept = [F.col(f"doc.`{name}`") for name in docs.columns if name not in ("weight", "score")]
    return rows.where((F.col("n_words") >= least_words) & drawn).select(*kept, "weight", "score")
