"""Document quality by co-training of two views.

One classifier sees the text's content (which characters and pairs of characters it has, how often
its words repeat), the other what is known about the document around it (source, language, size and
lines). Each round, either scores all documents without a label and hands those it is sure enough
of to the other one, with the label it gives them. In the end both views' scores are
calibrated on labelled documents that neither was fitted on, and combined.

Views are logistic regressions, fitted on the driver on a bounded number of rows. Everything else, the
features, the search for the surest documents and the scores, covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import pieces, small_batches, word_hashes, word_spans

#: Labelled documents the views are fitted and calibrated on, at most, and the share kept for the latter.
LABELLED = 4000
CALIBRATION = 0.25
#: Rounds; how sure a view must be of a document to hand it over; and how many contents of either class it
#: hands over at most, the surest ones.
ROUNDS = 3
SURE = 0.8
HANDED_OVER = 150
#: Places for pairs of characters, and for the values of source and language.
PAIRS = 224
VALUES = 32
RIDGE = 1e-3
KEPT_FROM = 0.35

_CONTENT = PAIRS + 4
_AROUND = VALUES + 8
_KINDS = np.zeros(256, np.uint64)  # characters by kind: letters by themselves, others by their group
_KINDS[:] = 1
_KINDS[[0x20, *range(0x09, 0x0E)]] = 2
_KINDS[0x30:0x3A] = 3
_KINDS[0x41:0x5B] = 4
_KINDS[0x61:0x7B] = np.arange(8, 34)
for _i, _c in enumerate(b".,!?*#$%&|@-_=+/\\:;'\"()[]{}<>~^`"):
    _KINDS[_c] = 40 + _i
_KINDS[0x80:] = 5


def content_features(raws: list[bytes | None]) -> np.ndarray:
    """What each text is made of: square roots of the shares of hashed character pairs, and the
    shares of distinct words, of repeats of the word before, of capitals, and of other signs."""
    out = np.zeros((len(raws), _CONTENT), np.float32)
    for first, end, data, ends in pieces(raws):
        kinds = _KINDS[data]
        pairs = (kinds[:-1] * np.uint64(131) + kinds[1:]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
        pairs = (pairs % np.uint64(PAIRS)).astype(np.int64)
        starts, stops = word_spans(data)
        words = word_hashes(data, starts, stops)
        at = np.searchsorted(starts, np.concatenate([[0], ends]))
        begin = 0
        for row, stop in enumerate(ends.tolist()):
            size = stop - begin - 1
            if size > 0:
                out[first + row, :PAIRS] = np.sqrt(np.bincount(pairs[begin : stop - 1], minlength=PAIRS) / size)
                own, part = words[at[row] : at[row + 1]], kinds[begin : stop - 1]
                n = max(1, len(own))
                repeats = np.count_nonzero(own[1:] == own[:-1])
                out[first + row, PAIRS:] = (
                    len(np.unique(own)) / n, repeats / n, np.count_nonzero(part == 4) / size, np.count_nonzero((part >= 40) | (part == 3)) / size
                )
            begin = stop
    return out


def around_columns(df: DataFrame, text: str, columns: list[str]) -> Column:
    """What is known about a document, as an array: its size and lines, and hashed values of columns."""
    raw = F.coalesce(F.col(text), F.lit(""))
    chars = F.char_length(raw)
    lines = chars - F.char_length(F.replace(raw, F.lit("\n"), F.lit(""))) + 1
    numbers = [F.log1p(chars), F.log1p(lines), F.log1p(chars / lines), (chars == 0).cast("double"), F.col(text).isNull().cast("double")]
    hashed = [F.pmod(F.xxhash64(F.lit(name), F.col(name).cast("string")), F.lit(VALUES)) for name in columns]
    values = [sum(((h == i).cast("double") for h in hashed), F.lit(0.0)) for i in range(VALUES)]
    present = [F.col(name).isNotNull().cast("double") for name in columns[:3]] + [F.lit(0.0)] * (3 - len(columns[:3]))
    return F.array(*[x.cast("float") for x in (*values, *numbers, *present)])


def features(df: DataFrame, key: str, text: str, columns: list[str]) -> DataFrame:
    """``key``, ``content`` and ``around``, the features of each view as packed numbers."""
    small_batches(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("raw"), around_columns(df, text, columns).alias("around"))
    schema = f"key {df.schema[key].dataType.simpleString()}, content binary, around binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = content_features(batch.column("raw").to_pylist()).astype(np.float16)
            around = np.array(batch.column("around").to_pylist(), np.float32).reshape(len(content), -1)
            arrays = [batch.column("key"), pa.array([r.tobytes() for r in content]), pa.array([r.tobytes() for r in around])]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "content", "around"])

    return rows.mapInArrow(work, schema)


@dataclass
class View:
    """A logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, steps: int = 25) -> View:
        x = x.astype(np.float64)
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
        weights = np.zeros(z.shape[1])
        penalty = max(1.0, RIDGE * len(x)) * np.eye(len(weights))
        penalty[-1, -1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
            hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + penalty
            step = np.linalg.solve(hessian, z.T @ (y - p) - penalty @ weights)
            weights += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, weights)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]


def _unpack(content: list[bytes], around: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(content), np.float16).astype(np.float32).reshape(len(content), _CONTENT)
    return x, np.frombuffer(b"".join(around), np.float32).reshape(len(around), _AROUND)


@dataclass
class Model:
    """Both views and how their calibrated scores are combined; a constant if there is one class only."""

    content: View | None
    around: View | None
    combined: np.ndarray
    constant: float = 0.5

    def scores(self, content: np.ndarray, around: np.ndarray) -> np.ndarray:
        """Scores of the content view, of the other view, and of both combined, by row."""
        if self.content is None:
            return np.full((len(content), 3), self.constant)
        a, b = self.content.logits(content), self.around.logits(around)
        both = np.clip(self.combined[0] * a + self.combined[1] * b + self.combined[2], -30, 30)
        return 1 / (1 + np.exp(-np.stack([np.clip(a, -30, 30), np.clip(b, -30, 30), both], axis=1)))


def _with_scores(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (``key``, ``content``, ``around``) with the scores of ``model``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = f"{rows.schema.toDDL()}, content_score double, around_score double, score double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.scores(*_unpack(batch.column("content").to_pylist(), batch.column("around").to_pylist()))
            names = [*batch.schema.names, "content_score", "around_score", "score"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(found[:, i]) for i in range(3)]], names)

    return rows.mapInArrow(work, schema)


def _surest(scored: DataFrame, score: str) -> list:
    """The rows that a view is sure enough of, as good or as bad: a bounded number of either, found by a distributed sort.

    No row is both, as none scores high and low.
    """
    columns = ["key", "content", "around"]
    high = scored.where(F.col(score) >= SURE).orderBy(F.desc(score), "key").limit(HANDED_OVER).select(*columns, F.lit(1.0).alias("y")).collect()
    low = scored.where(F.col(score) <= 1 - SURE).orderBy(score, "key").limit(HANDED_OVER).select(*columns, F.lit(0.0).alias("y")).collect()
    return high + low


def co_train(rows: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    """Both views, fitted on at most ``LABELLED`` rows and what the views hand each other.

    ``rows`` has ``key``, ``content`` and ``around``; ``labels`` has ``key`` and ``y`` (0 or 1). The labels
    that are used are those whose keys have the smallest hashes. With labels of one class only,
    or none, the model is a constant: that class, or one half.
    """
    ordered = labels.where("key is not null and y is not null").groupBy("key").agg(F.max("y").cast("double").alias("y"))
    chosen = materialize(ordered.orderBy(F.xxhash64("key"), "key").limit(LABELLED), "quality-labels")
    # At most LABELLED rows, so they may be broadcast.
    known = rows.join(F.broadcast(chosen), "key").dropDuplicates(["key"]).orderBy(F.xxhash64("key"), "key").collect()
    if len({row["y"] for row in known}) < 2:
        return Model(None, None, np.zeros(3), known[0]["y"] if known else 0.5)
    x1, x2 = _unpack([r["content"] for r in known], [r["around"] for r in known])
    y = np.array([r["y"] for r in known])
    held = np.zeros(len(y), bool)
    for value in (0.0, 1.0):  # both classes on both sides, if there are two rows of it
        at = np.flatnonzero(y == value)
        held[at[: int(len(at) * CALIBRATION)]] = True
    fit = ~held
    train = [(x1[fit], y[fit]), (x2[fit], y[fit])]
    views = [View.fit(*train[0]), View.fit(*train[1])]
    # Copies are one document here, so that a large group of them is handed over once.
    unlabelled = rows.join(F.broadcast(chosen.select("key")), "key", "left_anti")
    unlabelled = unlabelled.groupBy("content", "around").agg(F.min("key").alias("key")).select("key", "content", "around")
    unlabelled = materialize(unlabelled, "quality-unlabelled")
    for _ in range(rounds):
        scored = _with_scores(unlabelled, Model(*views, np.array([1.0, 0.0, 0.0])))
        for i, score in enumerate(("content_score", "around_score")):
            found = _surest(scored, score)
            if found:
                other = 1 - i
                given = _unpack([r["content"] for r in found], [r["around"] for r in found])[other]
                x, labels_so_far = train[other]
                train[other] = np.vstack([x, given]), np.concatenate([labels_so_far, [r["y"] for r in found]])
        views = [View.fit(*train[0]), View.fit(*train[1])]
    side = held if len(set(y[held])) == 2 else fit
    logits = np.stack([views[0].logits(x1[side]), views[1].logits(x2[side])], axis=1)
    calibration = View.fit(logits, y[side])
    slopes = calibration.weights[:-1] / calibration.scale
    return Model(views[0], views[1], np.array([*slopes, calibration.weights[-1] - slopes @ calibration.mean]))


def scored(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", columns: list[str] | None = None) -> DataFrame:
    """``key``, ``score`` (0 to 1), ``content_score``, ``around_score`` and ``kept`` of every row of ``df``.

    Whole texts; a null text counts as empty and has a feature of its own. ``columns`` are the
    values known about a document (``source`` and ``lang`` unless given); nulls among them count as a
    value. Repeated rows get equal scores. ``kept`` is whether ``score`` is at least
    ``KEPT_FROM``: below one half, so that few good documents go. An empty
    table gives an empty one.
    """
    rows = materialize(features(df, key, text, ["source", "lang"] if columns is None else columns), "quality-features")
    model = co_train(rows, labels.select(F.col(key).alias("key"), F.col(label).alias("y")))
    found = _with_scores(rows, model)
    return found.select(F.col("key").alias(key), "score", "content_score", "around_score", (F.col("score") >= KEPT_FROM).alias("kept"))
