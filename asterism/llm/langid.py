"""Language identification by string kernels.

The kernel of two texts is the number of character n-grams that both have, over the geometric
mean of the numbers that each has (a blended-spectrum presence kernel). N-grams are hashed to a
fixed number of places. One-versus-rest ridge regression is fitted on Nyström features, that is,
on a text's kernels with some landmark texts, whitened by the landmarks' own kernel matrix.

To score a batch of texts, ``X Zᵀ A``, the presence matrix ``X`` is multiplied with ``Zᵀ A``, which
is the same for all texts: the landmarks ``Z`` and the weights ``A`` are multiplied once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import beside, small_batches

#: Lengths of the n-grams, and places they are hashed to.
GRAMS = (2, 3, 4)
PLACES = 1 << 16
#: Texts scored by one matrix product.
SCORED_TOGETHER = 32
#: Bytes of eight places each that the fit unpacks at a time, of all texts it is fitted on.
UNPACKED_TOGETHER = 256
#: Bound of the labelled texts the model is fitted on: of each language, and of all.
ROWS_PER_LANGUAGE = 250
ROWS = 2000
LANDMARKS_PER_LANGUAGE = 50
LANDMARKS = 400
RIDGE = 1e-2
SHARPNESS = 4.0
UNDETERMINED = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16))
    return _LETTERS[0]


def presence(text: str | None) -> np.ndarray | None:
    """Which places the n-grams of a text fall on; None if the text has no letter.

    Letters are lower-cased, and what stands between words is one space.
    """
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = _letters()[np.minimum(code, 0xFFFF)]
    wide = np.flatnonzero(code > 0xFFFF)
    is_letter[wide] = [chr(c).isalpha() for c in code[wide]]
    if not is_letter.any():
        return None
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]
    code = np.where(is_letter, code, 32)[kept]
    code = np.concatenate([[32], code] if code[-1] == 32 else [[32], code, [32]]).astype(np.uint64)
    marks = np.zeros(PLACES, bool)
    for n in GRAMS:
        size = len(code) - n + 1
        if size > 0:
            gram = np.full(size, n, np.uint64)
            for i in range(n):
                gram = gram * np.uint64(0x100000001B3) + code[i : i + size]
            gram = (gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            marks[(gram >> np.uint64(40)) % np.uint64(PLACES)] = True
    return marks


@dataclass
class Model:
    """Languages in order, and the matrix that presence is multiplied with."""

    languages: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((PLACES, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        languages = np.full(len(texts), UNDETERMINED, object)
        scores = np.zeros(len(texts))
        marks = [presence(text) for text in texts]
        known = [i for i, row in enumerate(marks) if row is not None] if self.languages else []
        for at in range(0, len(known), SCORED_TOGETHER):
            rows = known[at : at + SCORED_TOGETHER]
            x = np.stack([marks[i] for i in rows]).astype(np.float32)
            values = (x @ self.weights) / np.sqrt(x.sum(axis=1, keepdims=True)) + self.bias
            odds = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
            best = values.argmax(axis=1)
            languages[rows] = [self.languages[i] for i in best]
            scores[rows] = 1 / odds.sum(axis=1)
        return pd.DataFrame({"lang_pred": languages, "score": scores})


def fit_rows(marks: np.ndarray, labels: list[str]) -> Model:
    """A model of presence rows, packed to bits, and their languages; the rows are in the order of preference.

    Places are unpacked a block at a time, so that no matrix of texts and places is ever whole.
    """
    languages = sorted(set(labels))
    labelled = np.array(labels)
    per = max(1, min(LANDMARKS_PER_LANGUAGE, LANDMARKS // max(1, len(languages))))
    landmarks = np.concatenate([np.flatnonzero(labelled == language)[:per] for language in languages])

    def unpacked(rows: np.ndarray, at: int) -> np.ndarray:
        return np.unpackbits(rows[:, at : at + UNPACKED_TOGETHER], axis=1).astype(np.float32)

    blocks = range(0, marks.shape[1], UNPACKED_TOGETHER)
    sizes, common = np.zeros(len(marks)), np.zeros((len(marks), len(landmarks)))
    for at in blocks:
        x = unpacked(marks, at)
        sizes += x.sum(axis=1)
        common += x @ x[landmarks].T
    lengths = np.sqrt(sizes)
    kernel = common / lengths[:, None] / lengths[landmarks]
    values, vectors = np.linalg.eigh(kernel[landmarks])
    held = values > 1e-6 * values.max()
    whitening = vectors[:, held] / np.sqrt(values[held])
    features = np.hstack([kernel @ whitening, np.ones((len(marks), 1))])
    target = np.where(labelled[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    penalty = RIDGE * len(marks) / max(1, len(languages)) * np.eye(features.shape[1])
    penalty[-1, -1] = 1e-9
    solved = np.linalg.solve(features.T @ features + penalty, features.T @ target)
    per_landmark = ((whitening @ solved[:-1]) / lengths[landmarks][:, None]).astype(np.float32)
    weights = np.concatenate([unpacked(marks[landmarks], at).T @ per_landmark for at in blocks])
    return Model(languages, weights, solved[-1])


def fit(df: DataFrame, text: str = "text", label: str = "lang", order: str = "doc_id") -> Model:
    """A model fitted on a bounded sample of the rows of ``df`` that have text and label.

    The sample is ``ROWS_PER_LANGUAGE`` rows of each language, ``ROWS`` at most, those whose
    ``order`` has the smallest hashes. Texts without a letter are left out of it. The driver gets
    a row of ``PLACES`` bits for each text of the sample. With more than ``ROWS`` languages, the
    most frequent ones are learned.
    """
    small_batches(df.sparkSession)
    rows = df.select(F.col(text).alias("text"), F.col(label).alias("label"), F.xxhash64(order).alias("at"))
    rows = rows.where(F.col("text").rlike(r"\p{L}") & F.col("label").isNotNull())
    counts = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(ROWS).collect()
    per = max(1, min(ROWS_PER_LANGUAGE, ROWS // max(1, len(counts))))
    ranked = rows.select("label", "at").withColumn(
        "rank", F.row_number().over(Window.partitionBy("label").orderBy("at"))
    )
    chosen = [(r["label"], r["at"]) for r in ranked.where(F.col("rank") <= per).collect()]
    wanted = {row["label"] for row in counts}
    spark = df.sparkSession
    chosen = spark.createDataFrame([c for c in chosen if c[0] in wanted], "label string, at long").distinct()
    # Bounded by ROWS, so it may be broadcast.
    pack = F.pandas_udf(_packed, "binary")
    sample = rows.join(F.broadcast(chosen), ["label", "at"]).select("label", "at", pack("text").alias("marks"))
    found = sample.groupBy("label", "at").agg(F.min("marks").alias("marks")).orderBy("at", "label").collect()
    if not found:
        return Model([])
    marks = np.frombuffer(b"".join(r["marks"] for r in found), np.uint8).reshape(len(found), -1)
    return fit_rows(marks, [r["label"] for r in found])


def _packed(texts: pd.Series) -> pd.Series:
    return pd.Series([np.packbits(presence(text)).tobytes() for text in texts])


def with_language(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, from the whole text alone.

    ``und`` with score 0 for a text that is null or has no letter, and for all texts if the model
    has no language. Ties go to the first language in alphabetical order. Columns of ``df`` with
    the new names are replaced. No shuffle; the model has a fixed size for each language.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    predict = F.pandas_udf(lambda texts: shared.value.predict(texts), "lang_pred string, score double")
    return beside(df, predict(F.col(text)), ["lang_pred", "score"])


def held_out(key: Column | str = "doc_id") -> Column:
    """Whether a row is kept out of the fit: the CRC-32 of its key as text leaves 2 when divided by 4."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
