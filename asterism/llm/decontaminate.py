"""Benchmark passages in documents, by latent semantic retrieval and subsequence checks.

Words (letters and digits, A-Z in lower case) are hashed to a fixed number of terms, and documents cut
into passages. A randomised singular value decomposition of the passages' TF-IDF matrix ``A`` takes
two passes over all documents: document frequencies, then ``Aᵀ(AΩ)`` for a random ``Ω``, which tasks sum
by themselves before the sums are shuffled. Passages are compared in the space of the leading
singular vectors, each scaled to unit variance, by their cosine.

A third pass compares each item of the benchmark with the windows of a document that are as long as the item,
one at each word, by their cosine in the latent space. Windows are left out where the subsequence that is looked
for cannot be: it has most of the item's words, and so some of the item's rarest ones, which must stand
near the window. What is close enough is checked word by word: an item is found where the longest common
subsequence of its words and those around the window is long enough. If it is not nearly whole,
the item's answer (its last words) must be there as well.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, pieces, small_batches, word_hashes, word_spans

TERMS = 1 << 14
RANK = 64
OVERSAMPLED = 16
#: Words of a passage.
PASSAGE = 24
#: Cosine in the latent space from which a window is checked.
CLOSE = 0.2
#: Rare words that must stand near a window, if the item's length asks for as many.
RARE = 4
#: Share of an item's words in the common subsequence: from where it is found with its answer, and
#: from where it is found without.
PARAPHRASED = 0.6
NEARLY_WHOLE = 0.85
#: Last words of an item that are its answer, and the share of them that must be there.
ANSWER = 6
ANSWERED = 0.5
#: Words below which an item says too little to be known by some of them: it is found where it stands word for word.
LEAST_WORDS = 5
#: Windows compared at a time.
WINDOWS_AT_ONCE = 4096
#: Items searched for in one pass over the documents.
ITEMS_AT_ONCE = 2000

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 10 if c == 10 else 32 for c in range(256))


def _plain(raw: bytes | None) -> bytes:
    return (raw or b"").translate(_TO_WORDS)


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) % TERMS


def _read(raws: list[bytes | None]) -> Iterator[tuple]:
    """For pieces of texts: first row, bytes, spans, hashes and terms of words, and each text's first word."""
    for first, end, data, text_ends in pieces(_plain(raw) for raw in raws):
        starts, ends = word_spans(data)
        if len(starts):
            base = np.searchsorted(starts, np.concatenate([[0], text_ends]))
            hashes = word_hashes(data, starts, ends)
            yield first, data, starts, ends, hashes, _terms(hashes), base


def _cut(base: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts cut into runs of ``size`` words, the last one shorter: first word and text of each."""
    counts = -(-np.diff(base) // size)
    text = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return base[text] + number * size, text


def _rows_of(terms: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """The terms of each run of words, a row each, filled up with the term ``TERMS`` of no weight."""
    ends = np.append(first[1:], len(terms))
    at = first[:, None] + np.arange(size)
    return np.where(at < ends[:, None], terms[np.minimum(at, len(terms) - 1)], TERMS)


def _products(rows: np.ndarray, values: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The sum over each row of its values times the matrix's rows; a few rows at a time, for the cache."""
    out = np.empty((len(rows), matrix.shape[1]), np.float32)
    for a in range(0, len(rows), 128):
        out[a : a + 128] = np.matmul(values[a : a + 128, None, :], matrix[rows[a : a + 128]])[:, 0]
    return out


def _extended(matrix: np.ndarray) -> np.ndarray:
    return np.concatenate([matrix, np.zeros_like(matrix[:1])])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, passages = np.zeros(TERMS, np.int64), 0
    for batch in batches:
        for *_, terms, base in _read(batch.column("raw").to_pylist()):
            rows = _rows_of(terms, _cut(base, PASSAGE)[0], PASSAGE).astype(np.uint16)
            rows.sort(axis=1)
            new = np.ones(rows.shape, bool)
            new[:, 1:] = rows[:, 1:] != rows[:, :-1]
            counts += np.bincount(rows[new], minlength=TERMS + 1)[:TERMS]
            passages += len(rows)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(counts[seen], passages))], ["term", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The inverse document frequency of each term, over all passages of ``docs`` (``raw``)."""
    rows = docs.select("raw").mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(TERMS)
    passages = max([r["n"] for r in rows if r["term"] < 0], default=0)
    for r in rows:
        if r["term"] >= 0:
            counts[r["term"]] = r["n"]
    return np.log((passages + 1) / (counts + 1)).astype(np.float32)


def _random_matrix() -> np.ndarray:
    bits = mixed(np.arange(TERMS * (RANK + OVERSAMPLED), dtype=np.uint64) + np.uint64(1))
    return np.where(bits & np.uint64(1), 1, -1).astype(np.float32).reshape(TERMS, -1)


def _sketch(weights: np.ndarray):
    """Each task's part of ``Aᵀ(AΩ)``, a row for each term."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega, scale = _extended(_random_matrix()), np.append(weights, np.float32(0))
        total = np.zeros_like(omega)
        for batch in batches:
            for *_, terms, base in _read(batch.column("raw").to_pylist()):
                rows = _rows_of(terms, _cut(base, PASSAGE)[0], PASSAGE)
                values = scale[rows]
                values /= np.sqrt(np.maximum((values * values).sum(axis=1, keepdims=True), 1e-12))
                products = _products(rows, values, omega)
                order = np.argsort(rows.ravel().astype(np.uint16), kind="stable")
                passage, value = order // rows.shape[1], values.ravel()[order]
                distinct, at, lengths = np.unique(rows.ravel()[order], return_index=True, return_counts=True)
                # Frequent terms by one product each, the others' first occurrences, second ones, and so on.
                for i in np.flatnonzero(lengths > 64):
                    own = slice(at[i], at[i] + lengths[i])
                    total[distinct[i]] += value[own] @ products[passage[own]]
                left, step = np.flatnonzero(lengths <= 64), 0
                while len(left):
                    now = at[left] + step
                    total[distinct[left]] += products[passage[now]] * value[now, None]
                    step += 1
                    left = left[lengths[left] > step]
        total = total[:TERMS]
        seen = np.flatnonzero(total.any(axis=1))
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array([row.tobytes() for row in total[seen]])], ["term", "part"])

    return work


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for term, part in zip(batch.column("term").to_pylist(), batch.column("part").to_pylist()):
            row = np.frombuffer(part, np.float32)
            sums[term] = sums[term] + row if term in sums else row.astype(np.float64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["term", "part"])


@dataclass
class Space:
    """The matrix that takes the terms of a passage into the latent space, and the terms' weights, which are part of it.

    Its size is fixed: ``TERMS`` rows, ``RANK`` columns.
    """

    matrix: np.ndarray
    weights: np.ndarray


def latent_space(docs: DataFrame) -> Space:
    """The latent space of the passages of ``docs`` (``raw``)."""
    weights = inverse_frequencies(docs)
    parts = docs.select("raw").mapInArrow(_sketch(weights), "term long, part binary")
    rows = parts.repartition(16, "term").mapInArrow(_summed, "term long, part binary").collect()
    y = np.zeros((TERMS, RANK + OVERSAMPLED))
    for r in rows:
        y[r["term"]] = np.frombuffer(r["part"], np.float64)
    # AᵀA is close to Y (ΩᵀY)⁻¹ Yᵀ.
    core = _random_matrix().T.astype(np.float64) @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    held = values > 1e-9 * max(values.max(), 1e-12)
    left, sizes, _ = np.linalg.svd(y @ (vectors[:, held] / np.sqrt(values[held])), full_matrices=False)
    rank = min(RANK, int((sizes > 1e-9 * max(sizes.max(initial=0), 1e-12)).sum()))
    return Space((weights[:, None] * left[:, :rank] / sizes[:rank]).astype(np.float32), weights)


def common_subsequence(masks: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """The length of the longest common subsequence of an item and some words.

    ``masks`` has, for each of the item's words, the bits of its places; a step takes all of them at once.
    """
    rest = full = (1 << size) - 1
    for word in words:
        mask = masks.get(word)
        if mask:
            met = rest & mask
            rest = ((rest + met) | (rest - met)) & full
    return size - rest.bit_count()


def _masks(words: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = defaultdict(int)
    for i, word in enumerate(words):
        out[word] |= 1 << i
    return dict(out)


@dataclass
class Queries:
    """Benchmark items: words, vectors, and by the hash of each rare word the items that have it."""

    ids: list[int]
    words: list[list[bytes]]
    vectors: np.ndarray
    sizes: np.ndarray
    needed: np.ndarray
    rare: np.ndarray
    first: np.ndarray
    items: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[int, bytes]], space: Space) -> Queries:
        known = [(i, words) for i, words in ((i, _plain(raw).split()) for i, raw in items) if words]
        vectors, needed, having = [], [], defaultdict(set)
        for at, (_, words) in enumerate(known):
            data = np.frombuffer(b" ".join(words), np.uint8)
            hashes = word_hashes(data, *word_spans(data))
            terms = _terms(hashes)
            vectors.append(space.matrix[terms].sum(axis=0))
            # A subsequence of so many words leaves out few, so of these and RARE more it has as many as RARE.
            least = len(words) if len(words) < LEAST_WORDS else -(-int(round(100 * PARAPHRASED)) * len(words) // 100)
            needed.append(min(RARE, least))
            order = np.lexsort((hashes, -space.weights[terms]))
            for word in hashes[order[: len(words) - least + needed[-1]]].tolist():
                having[word].add(at)
        rare = np.array(sorted(having), np.uint64)
        lists = [sorted(having[word]) for word in rare.tolist()]
        return cls(
            [i for i, _ in known], [words for _, words in known], _unit(np.array(vectors)) if known else np.zeros((0, 1), np.float32),
            np.array([len(words) for _, words in known], np.int64), np.array(needed, np.int64), rare,
            np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64), np.array([i for x in lists for i in x], np.int64),
        )

    def places(self, hashes: np.ndarray, base: np.ndarray) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """Text, item, and the ranges of windows (first and last word to start at) that have enough rare words around."""
        at = np.minimum(np.searchsorted(self.rare, hashes), len(self.rare) - 1)
        place = np.flatnonzero(self.rare[at] == hashes)
        word = at[place]
        counts = self.first[word + 1] - self.first[word]
        place = np.repeat(place, counts)
        item = self.items[np.repeat(self.first[word] - np.cumsum(counts) + counts, counts) + np.arange(len(place))]
        order = np.argsort(item, kind="stable")
        item, place = item[order], place[order]
        text = np.searchsorted(base, place, side="right") - 1
        other = np.arange(len(item)) + self.needed[item] - 1
        inside = np.minimum(other, len(item) - 1)
        met = (other < len(item)) & (item[inside] == item) & (text[inside] == text) & (place[inside] - place < 3 * self.sizes[item])
        found = np.flatnonzero(met)
        size = self.sizes[item[found]]
        low = np.maximum(place[inside[found]] - 2 * size + 1, base[text[found]])
        high = np.minimum(place[found] + size, np.maximum(base[text[found] + 1] - size, base[text[found]]))
        ranges: list[tuple[int, int]] = []
        for i, (row, which, a, b) in enumerate(zip(text[found].tolist(), item[found].tolist(), low.tolist(), high.tolist())):
            a = min(a, b)
            if ranges and a <= ranges[-1][1] + 1:
                ranges[-1] = (ranges[-1][0], max(b, ranges[-1][1]))
            else:
                ranges.append((a, b))
            if i + 1 == len(found) or text[found[i + 1]] != row or item[found[i + 1]] != which:
                yield row, which, ranges
                ranges = []


def _unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _window_cosines(vectors: np.ndarray, size: int, item: np.ndarray) -> np.ndarray:
    """Cosines of an item to the windows of so many words that start at each word; the last ones are shorter.

    An item of few words, or only of words that all passages have, is close to any window: its words decide.
    """
    if size < LEAST_WORDS or not item.any():
        return np.ones(len(vectors))
    sums = np.concatenate([np.zeros((1, vectors.shape[1])), np.cumsum(vectors, axis=0, dtype=np.float64)])
    ends = np.minimum(np.arange(len(vectors)) + size, len(vectors))
    return _unit(sums[ends] - sums[:-1]) @ item


class Checked:
    """An item's words, to be looked for around windows."""

    def __init__(self, words: list[bytes]):
        self.words, self.size = words, len(words)
        self.masks, self.last = _masks(words), _masks(words[-ANSWER:])
        self.n_last = min(ANSWER, self.size)

    def shares(self, around: list[bytes]) -> tuple[float, float] | None:
        """Shares of the item and of its answer in some words; none if it is not found there."""
        if self.size < LEAST_WORDS:
            whole = any(around[i : i + self.size] == self.words for i in range(len(around) - self.size + 1))
            return (1.0, 1.0) if whole else None
        share = common_subsequence(self.masks, self.size, around) / self.size
        answer = common_subsequence(self.last, self.n_last, around) / self.n_last
        return (share, answer) if share >= NEARLY_WHOLE or share >= PARAPHRASED and answer >= ANSWERED else None


def _search(space: Space, queries: Queries, close: float = CLOSE):
    names = ["doc", "item_id", "cosine", "lcs_share", "answer_share", "first_word"]

    def best_of(read: tuple, row: int, item: Checked, vector: np.ndarray, ranges: list[tuple[int, int]]) -> tuple | None:
        """Of the windows in some ranges that are close, the best one that has the item: shares, cosine and place."""
        raw, starts, ends, terms, base = read
        best: tuple | None = None
        size, begin, over = item.size, int(base[row]), int(base[row + 1])
        for low, high in ranges:
            for a in range(low, high + 1, WINDOWS_AT_ONCE):
                n = min(high + 1 - a, WINDOWS_AT_ONCE)
                cosines = _window_cosines(space.matrix[terms[a : min(a + n + size - 1, over)]], size, vector)[:n]
                while (cosines >= close).any():
                    top = int(np.argmax(cosines))
                    first, last = max(begin, a + top - size), min(over, a + top + 2 * size)
                    found = item.shares([raw[s:e] for s, e in zip(starts[first:last].tolist(), ends[first:last].tolist())])
                    if found:
                        best = max(best or (0.0,), (*found, float(cosines[top]), a + top - begin))
                        if found[0] == 1:
                            return best
                    # What is left are windows around which other words stand.
                    cosines[max(0, top - size // 2) : top + size // 2 + 1] = -np.inf
        return best

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checked = [Checked(words) for words in queries.words]
        for batch in batches:
            out: list[tuple] = []
            docs = batch.column("doc").to_pylist()
            for first_row, data, starts, ends, hashes, terms, base in _read(batch.column("raw").to_pylist()):
                read = data.tobytes(), starts, ends, terms, base
                for row, item, ranges in queries.places(hashes, base):
                    best = best_of(read, row, checked[item], queries.vectors[item], ranges)
                    if best:
                        out.append((docs[first_row + row], queries.ids[item], best[2], best[0], best[1], best[3]))
            kinds = [batch.schema.field("doc").type, pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names)

    return work


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and benchmark item found in it: ``key``, ``item_id``, ``cosine``,
    ``lcs_share``, ``answer_share`` and ``first_word`` (the number of the window's first word).

    Whole texts; a null text has no words. Items of fewer than ``LEAST_WORDS`` words are found where they stand word
    for word; those without words, and null ones, are not looked for. Repeated rows are found as often as they occur; items with equal texts
    are found together. The benchmark is the query set: its items go against all documents, a
    bounded number in each pass. Without documents or items, the result is empty.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc"), F.col(text).cast("binary").alias("raw"))
    schema = f"doc {docs.schema[key].dataType.simpleString()}, item_id long, cosine double, lcs_share double, answer_share double, first_word long"
    items = benchmark.select(F.col(item).cast("long").alias("i"), F.col(item_text).cast("binary").alias("raw"))
    items = items.where("i is not null and raw is not null")
    found = docs.sparkSession.createDataFrame([], schema)
    space, held = None, []
    for row in [*items.toLocalIterator(), None]:
        if row is not None:
            held.append((row["i"], bytes(row["raw"])))
        if held and (row is None or len(held) >= ITEMS_AT_ONCE):
            space = latent_space(rows) if space is None else space
            queries = Queries.of(sorted(held), space)
            if queries.ids:
                found = found.unionAll(rows.mapInArrow(_search(space, queries), schema))
            held = []
    return found.withColumnRenamed("doc", key)


def without_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", unkeyed: bool = False) -> DataFrame:
    """``docs`` without the rows that have a benchmark item. A row goes by its key and the hash of its text.

    Rows without a key stay, but for ``unkeyed``, with which they go like all others.
    """
    rows = docs.select(F.struct("*").alias("_row"), F.col(text).alias("text"), F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("hash")).alias("_name"))
    found = leaks(rows.select("_name", "text"), benchmark, "_name").select(F.col("_name").alias("_found")).distinct()
    if not unkeyed:
        found = found.where("_found.key is not null")
    same = F.col("_name.hash") == F.col("_found.hash")
    left = rows.join(found, same & F.col("_name.key").eqNullSafe(F.col("_found.key")), "left_anti")
    return left.select(*[F.col(f"_row.`{name}`") for name in docs.columns])
