"""Importance resampling against a plain version, and odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from asterism.llm import importance

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, longest=2):
    words = re.findall(importance.WORD, (text or "").translate(LOWER))
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, buckets=10_000, percent=25, least=20):
    def counts(texts):
        return Counter(zlib.crc32(run.encode()) % buckets for text in texts for run in runs(text)[1])

    s, t = counts(text for _, text in docs), counts(target)
    ss, tt = sum(s.values()), sum(t.values())
    out = []
    for key, text in docs:
        words, own = runs(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in (zlib.crc32(run.encode()) % buckets for run in own)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(words), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    eligible = sorted((row for row in out if row[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1], r[2], r[3]))
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out), key=repr)


@pytest.fixture
def documents(spark):
    def build(rows, extra=False):
        schema = "doc_id long, text string" + (", `weight` string, `a.b` int" if extra else "")
        return spark.createDataFrame([(*row, "mine", 1) if extra else row for row in rows], schema)

    return build


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(0, "Solar power turns light into current " * 5), (1, None)], "item_id long, text string")


ROWS = [
    (1, "solar power, light & current! " * 8), (2, "other words about cooking and baking " * 6), (3, None), (4, ""), (5, "?! ..."),
    (6, "Ünïcode wörter 日本語 Straße " * 10), (7, "few words"), (None, "no key here but solar power " * 7), (8, "solar power, light & current! " * 8),
    (9, "other words about cooking and baking " * 6), (9, "other words about cooking and baking " * 6), (9, "another text under one key " * 9),
    (10, "solar " * 20_000), (11, "x" * 300_000 + " solar"),
]


def test_same_as_plain(rows, documents, target):
    want = plain(ROWS, ["Solar power turns light into current " * 5, None])
    got = rows(importance.importance(documents(ROWS), target, percent=50), "doc_id", "n_words", "n_features", "weight", "score", "rank")
    assert got == plain(ROWS, ["Solar power turns light into current " * 5, None], percent=50)
    got = rows(importance.importance(documents(ROWS, extra=True), target), "doc_id", "n_words", "n_features", "weight", "score", "rank")
    assert got == want


def test_few_buckets_and_long_runs(rows, documents, target, spark):
    # More runs than buckets are kept as counts.
    how = importance.Runs(longest=2, buckets=50)
    got = rows(importance.importance(documents(ROWS), target, how=how), "doc_id", "n_words", "n_features", "weight", "score", "rank")
    assert got == plain(ROWS, ["Solar power turns light into current " * 5, None], buckets=50)


def test_empty_tables(documents, target, spark):
    assert importance.importance(documents([]), target).count() == 0
    assert importance.resampled(documents([]), target).count() == 0
    none = spark.createDataFrame([], "text string")
    got = importance.importance(documents(ROWS[:2]), none).collect()
    assert len(got) == 2 and all(row["n_features"] for row in got)


def test_resampled_keeps_columns(documents, target):
    drawn = importance.importance(documents(ROWS), target, percent=50).where("rank IS NOT NULL")
    got = importance.resampled(documents(ROWS, extra=True), target, percent=50)
    assert got.columns == ["doc_id", "text", "a.b", "weight", "score"]
    assert {(r["doc_id"], r["score"]) for r in got.collect()} == {(r["doc_id"], r["score"]) for r in drawn.collect()}


@pytest.mark.parametrize("piece", [7, 64, 1 << 16])
def test_pieces(monkeypatch, piece):
    monkeypatch.setattr(importance, "PIECE_CHARS", piece)
    for text in ["Äpfel AB \x00 foo\x7fbar 日本語 𝔘x ̈z\n\t", "", "a" * 200 + " " + "b" * 10, "x y  z" * 40]:
        words, want = runs(text, 3)
        pieces = list(importance.run_hashes(text.encode(), 3))
        assert sum(n for n, _ in pieces) == len(words)
        assert sorted(h for _, hashes in pieces for h in hashes) == sorted(zlib.crc32(run.encode()) for run in want)
