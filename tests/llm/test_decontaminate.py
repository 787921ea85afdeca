"""Recall of decontamination, of what its own subsequence and answer rule accepts at any place of a document."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from asterism.llm import decontaminate
from asterism.llm.common import small_batches


@pytest.fixture(scope="module")
def texts(spark):
    small_batches(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("text").cast("binary").alias("raw")).where("raw IS NOT NULL")


@pytest.fixture(scope="module")
def space(texts):
    return decontaminate.latent_space(texts)


@pytest.fixture(scope="module")
def hosts(texts):
    words = [decontaminate._plain(bytes(row["raw"])).split() for row in texts.collect()]
    return [w for w in words if len(w) > 300]


def accepted(item, words):
    """Whether the rule holds around any window."""
    checked = decontaminate.Checked(item)
    size = len(item)
    return any(checked.shares(words[max(0, at - size) : at + 2 * size]) for at in range(max(1, len(words) - size + 1)))


@pytest.mark.parametrize("size,replaced,least", [
    (1, 0, 1), (3, 0, 1), (5, 0, 0.99), (7, 0, 0.99), (12, 0, 0.99), (40, 0, 0.99), (6, 0.35, 0.95), (7, 0.35, 0.95), (12, 0.35, 0.95), (20, 0.35, 0.95),
])
def test_recall_at_all_shifts(space, hosts, size, replaced, least):
    rng = random.Random(size)
    items, rows, wanted = [], [], set()
    for i in range(12):
        source = rng.choice(hosts)
        at = rng.randrange(len(source) - size)
        item = source[at : at + size]
        items.append((i, b" ".join(item)))
        for _ in range(6):
            host = rng.choice(hosts)[:80]
            words = list(item)
            for j in rng.sample(range(size), int(replaced * size)):
                words[j] = rng.choice(rng.choice(hosts))
            shift = rng.randrange(len(host))
            words = host[:shift] + words + host[shift:]
            if accepted(item, words):
                wanted.add((len(rows), i))
            rows.append(b" ".join(words))
    queries = decontaminate.Queries.of(items, space)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, pa.binary())], ["doc", "raw"])
    found = {pair for out in decontaminate._search(space, queries)([batch]) for pair in zip(out["doc"].to_pylist(), out["item_id"].to_pylist())}
    assert wanted and len(wanted & found) >= least * len(wanted)


def test_short_items_are_found_word_for_word(spark):
    docs = spark.createDataFrame([(1, "A rare Zebra, runs!"), (2, "a zebra rare runs"), (3, "zebra"), (4, None), (5, "rare zebra runs " * 3000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "rare zebra runs"), (2, "zebra"), (3, "..."), (4, None)], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).select("doc_id", "item_id").distinct().collect())
    assert got == [(1, 1), (1, 2), (2, 2), (3, 2), (5, 1), (5, 2)]


def test_ties_and_repeated_rows(spark):
    passage = "the quick brown fox jumps over the lazy dog near the old river bank today"
    docs = spark.createDataFrame([(1, passage), (1, passage), (1, "clean text of other words " * 4), (2, "before " * 30 + passage + " after" * 30)], "doc_id long, text string")
    items = spark.createDataFrame([(7, passage), (8, passage)], "item_id long, text string")
    got = decontaminate.leaks(docs, items)
    assert sorted((r["doc_id"], r["item_id"], r["lcs_share"]) for r in got.collect()) == [(1, 7, 1.0)] * 2 + [(1, 8, 1.0)] * 2 + [(2, 7, 1.0), (2, 8, 1.0)]
    assert [r["text"][:5] for r in decontaminate.without_leaks(docs, items).collect()] == ["clean"]
