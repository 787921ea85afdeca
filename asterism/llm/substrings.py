"""Removal of passages that an earlier document has, located by Aho-Corasick automata.

A passage is a run of consecutive words (13 of them), and is removed where a document with a smaller
id has the same run. Runs are not compared one by one over the corpus:

1. Of the short word grams in a run, the one with the smallest hash is its anchor. Equal runs have
   equal anchors, and about one word in five is one. One shuffle of anchors (16 bytes for each and
   text; a task sends a text that it has seen before only once) finds those that two texts have.
2. Only around those anchors, the words of the runs that share the anchor are cut out as a stretch.
3. Stretches are dealt into shards by their anchor. A shard confirms which of its runs two documents
   have, compiles these into an automaton, and streams its stretches through it. Anchors with very
   many stretches are not dealt to one task: their runs are reduced, counted and joined as rows.
4. What was located goes back to the documents as word positions.

Copies of a whole text take no part in this: they keep nothing, if they have a whole run. Whole texts
are shuffled once, compressed: both joins with them, before and after the shards, read that shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import gram_hashes, packed, pieces, small_batches, unpacked, word_hashes, word_spans

RUN = 13
GRAM = 5
#: Stretches that one automaton is compiled from.
SHARD = 20_000
#: Texts that have an anchor; beyond that its stretches are not dealt to a shard.
CROWD = 250_000
#: Stands for no key, so that keys are never null where tables are joined.
NO_KEY = -(1 << 63)


def anchors_of(raws: Iterable[bytes | None], run: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For pieces of texts, a row per anchor: text, hash, first and last run, and the words' places.

    ``(row, hash, first, last, base, data, starts, ends)``; runs are numbered from their first word
    within the piece, and ``base`` has the number of each text's first word.
    """
    width = run - GRAM + 1
    for first_row, end_row, data, text_ends in pieces(raws):
        starts, ends = word_spans(data)
        row = np.searchsorted(text_ends, starts, side="right")
        base = np.searchsorted(row, np.arange(end_row - first_row))
        n = len(starts) - run + 1
        whole = np.flatnonzero(row[: max(n, 0)] == row[run - 1 :]) if n > 0 else np.zeros(0, np.int64)
        if len(whole):
            grams = gram_hashes(word_hashes(data, starts, ends), GRAM)
            at = whole + np.lib.stride_tricks.sliding_window_view(grams, width)[whole].argmin(axis=1)
            new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 0) | (np.diff(whole) != 1)]))
            last = whole[np.concatenate([new[1:] - 1, [len(whole) - 1]])]
            anchor = grams[at[new]].astype(np.int64)
            yield first_row + row[whole[new]], anchor, whole[new], last, first_row, base, data, starts, ends


def _text_id(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def _anchors(run: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, raws = batch.column("t1").to_numpy(), batch.column("raw").to_pylist()
            for i, t1 in enumerate(ids.tolist()):
                if t1 in seen:
                    raws[i] = None
                seen.add(t1)
            for row, anchor, *_ in anchors_of(raws, run):
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(ids[row])], ["anchor", "t1"])

    return work


def _stretches(run: int, wanted: str):
    """The stretches around a document's anchors in the column ``wanted``."""
    names = ["doc", "t1", "start", "anchor", "words"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, ids = batch.column("doc").to_numpy(), batch.column("t1").to_numpy()
            lists = [set(row or ()) for row in batch.column(wanted).to_pylist()]
            raws = [unpacked(raw) if held else None for raw, held in zip(batch.column("packed").to_pylist(), lists)]
            for row, anchor, first, last, first_row, base, data, starts, ends in anchors_of(raws, run):
                held = [i for i, (r, a) in enumerate(zip(row.tolist(), anchor.tolist())) if a in lists[r]]
                text, lo, hi = data.tobytes(), starts[first[held]].tolist(), ends[last[held] + run - 1].tolist()
                cut = [b" ".join(text[a:b].split()).decode("utf-8", "replace") for a, b in zip(lo, hi)]
                start = (first[held] - base[row[held] - first_row]).astype(np.int32)
                columns = [pa.array(docs[row[held]]), pa.array(ids[row[held]]), pa.array(start), pa.array(anchor[held]), pa.array(cut, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return work


def runs_in(words: str, run: int) -> list[str]:
    """The runs of a stretch, each between single spaces."""
    tokens = words.split(" ")
    return [f" {' '.join(tokens[i : i + run])} " for i in range(len(tokens) - run + 1)]


def locate(stretches: list[tuple[str, int, int]], run: int) -> list[list[int | None]]:
    """For each run of each stretch ``(words, smallest, largest document)``, the smallest document
    that has it, if two documents have it.

    The runs that two documents have are compiled into an automaton, and each stretch is read by it.
    """
    seen: dict[str, tuple[int, int]] = {}
    for words, low, high in stretches:
        for passage in runs_in(words, run):
            known = seen.get(passage)
            seen[passage] = (low, high) if known is None else (min(low, known[0]), max(high, known[1]))
    automaton = ahocorasick.Automaton()
    for passage, (low, high) in seen.items():
        if low < high:
            automaton.add_word(passage, low)
    found: list[list[int | None]] = []
    if not len(automaton):
        return [[None] * (words.count(" ") + 2 - run) for words, _, _ in stretches]
    automaton.make_automaton()
    for words, _, _ in stretches:
        text = f" {words} "
        row: list[int | None] = [None] * (words.count(" ") + 2 - run)
        # A run ends at the space after its last word; spaces up to there number the run.
        ends = {at: i for i, at in enumerate(i for i, c in enumerate(text) if c == " ")}
        for at, low in automaton.iter(text):
            row[ends[at] - run] = low
        found.append(row)
    return found


def _shards(run: int, shard: int):
    def covering(rows: list[tuple]) -> pa.RecordBatch:
        # Equal stretches once, with the smallest and largest document.
        spans: dict[str, tuple[int, int]] = {}
        for doc, _, _, _, words in rows:
            low, high = spans.get(words, (doc, doc))
            spans[words] = (min(low, doc), max(high, doc))
        firsts = dict(zip(spans, locate([(words, *span) for words, span in spans.items()], run)))
        found = [(doc, t1, [start + i for i, first in enumerate(firsts[words]) if first is not None and first < doc]) for doc, t1, start, _, words in rows]
        found = [row for row in found if row[2]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], kind) for i, kind in enumerate(kinds)], ["doc", "t1", "covering"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                # Rows come sorted, so an anchor's stretches stay in one shard.
                if len(held) >= shard and held[-1][3] != row[3]:
                    yield covering(held)
                    held = []
                held.append(row)
        if held:
            yield covering(held)

    return work


def _joined_runs(stretches: DataFrame, run: int) -> DataFrame:
    """What the shards find, for anchors with very many stretches: runs as rows, reduced and joined."""
    tokens = F.split("words", " ")
    cut = F.transform(F.sequence(F.lit(1), F.size(tokens) - run + 1), lambda i: F.array_join(F.slice(tokens, i, run), " "))
    equal = stretches.groupBy("anchor", "words").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    rows = equal.select("anchor", "words", "low", "high", F.posexplode(cut).alias("i", "passage"))
    on = ["anchor", "passage"]
    firsts = rows.groupBy(*on).agg(F.min("low").alias("first"), F.max("high").alias("last")).where("first < last")
    found = rows.select(*on, "words", "i").join(firsts.select(*on, "first"), on)
    listed = found.groupBy("anchor", "words").agg(F.collect_list(F.struct("i", "first")).alias("f"))
    placed = stretches.join(listed, ["anchor", "words"])
    numbers = F.transform(F.filter("f", lambda x: x["first"] < F.col("doc")), lambda x: F.col("start") + x["i"])
    return placed.select("doc", "t1", numbers.alias("covering")).where("size(covering) > 0")


def located(docs: DataFrame, texts: DataFrame, run: int, shard: int = SHARD, crowd: int = CROWD) -> DataFrame:
    """``doc``, ``t1`` and ``covering``, the numbers of the first words of the runs to remove.

    ``docs`` has ``doc``, ``raw``, ``t1`` and ``t2``, ``texts`` has ``doc``, ``t1`` and ``packed``. Only the
    smallest document of each text is searched.
    """
    keyed = docs.where(F.col("doc") != NO_KEY)
    anchors = keyed.select("raw", "t1").mapInArrow(_anchors(run), "anchor long, t1 long").repartition("anchor")
    same = Window.partitionBy("anchor")
    spread = {"low": F.min("t1").over(same), "high": F.max("t1").over(same), "n": F.count(F.lit(1)).over(same)}
    shared = anchors.withColumns(spread).where("low < high").groupBy("t1").agg(
        F.collect_set(F.when(F.col("n") <= crowd, F.col("anchor"))).alias("anchors"),
        F.collect_set(F.when(F.col("n") > crowd, F.col("anchor"))).alias("crowded"),
    )
    shared = materialize(shared, "substring-anchors")
    firsts = keyed.select("doc", "t1", "t2").groupBy("t1", "t2").agg(F.min("doc").alias("doc")).drop("t2")
    searched = texts.join(firsts.join(shared, "t1"), ["doc", "t1"]).dropDuplicates(["doc", "t1"])
    kinds = "doc long, t1 long, start int, anchor long, words string"
    cut = searched.mapInArrow(_stretches(run, "anchors"), kinds).repartition("anchor").sortWithinPartitions("anchor")
    found = cut.mapInArrow(_shards(run, shard), "doc long, t1 long, covering array<int>")
    if shared.where("size(crowded) > 0").limit(1).count():
        crowds = materialize(searched.mapInArrow(_stretches(run, "crowded"), kinds), "substring-crowds")
        found = found.union(_joined_runs(crowds, run))
    return found.groupBy("doc", "t1").agg(F.flatten(F.collect_list("covering")).alias("covering"))


def _cleaned(run: int, texts_too: bool):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for raw, copied, covering in zip(rows["packed"], rows["copied"], rows["covering"]):
            words = unpacked(raw).split()
            gone = np.zeros(len(words) + 1, np.int64)
            if copied and len(words) >= run:
                gone[0] = 1
            elif covering is not None:
                np.add.at(gone, np.asarray(covering, np.int64), 1)
                np.add.at(gone, np.asarray(covering, np.int64) + run, -1)
            kept = b" ".join([word for word, g in zip(words, np.cumsum(gone[:-1]).tolist()) if not g])
            n_removed = int(np.count_nonzero(np.cumsum(gone[:-1])))
            out.append((len(words), n_removed, hashlib.sha256(kept).hexdigest(), kept.decode() if texts_too else None))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept"])

    return work


def without_repeats(
    df: DataFrame, text: str = "text", key: str = "doc_id", run: int = RUN, texts_too: bool = True, shard: int = SHARD, crowd: int = CROWD
) -> DataFrame:
    r"""``key``, ``n_words``, ``n_removed``, ``kept_sha256`` and (with ``texts_too``) ``kept`` of each row.

    Words are ``[^\x20\x09-\x0D]+`` of the whole text; null is empty. A word goes if it lies in a run
    of ``run`` words that a row with a smaller key has too, judged on the input. Rows with one
    key do not remove each other's words, and a row without a key (or with the smallest of all
    longs) neither removes nor loses any. Repeated rows come out as often as they go in; an empty
    table gives an empty one.
    """
    if run <= GRAM:
        raise ValueError(f"run must be over {GRAM}")
    small_batches(df.sparkSession)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    docs = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("doc"), raw.alias("raw"))
    docs = docs.select("doc", "raw", *_text_id(F.col("raw")))
    texts = docs.select("doc", "t1", F.pandas_udf(packed, "binary")("raw").alias("packed"))
    covered = located(docs, texts, run, shard, crowd)
    ids = docs.select("doc", "t1", "t2").where(F.col("doc") != NO_KEY)
    first = ids.groupBy("t1", "t2").agg(F.min("doc").alias("first"))
    copies = ids.join(first, ["t1", "t2"]).groupBy("doc", "t1").agg(F.max(F.col("first") < F.col("doc")).alias("copied"))
    facts = copies.join(covered, ["doc", "t1"], "left").where("copied or covering is not null")
    rows = texts.join(facts, ["doc", "t1"], "left").withColumn("copied", F.coalesce("copied", F.lit(False)))
    kinds = "n_words long, n_removed long, kept_sha256 string, kept string"
    clean = F.pandas_udf(lambda packed, copied, covering: _cleaned(run, texts_too)(
        pd.DataFrame({"packed": packed, "copied": copied, "covering": covering})
    ), kinds)
    own_key = F.when(F.col("doc") != NO_KEY, F.col("doc")).cast(df.schema[key].dataType)
    found = rows.select(own_key.alias(key), clean("packed", "copied", "covering").alias("c")).select(key, "c.*")
    return found if texts_too else found.drop("kept")
