"""Records that span lines, read by as many tasks as a file has splits.

A split may begin within a record: whether it does follows from what stands before it, which is one number for each
split. For CSV that is the number of quotes (an odd one leaves a value open, as a quote inside a value is doubled), for
JSON the number of brackets that are open (a line never begins within a text, whose line breaks are written
``\\n``). A first pass adds these numbers up by split, and their sums over the splits of a file say how each one
begins. A second pass cuts the records out of each split. What is left at a split's ends are pieces of
records, two of a split at most, which are put together in the order of the splits.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, ship_package

#: What a piece is: a whole record, or where one begins, goes on, or ends.
WHOLE, BEGINS, GOES_ON, ENDS = range(4)
PIECES = "file string, block long, kind int, record string"
_TOKENS = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}]')


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files, each with its file, the place of its split, and its place there."""
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select("*", "_metadata")
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))


def _with_start(lines: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Lines with ``before``, the sum of ``n`` over all splits of the file before theirs, in the order of each split.

    With ``firsts``, a 0 or 1 for each file as ``base``, that goes with the sum: twice the sum and the base.
    """
    splits = lines.groupBy("file", "block").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    if firsts is not None:
        splits = splits.join(firsts, "file").select("file", "block", (F.col("before") * 2 + F.col("base")).alias("before"))
    splits = materialize(splits, "splits")
    found = lines.join(splits, ["file", "block"]).sortWithinPartitions("file", "block", "place")
    return found.select("file", "block", "before", "value")


Feed = Callable[[str | None], Iterator[tuple[int, str]]]


def _cut(cutter: Callable[[int, bool], Feed]):
    """The pieces of each split. What ``cutter(before, first)`` returns takes its lines one by one, and None at its end."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, feed = None, None
        for batch in batches:
            out: list[tuple] = []
            for file, block, before, value in zip(*(column.to_pylist() for column in batch.columns)):
                if at != (file, block):
                    if feed:
                        out += [(*at, *piece) for piece in feed(None)]
                    at, feed = (file, block), cutter(before, block == 0)
                out += [(*at, *piece) for piece in feed(value)]
            yield _batch(out)
        if feed:
            yield _batch([(*at, *piece) for piece in feed(None)])

    return work


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], ["file", "block", "kind", "record"])


def _put_together(pieces: DataFrame, between: str) -> DataFrame:
    """The records of all splits: whole ones as they are, others joined by ``between``."""
    parts = materialize(pieces.where(F.col("kind") != WHOLE), "record-pieces")
    # A record's end stands at the head of its split, and where another begins at the foot.
    order = F.struct("block", (F.col("kind") == BEGINS).alias("last"))
    number = F.sum((F.col("kind") == BEGINS).cast("int")).over(Window.partitionBy("file").orderBy(order))
    numbered = parts.withColumn("number", number).groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "record"))).alias("parts"))
    joined = numbered.select(F.array_join(F.transform("parts", lambda part: part["record"]), between).alias("record"))
    return pieces.where(F.col("kind") == WHOLE).select("record").unionByName(joined)


def _csv_cutter(before: int, first: bool) -> Feed:
    held: list[str] = []
    state = {"open": before % 2 == 1, "carried": before % 2 == 1, "header": first}

    def feed(line: str | None) -> Iterator[tuple[int, str]]:
        if line is None:
            if held:
                yield (GOES_ON if state["carried"] else BEGINS), "\n".join(held)
            return
        held.append(line)
        state["open"] ^= line.count('"') % 2 == 1
        if not state["open"]:
            record = "\n".join(held)
            held.clear()
            if state["header"]:
                state["header"] = False
            elif state["carried"] or record.strip():
                yield (ENDS if state["carried"] else WHOLE), record.removesuffix("\r")
            state["carried"] = False

    return feed


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files with a header, in the column ``record``; their quoted values may have line breaks.

    A header is in one split. Blank records are left out; the last record of a file may lack its closing quote.
    """
    lines = _lines(spark, path).withColumn("n", F.regexp_count("value", F.lit('"')))
    return _put_together(_with_start(lines).mapInArrow(_cut(_csv_cutter), PIECES), "\n")


def _json_cutter(before: int, first: bool) -> Feed:
    # The outermost brackets are those of an array of records, or of a record by itself: that shows at the first one.
    depth, base = before // 2, before % 2
    held: list[str] = []
    state = {"depth": depth, "carried": depth > base, "inside": depth > base}

    def feed(line: str | None) -> Iterator[tuple[int, str]]:
        if line is None:
            if state["inside"] and held:
                yield (GOES_ON if state["carried"] else BEGINS), "".join(held)
            return
        begin = 0
        for token in _TOKENS.finditer(line):
            sign = token[0]
            if sign in "{[":
                state["depth"] += 1
                if not state["inside"] and state["depth"] == base + 1 and sign == "{":
                    state["inside"], begin = True, token.start()
            elif sign in "}]":
                state["depth"] -= 1
                if state["inside"] and state["depth"] == base:
                    held.append(line[begin : token.end()])
                    yield (ENDS if state["carried"] else WHOLE), "".join(held)
                    held.clear()
                    state["inside"] = state["carried"] = False
        if state["inside"]:
            held.append(line[begin:] + "\n")

    return feed


def _opened(value: str) -> int:
    return sum(1 if token[0] in "{[" else -1 for token in _TOKENS.finditer(value) if token[0][0] != '"')


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of JSON files, in the column ``record``: the objects of an array, or objects one after the other."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.array([_opened(value) for value in batch.column("value").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sums], [*batch.schema.names, "n"])

    lines = _lines(spark, path).mapInArrow(opened, "value string, file string, block long, place long, n long")
    # Whether a file has an array of records, which its first sign says, goes with the number of open brackets.
    firsts = lines.where(F.trim("value") != "").groupBy("file").agg(F.min_by(F.substring(F.trim("value"), 1, 1), F.struct("block", "place")).alias("sign"))
    firsts = materialize(firsts.select("file", (F.col("sign") == "[").cast("long").alias("base")), "json-files")
    return _put_together(_with_start(lines, firsts).mapInArrow(_cut(_json_cutter), PIECES), "")
