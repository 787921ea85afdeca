"""Document fingerprints by invertible Bloom lookup sketches, with DataFrame functions only.

A sketch has three tables of cells. Each paragraph's digest falls on one cell of each table; a cell
has the number of its digests, their exclusive or, and that of their check hashes. Cells of two
versions are subtracted, which leaves the digests that only one of them has. Where a cell is left
with one digest it is read off and taken out of its other cells, table after table (peeling),
until no cell is left. What does not peel is done again with larger tables.

Sketches are rows, one for each cell that is not empty. Documents are dealt into ranges of their
ids once; subtracting and peeling group by range first, so no step after that shuffles anything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Where paragraphs end: line breaks, and sentence ends before white space.
PARAGRAPH_END = r"\n+|(?<=[.!?])\s+"
#: Cells of a table for each paragraph of the versions compared, and at least.
CELLS_PER_PARAGRAPH = 4
LEAST_CELLS = 4096
#: Cells of a table of the folded sketch that a print is taken of, at least.
LEAST_PRINT = 16
TABLES = 3
#: Rounds over all tables before a sketch counts as failed, and growth of the tables then.
ROUNDS = 2
LARGER = 8
#: Bytes of text in a range of ids, and ranges at most (the driver has their bounds).
RANGE_BYTES = 1_000_000
RANGES = 100_000

_PLACE = ["range", "place"]
_DOC = [*_PLACE, "key"]
#: The pair of rows that carry a document's numbers along with its cells.
_FACTS = -10
_SIZES = ["n0", "n1"]


def paragraph_digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    kept = F.filter(F.split(text, PARAGRAPH_END), lambda p: p != "")
    return F.array_distinct(F.transform(kept, lambda p: F.xxhash64(p)))


def _range_of(key: Column, bounds: list) -> Column:
    """How many of the sorted bounds are at most ``key``, by halving; 0 for null."""
    if not bounds:
        return F.lit(0)
    all_bounds = F.array(*[F.lit(b) for b in bounds])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: at + F.when(F.get(all_bounds, at + s - 1) <= key, s).otherwise(F.lit(0)),
    )


def with_next(df: DataFrame, key: str, text: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``key``, ``text``, ``next`` (the text of the next row in descending order of the key, after the
    last the first), and ``range`` and ``place``, which name a row.

    Equal keys are ordered by their texts' hashes; nulls come last. The rows are partitioned by
    ``range``. Texts are shuffled once; besides them, one text for each range.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0]
    n = min(RANGES, max(1, -(-(size or 0) // range_bytes)))
    bounds = []
    if n > 1:
        shares = [i / n for i in range(1, n)]
        found = rows.agg(F.percentile_approx("key", F.array(*[F.lit(s) for s in shares]), 20 * n)).first()[0]
        bounds = sorted(set(found or []))
    rows = rows.withColumn("range", F.coalesce(_range_of(F.col("key"), bounds), F.lit(0)))
    order = F.struct(F.col("key").isNotNull().alias("k"), F.coalesce("key", F.lit(0)).alias("key"), "tie")
    heads = rows.groupBy("range").agg(F.max(order).alias("o")).orderBy(F.desc("range")).collect()
    # One row per range goes through the driver: the range before it, and which row is its first.
    before = [(heads[i - 1]["range"], head["range"], head["o"]["key"] if head["o"]["k"] else None, head["o"]["tie"]) for i, head in enumerate(heads)]
    spark = df.sparkSession
    kinds = f"into int, range int, key {df.schema[key].dataType.simpleString()}, tie long"
    wanted = spark.createDataFrame(before, kinds)
    same = (rows["key"].eqNullSafe(wanted["key"])) & (rows["tie"] == wanted["tie"]) & (rows["range"] == wanted["range"])
    guests = rows.join(F.broadcast(wanted), same).select(F.coalesce(wanted["into"], F.lit(0)).alias("range"), rows["key"], "text", rows["tie"], F.lit(True).alias("guest"))
    guests = guests.dropDuplicates(["range"])
    every = rows.withColumn("guest", F.lit(False)).unionByName(guests).repartition(max(1, n // 2), "range")
    w = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("key"), F.desc("tie"))
    found = every.withColumn("next", F.lead("text").over(w)).withColumn("place", F.row_number().over(w))
    return found.where("not guest").select("text", "next", *_DOC)


def _cell(digest: Column, table: int, seed: int, cells: Column) -> Column:
    return F.xxhash64(F.lit(seed * TABLES + table), digest).bitwiseAND(cells - 1) * TABLES + table


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def _power_of_two(x: Column, least: int) -> Column:
    return F.greatest(F.lit(least).cast("long"), F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(x, F.lit(1))))).cast("long"))


def _sum_cells(rows: DataFrame, *on: str) -> DataFrame:
    sums = [F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check")]
    return rows.groupBy(*_DOC, "cells", *_SIZES, *on, "cell").agg(*sums)


def sketches(versions: DataFrame, seed: int = 0, scale: int = 1, least: int = LEAST_CELLS) -> DataFrame:
    """The cells ``(n, digest, check)`` of each version of each row.

    ``versions`` has ``range``, ``place``, ``key``, ``versions``, an array of arrays of digests, and ``facts``,
    an array of numbers. All versions of a row get tables of one size, enough for all paragraphs of any
    two. ``n0`` and ``n1`` are the numbers of paragraphs of the first two versions. The facts become rows
    of the version after the last, at the cells -10, -11 and so on, and stay as they are from step to
    step: so nothing has to be joined to the cells in the end.
    """
    sizes, facts = F.transform("versions", lambda v: F.size(v)), F.size("versions")
    most = F.get(sizes, F.lit(0)) + F.array_max(F.slice(sizes, 2, 1 << 20))
    cells = _power_of_two(most * CELLS_PER_PARAGRAPH * scale, max(least, LEAST_PRINT) * scale)
    rows = versions.select(*_DOC, cells.alias("cells"), *[F.get(sizes, F.lit(i)).alias(f"n{i}") for i in range(2)], facts.alias("facts"), F.posexplode(F.concat("versions", F.array("facts"))).alias("version", "digests"))
    rows = rows.select(*_DOC, "cells", *_SIZES, F.when(F.col("version") < F.col("facts"), F.col("version")).otherwise(_FACTS).alias("version"), F.posexplode("digests").alias("at", "digest"))
    places = F.array(*[_cell(F.col("digest"), i, seed, F.col("cells")) for i in range(TABLES)])
    places = F.when(F.col("version") >= 0, places).otherwise(F.array((_FACTS - F.col("at")).cast("long")))
    rows = rows.select(*_DOC, "cells", *_SIZES, "version", "digest", F.explode(places).alias("cell"))
    rows = rows.withColumns({"n": F.lit(1).cast("long"), "check": _check(F.col("digest"))})
    return _sum_cells(rows, "version")


def subtracted(cells: DataFrame, pairs: int = 2, printed: int = len(_SIZES)) -> DataFrame:
    """The cells of version 0 less those of each other version; ``pair`` is the other one.

    The pairs -1, -2 ... are the prints of versions 0, 1 ...: hashes of a version's cells, folded to
    tables whose size depends on the version alone, so that equal texts have equal prints.
    """
    version, cell = F.col("version"), F.col("cell")

    def side(pair: Column, sign: int, place: Column) -> Column:
        return F.struct(pair.cast("int").alias("pair"), F.lit(sign).cast("long").alias("sign"), place.alias("cell"))

    own = F.lit(0)
    for i in range(printed):
        own = F.when(version == i, F.col(f"n{i}")).otherwise(own)
    own = _power_of_two(own * CELLS_PER_PARAGRAPH, LEAST_PRINT)
    fold = side(-version - 1, 1, F.floor(cell / TABLES).bitwiseAND(own - 1) * TABLES + cell % TABLES)
    lists = F.when(version == _FACTS, F.array(side(version, 1, cell)))
    lists = lists.when(version == 0, F.array(*[side(F.lit(i), 1, cell) for i in range(1, pairs + 1)], fold))
    lists = lists.when(version < printed, F.array(side(version, -1, cell), fold)).otherwise(F.array(side(version, -1, cell)))
    rows = cells.withColumn("side", F.explode(lists)).select(
        *_DOC, "cells", *_SIZES, "side.cell", "side.pair", (F.col("n") * F.col("side.sign")).alias("n"), "digest", "check"
    )
    rows = _sum_cells(rows, "pair").where("n <> 0 or digest <> 0 or check <> 0")
    is_print = (F.col("pair") < 0) & (F.col("pair") != _FACTS)
    halves = [F.xxhash64(F.lit(i), "cell", "n", "digest", "check") for i in range(2)]
    return rows.select(
        *_DOC, "cells", *_SIZES, "pair", F.when(is_print, F.lit(-1).cast("long")).otherwise(cell).alias("cell"),
        F.when(is_print, F.lit(0).cast("long")).otherwise(F.col("n")).alias("n"),
        F.when(is_print, halves[0]).otherwise(F.col("digest")).alias("digest"),
        F.when(is_print, halves[1]).otherwise(F.col("check")).alias("check"),
    )


def peeled(cells: DataFrame, seed: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """A row per document: how many digests each pair's cells give back (``d1``, ``d2``), how many
    cells stay (``s1``, ``s2``), the prints (``p1``, ``p2``), and the facts (``f0`` ... ``f7``).

    Each step reads the cells of one table, where a digest stands once at most, so no digest is
    read twice. Digests that were read are counted in the cell -1.
    """
    zero = F.lit(0).cast("long")
    for step in range(rounds * TABLES):
        table = step % TABLES
        alone = (F.col("cell") >= 0) & (F.col("cell") % TABLES == table) & (F.abs("n") == 1) & (F.col("check") == _check(F.col("digest")))

        def to(cell: Column, n: Column) -> Column:
            return F.struct(cell.cast("long").alias("cell"), n.alias("n"), F.col("digest"), F.col("check"))

        out = [to(_cell(F.col("digest"), i, seed, F.col("cells")), -F.col("n")) for i in range(TABLES) if i != table]
        read = F.struct(F.lit(-1).cast("long").alias("cell"), F.lit(1).cast("long").alias("n"), zero.alias("digest"), zero.alias("check"))
        moves = F.when(alone, F.array(*out, read)).otherwise(F.array(to(F.col("cell"), F.col("n"))))
        moved = cells.select(*_DOC, "cells", *_SIZES, "pair", F.explode(moves).alias("m")).select(*_DOC, "cells", *_SIZES, "pair", "m.*")
        cells = _sum_cells(moved, "pair").where("n <> 0 or digest <> 0 or check <> 0")
    pair, settled = F.col("pair"), F.col("cell") < 0
    text = F.lower(F.concat(F.lpad(F.hex("digest"), 16, "0"), F.lpad(F.hex("check"), 16, "0")))
    found = [F.coalesce(F.sum(F.when((pair == i) & settled, F.col("n"))), zero).alias(f"d{i}") for i in (1, 2)]
    found += [F.count(F.when((pair == i) & ~settled, 1)).alias(f"s{i}") for i in (1, 2)]
    found += [F.max(F.when(pair == -i, text)).alias(f"p{i}") for i in (1, 2)]
    found += [F.max(F.when((pair == _FACTS) & (F.col("cell") == _FACTS - i), F.col("digest"))).alias(f"f{i}") for i in range(8)]
    return cells.groupBy(*_DOC).agg(*found)


def _likeness(a: Column, b: Column, differing: Column) -> Column:
    """The share of all paragraphs of two versions that both have; 1 if neither has any."""
    return F.when(a + b == 0, F.lit(1.0)).otherwise((a + b - differing) / (a + b + differing))


def fingerprinted(df: DataFrame, key: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES, least: int = LEAST_CELLS) -> DataFrame:
    """Fingerprints of whole texts, and how alike they are to an edited version and to the next text.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as many (or
    all) of the next text in descending order of ``key``; after the last row comes the first. A null
    text counts as empty; a row alone is its own next. Equal keys are ordered by their texts'
    hashes, a null key comes last. Repeated rows come out as often as they go in, and an empty
    table gives an empty one. Texts without a paragraph have the fingerprint of no cells.
    """
    def rows() -> DataFrame:
        found = with_next(df, key, text, range_bytes)
        length = F.char_length("text").cast("long")
        half = F.floor(length / 2).cast("int")
        edited = F.concat(F.substring(F.col("text"), F.lit(1), (length - half).cast("int")), F.substring(F.col("next"), F.lit(1), half))
        found = found.withColumns({"n_chars": length, "edited": edited})
        digests = F.array(*[paragraph_digests(F.col(name)) for name in ("text", "edited", "next")])
        found = found.select(*_DOC, "n_chars", F.sha2("edited", 256).alias("sha"), digests.alias("versions"))
        words = [F.conv(F.substring("sha", 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)]
        sizes = [F.size(F.get("versions", F.lit(i))).cast("long") for i in range(3)]
        return found.select(*_DOC, "versions", F.array("n_chars", *words, *sizes).alias("facts"))

    def compared(found: DataFrame, seed: int, scale: int) -> DataFrame:
        return materialize(peeled(subtracted(sketches(found, seed, scale, least)), seed), "fingerprints")

    found, seed, parts = compared(rows(), 0, 1), 0, []
    while True:
        parts.append(found.where("s1 = 0 and s2 = 0"))
        stuck = found.where("s1 > 0 or s2 > 0").select(*_PLACE)
        if not stuck.limit(1).count():
            break
        seed += 1
        found = compared(rows().join(stuck, _PLACE, "left_semi"), seed, LARGER**seed)
    every = reduce(lambda a, b: a.unionByName(b), parts)
    empty = F.lit("0" * 32)
    sha = F.lower(F.concat(*[F.lpad(F.hex(f"f{i}"), 16, "0") for i in range(1, 5)]))
    return every.select(
        F.col("key").alias(key), F.col("f0").alias("n_chars"), sha.alias("edited_sha256"),
        F.coalesce("p1", empty).alias("fingerprint"), F.coalesce("p2", empty).alias("edited_fingerprint"),
        _likeness(F.col("f5"), F.col("f6"), F.col("d1")).alias("near_edited"), _likeness(F.col("f5"), F.col("f7"), F.col("d2")).alias("near_next"),
    )
