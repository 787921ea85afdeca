"""Tables kept as parquet: replaced version by version, or appended to.

A versioned table is a folder with its data in ``data/<write>/<slice>`` and a small file for each
version in ``versions``: layout, schema, row count, and the folder of every slice. That file is
written last, and only if no other writer has taken its number; so readers see the last complete
version, a failed write is never seen, and of two writers at once the second one is refused.

A table sliced by a column (or an expression) takes over, from version to version, the folders of
the slices that an upsert leaves alone. An increment then costs its own slices, and not the whole table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import storage
from ..functions.casting import parse_keys
from ..session import COMPRESSION, materialize_at, observed, scratch_path
from .upsert import aligned, assert_unique, match, upsert

SLICE = "upsert_slice"
WHOLE = "all"
#: Versions that stay readable after a commit.
KEPT_VERSIONS = 3
#: Slices a table may have: each is a folder, and a line in the version's file.
MOST_SLICES = 100_000
#: Rows that come straight from files are written to their slices by the tasks that read them, if files get so many bytes on average.
LEAST_FILE_BYTES = 1 << 20
_APPENDING = Lock()


class ConcurrentWrite(RuntimeError):
    """Another writer has committed a version of the table meanwhile."""


@dataclass(frozen=True)
class Version:
    """A version of a table; ``slices`` has the folder of each slice, from the table's own."""

    number: int
    slice_by: str | None
    schema: StructType
    slices: dict[str, str]
    n_rows: int

    def read(self, spark: SparkSession, path: str, only: Sequence[str] | None = None) -> DataFrame:
        """The rows of all slices, or of some."""
        folders = [f"{path}/{folder}" for name, folder in self.slices.items() if only is None or name in only]
        return spark.read.schema(self.schema).parquet(*folders) if folders else spark.createDataFrame([], self.schema)


def target_name(table: str) -> str:
    """``<t>_history`` is loaded into ``<t>``."""
    return table.removesuffix("_history")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(name.removesuffix(".json")) for name in storage.names(spark, f"{path}/versions") if name.endswith(".json")]


def _version(spark: SparkSession, path: str, number: int) -> Version | None:
    try:
        found = json.loads(storage.read_text(spark, f"{path}/versions/{number:08d}.json"))
    except ValueError:  # its writer died over it
        return None
    return Version(number, found["slice_by"], StructType.fromJson(found["schema"]), found["slices"], found["n_rows"])


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The last complete version of a table."""
    for number in reversed(_numbers(spark, path)):
        found = _version(spark, path, number)
        if found:
            return found
    return None


def latest_version(spark: SparkSession, path: str) -> int | None:
    found = current_version(spark, path)
    return found.number if found else None


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The current state of a table, or ``None`` when nothing has been written."""
    found = current_version(spark, path)
    return found.read(spark, path) if found else None


def _commit(spark: SparkSession, path: str, base: int, slice_by: str | None, schema: StructType, slices: dict[str, str], n_rows: int) -> None:
    """Make a version visible, as the one after ``base``, the last that its writer has seen."""
    if len(slices) > MOST_SLICES:
        raise ValueError(f"{slice_by} has {len(slices)} values; a table is sliced by at most {MOST_SLICES}")
    text = json.dumps({"slice_by": slice_by, "n_rows": n_rows, "slices": slices, "schema": json.loads(schema.json())})
    try:
        storage.create_text(spark, f"{path}/versions/{base + 1:08d}.json", text)
    except storage.AlreadyThere:
        raise ConcurrentWrite(f"version {base + 1} of {path} is another writer's") from None
    drop_old_versions(spark, path, KEPT_VERSIONS)


def _last_number(spark: SparkSession, path: str) -> int:
    return max(_numbers(spark, path), default=0)


def _slice_name(slice_by: str | None) -> Column:
    """Slice of a row: a hash of its whole value, so that it is safe in a path and unlike values differ."""
    return F.lit(WHOLE) if slice_by is None else _name_of(F.expr(slice_by))


def _name_of(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("null")).otherwise(F.concat(F.lit("h"), F.md5(value)))


def _slices_in_place(df: DataFrame, slice_by: str) -> bool:
    """Whether tasks can write the slices of the rows that they read, without many small files."""
    size = storage.estimated_bytes(df)
    if size < LEAST_FILE_BYTES or not storage.reads_in_order(df):
        return False
    files = df.select(F.spark_partition_id().alias("task"), F.expr(slice_by).alias("slice")).distinct().count()
    return files * LEAST_FILE_BYTES <= size


def _write(df: DataFrame, path: str, slice_by: str | None) -> tuple[dict[str, str], int]:
    """Write rows to a new folder; the slices in it, and how many rows there are.

    Big slices are split among tasks, small ones put together. Only rows that come straight from files stay where they are
    read, if a task's part of a slice makes a file that is large enough.
    """
    folder = f"data/{uuid.uuid4().hex}"
    if slice_by is None:
        df, seen = observed(df)
        df.write.option("compression", COMPRESSION).parquet(f"{path}/{folder}/{SLICE}={WHOLE}")
    else:
        # What is moved is the value, as the name is long.
        spread = df.withColumn("_slice", F.expr(slice_by))
        if not _slices_in_place(df, slice_by):
            spread = spread.hint("rebalance", "_slice")
        named = spread.withColumn(SLICE, _name_of(F.col("_slice"))).drop("_slice")
        named, seen = observed(named)
        named.write.option("compression", COMPRESSION).partitionBy(SLICE).parquet(f"{path}/{folder}")
    found = [name for name in storage.names(df.sparkSession, f"{path}/{folder}") if name.startswith(f"{SLICE}=")]
    slices = {name.split("=", 1)[1]: f"{folder}/{name}" for name in found}
    # Counted while written: to open the files of many slices again takes longer.
    return slices, seen.get["n_rows"]


def write_version(df: DataFrame, path: str, slice_by: str | None = None) -> int:
    """Write ``df`` as the next version, in place of all rows; readers keep the old one until it is complete."""
    spark = df.sparkSession
    base = _last_number(spark, path)
    slices, n_rows = _write(df, path, slice_by)
    _commit(spark, path, base, slice_by, df.schema, slices, n_rows)
    return base + 1


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all versions but the last ``keep`` complete ones, and the data that only they had."""
    numbers = _numbers(spark, path)
    complete = [v for v in (_version(spark, path, n) for n in numbers) if v]
    old, kept = complete[:-keep], complete[-keep:]
    needed = {folder for version in kept for folder in version.slices.values()}
    for version in old:
        storage.delete(spark, f"{path}/versions/{version.number:08d}.json")
    for folder in {folder for version in old for folder in version.slices.values()} - needed:
        storage.delete(spark, f"{path}/{folder}")
        above = folder.rsplit("/", 1)[0]
        if not any(name.startswith(f"{SLICE}=") for name in storage.names(spark, f"{path}/{above}")):
            storage.delete(spark, f"{path}/{above}")


def _names(places: list[DataFrame]) -> list[str]:
    """The slices that rows are in: as many names as are read, and so fewer than the version's file has."""
    return [row["s"] for row in reduce(lambda a, b: a.union(b), places).distinct().limit(MOST_SLICES + 1).collect()]


def _comparable(schema: StructType, names: Sequence[str]) -> bool:
    return not any("map<" in schema[name].dataType.simpleString() or schema[name].dataType.typeName() == "variant" for name in names)


def changed_rows(
    source: DataFrame, target: DataFrame, keys: list[str], order: list[str | Column], taken: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows of ``source`` that change ``target``: not older than what it has by ``order``, and not equal.

    ``taken`` are columns to be made of the target's row, null for a new key. Each side is moved once.
    """
    supplied, taken = source.columns, taken or {}
    compared = [name for name in supplied if name not in keys] if _comparable(target.schema, supplied) else None
    stored = [F.col(k).alias(f"_key_{k}") for k in keys] + [F.lit(True).alias("_known")]
    stored += [F.col(name).alias(f"_old_{name}") for name in compared or []] + [column.alias(name) for name, column in taken.items()]
    if order:
        stored.append(F.struct(*order).alias("_order"))
    found = source.join(storage.kept_back(target.select(stored)), match(keys), "left")
    change = F.lit(True)
    if compared is not None:
        same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_old_{name}")) for name in compared], F.lit(True))
        change = F.col("_known").isNull() | ~same
    if order:
        change &= F.col("_known").isNull() | (F.struct(*order) >= F.col("_order"))
    return found.where(change).select(*supplied, *taken)


def merged_rows(
    source: DataFrame, target: DataFrame, keys: list[str], order: list[str | Column], taken: Mapping[str, Column] | None = None
) -> DataFrame:
    """All rows of ``target`` with those of ``source`` put in that change it, as ``changed_rows`` finds them, and ``_change``.

    For a source that is not small: both sides are moved once, for the comparison and for the new state. ``taken`` is as there.
    """
    supplied, taken = source.columns, taken or {}
    compared = [name for name in supplied if name not in keys] if _comparable(target.schema, supplied) else None
    stored = [F.col(k).alias(f"_key_{k}") for k in keys] + [F.lit(True).alias("_known")]
    stored += [F.col(name).alias(f"_old_{name}") for name in target.columns if name not in keys]
    stored += [column.alias(name) for name, column in taken.items()]
    change = F.col("_here").isNotNull()
    unknown = F.col("_known").isNull()
    if compared is not None:
        same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_old_{name}")) for name in compared], F.lit(True))
        change &= unknown | ~same
    if order:
        stored.append(F.struct(*order).alias("_order"))
        change &= unknown | (F.struct(*order) >= F.col("_order"))
    both = source.withColumn("_here", F.lit(True)).join(target.select(stored), match(keys), "full")
    both = both.withColumn("_change", F.coalesce(change, F.lit(False)))

    def value(name: str) -> Column:
        if name in keys:
            return F.when(F.col("_here"), F.col(name)).otherwise(F.col(f"_key_{name}"))
        old = F.col(f"_old_{name}")
        return F.when(F.col("_change"), F.col(name)).otherwise(old) if name in supplied else old

    return both.select(*[value(name).alias(name) for name in target.columns], "_change", *taken)


def upsert_path(source: DataFrame, path: str, keys: str | list[str], slice_by: str | None = None, **how) -> DataFrame:
    """``upsert_into``, and the table's new state."""
    upsert_into(source, path, keys, slice_by, **how)
    return read_table(source.sparkSession, path)


def upsert_into(
    source: DataFrame,
    path: str,
    keys: str | list[str],
    slice_by: str | None = None,
    order: str | list[str] | None = None,
    replacing: DataFrame | None = None,
    slices_fixed: bool = False,
    written: bool = False,
    unique: bool = False,
    surrogate: str | None = None,
    number: Callable[[DataFrame, int], DataFrame] | None = None,
) -> None:
    """Upsert ``source`` into the table at ``path``. To read a table of many slices lists as many folders, so it is read once.

    ``slice_by`` is a column of the table, or an expression of its columns. Then only the slices with
    rows that change are rewritten, and rows whose slice changes leave the old one: their keys are
    looked up in the whole table, of which that reads the key columns. ``slices_fixed`` leaves that out
    for a column that never changes for a key, such as a creation date. Of slices without a key of
    ``source`` no other column is read. An increment of half the table's rows or more looks none up, and
    reads all slices. A table that has another layout is rewritten in the new one.

    With ``order``, a row only replaces one that is not later in the order of these columns.
    ``replacing`` has values of some columns: stored rows with these that ``source`` has no key of go.
    Columns that the table lacks are refused. Nothing is written if nothing changes.

    ``written`` says that ``source`` reads files that stay as they are meanwhile, so that it is not written
    aside, and ``unique`` that its keys have been seen to be unique. Rows with a new key get their ``surrogate``, which
    ``source`` lacks, by ``number(rows, first)``, which must refuse a key that is there twice; known keys keep theirs.

    One writer at a time: a second one raises ``ConcurrentWrite`` and can be run again.
    """
    spark = source.sparkSession
    keys = parse_keys(keys)
    order = [order] if isinstance(order, str) else list(order or [])
    base, current = _last_number(spark, path), current_version(spark, path)
    aside = scratch_path(spark, "upsert")
    try:
        if current is None:
            landed = source if written else materialize_at(source, f"{aside}/source")
            if number:
                landed = number(landed, 1)
            elif not unique:
                assert_unique(landed, keys)
            slices, n_rows = _write(landed, path, slice_by)
            _commit(spark, path, base, slice_by, landed.schema, slices, n_rows)
            return

        table = current.read(spark, path)
        landed = aligned(source, table.schema)
        if not written:
            landed = materialize_at(landed, f"{aside}/source")
        n_landed = landed.count()
        if not n_landed and replacing is None:
            return
        if not unique:
            assert_unique(landed, keys)
        known = landed.select([F.col(k).alias(f"_key_{k}") for k in keys])
        sliced = slice_by is not None and slice_by == current.slice_by
        near = table
        if sliced and n_landed * 2 < current.n_rows:
            # Which slices have the keys: of the others not a row is read.
            names = _names([landed.select(_slice_name(slice_by).alias("s"))])
            near = current.read(spark, path, names)
            # Where the rows' own slices have most of the table, the others are read with them and no key is looked up.
            if not slices_fixed and near.count() * 2 >= current.n_rows:
                near = table
            elif not slices_fixed:
                places = table.withColumn("s", _slice_name(slice_by)).join(storage.kept_back(known, lambda: n_landed), match(keys), "left_semi").select("s")
                near = current.read(spark, path, sorted({*names, *_names([places])}))
        if near is table and replacing is None and not storage.fits_broadcast(landed, lambda: n_landed):
            _merge_whole(landed, path, keys, slice_by, order, surrogate, number, base, current, aside)
            return
        taken = {"_found": F.lit(True)} | ({"_from": F.struct(F.expr(slice_by).alias("at"))} if sliced else {})
        if surrogate:
            taken[surrogate] = F.col(surrogate)
        found = materialize_at(changed_rows(landed, near, keys, order, taken), f"{aside}/changes")
        replaced, changes = found.where("_found").select(keys), found.drop("_found", "_from")
        if surrogate:
            added = changes.where(F.col(surrogate).isNull()).drop(surrogate)
            if not added.isEmpty():
                last = table.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
                changes = changes.where(F.col(surrogate).isNotNull()).unionByName(number(added, last + 1))
        gone = None
        if replacing is not None:
            values = replacing.select([F.col(c).alias(f"_key_{c}") for c in replacing.columns])
            affected = table.join(storage.kept_back(values), match(replacing.columns), "left_semi")
            gone = materialize_at(affected.join(storage.kept_back(known, lambda: n_landed), match(keys), "left_anti"), f"{aside}/gone")
        if changes.isEmpty() and (gone is None or gone.isEmpty()):
            return

        def merged(rows: DataFrame) -> DataFrame:
            if gone is not None:
                rows = rows.join(storage.kept_back(gone.select([F.col(k).alias(f"_key_{k}") for k in keys])), match(keys), "left_anti")
            return rows.unionByName(changes, allowMissingColumns=True) if only_new else upsert(rows, changes, keys)

        only_new = replaced.isEmpty()
        if not sliced:
            slices, n_rows = _write(merged(table), path, slice_by)
        else:
            # Where changed rows go, and where they were.
            touched = [changes, *([] if gone is None else [gone])]
            places = [rows.select(_slice_name(slice_by).alias("s")) for rows in touched]
            names = _names([*places, found.where("_from IS NOT NULL").select(_name_of(F.col("_from")["at"]).alias("s"))])
            whole = set(names) >= set(current.slices)
            part = table if whole else current.read(spark, path, names)
            added, n_added = _write(merged(part), path, slice_by)
            slices = {name: folder for name, folder in current.slices.items() if name not in names} | added
            n_rows = current.n_rows - (current.n_rows if whole else part.count()) + n_added
        _commit(spark, path, base, slice_by, current.schema, slices, n_rows)
    finally:
        storage.delete(spark, aside)


def _merge_whole(
    landed: DataFrame, path: str, keys: list[str], slice_by: str | None, order: list[str | Column], surrogate: str | None,
    number: Callable[[DataFrame, int], DataFrame] | None, base: int, current: Version, aside: str,
) -> None:
    """``upsert_into`` for many rows: they are compared and put in by one join, whose result is written before it is sliced."""
    spark = landed.sparkSession
    table = current.read(spark, path)
    sliced = slice_by is not None and slice_by == current.slice_by
    was = {"_from": F.struct(F.expr(slice_by).alias("at"))} if sliced else {}
    added = F.col("_change") & F.col("_from").isNull() if sliced else F.lit(False)
    state, seen = observed(merged_rows(landed, table, keys, order, was), changed=F.count_if("_change"), added=F.count_if(added))
    state = materialize_at(state, f"{aside}/merged")
    if not seen.get["changed"]:
        return
    rows, names = state.drop("_change", *was), []
    if sliced:
        moved = state.where("_change")
        # Where changed rows go, and where they were.
        old = moved.where("_from IS NOT NULL").select(_name_of(F.col("_from")["at"]).alias("s"))
        names = _names([moved.select(_slice_name(slice_by).alias("s")), old])
        if not set(names) >= set(current.slices):
            rows = rows.where(_slice_name(slice_by).isin(names))
    if surrogate:
        new = rows.where(F.col(surrogate).isNull()).drop(surrogate)
        if not new.isEmpty():
            last = table.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
            rows = rows.where(F.col(surrogate).isNotNull()).unionByName(number(new, last + 1))
    slices, n_rows = _write(rows, path, slice_by)
    if sliced:
        slices = {name: folder for name, folder in current.slices.items() if name not in names} | slices
        n_rows = current.n_rows + seen.get["added"]
    _commit(spark, path, base, slice_by, current.schema, slices, n_rows)


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, created empty if it is absent."""
    if not storage.exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows to the table at ``path``. Writers of one session take turns, as the file
    committer does not keep apart two jobs that append to the same folder."""
    with _APPENDING:
        df.write.mode("append").parquet(path)
