"""Upserted tables in buckets of their key, with Spark's own partitioned writes.

The table is a parquet folder partitioned by a hash of the key, whose column says how many buckets there are.
The keys of an increment name the buckets to read, so that five rows cost five buckets and not the
table. Buckets that change are written beside the table, then put in its place by Spark's dynamic
partition overwrite. A run that dies meanwhile leaves its complete copy there, and the next one puts it in place first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.casting import parse_keys
from ..session import materialize_at, scratch_path
from .tables import changed_rows
from .upsert import aligned, assert_unique, dedupe_latest, upsert

PREFIX = "bucket_of_"
#: Bytes of a table for which it gets a bucket, when it is first written, and how many it gets at least and at most.
BUCKET_BYTES = 64 << 20
LEAST_BUCKETS, MOST_BUCKETS = 8, 4096


def _column(spark: SparkSession, path: str) -> str | None:
    """The partition column of the table, if there is one."""
    return next((name.split("=")[0] for name in storage.names(spark, path) if name.startswith(PREFIX)), None)


def _bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def _number_for(rows: DataFrame) -> int:
    """How many buckets rows get that have been written, by their size."""
    wanted = min(MOST_BUCKETS, max(LEAST_BUCKETS, storage.estimated_bytes(rows) // BUCKET_BYTES))
    return 1 << (wanted - 1).bit_length()


def _put_in_place(spark: SparkSession, path: str, column: str) -> None:
    """Replace the buckets that the copy beside the table has."""
    copy = spark.read.parquet(f"{path}.pending")
    copy.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    storage.delete(spark, f"{path}.pending")


def _write(rows: DataFrame, path: str, column: str) -> None:
    rows.hint("rebalance", column).write.partitionBy(column).parquet(f"{path}.pending")
    _put_in_place(rows.sparkSession, path, column)


def finish(spark: SparkSession, path: str) -> None:
    """Put in place what a run that died has written completely, and delete what it has not."""
    if storage.exists(spark, f"{path}.pending/_SUCCESS"):
        _put_in_place(spark, path, _column(spark, f"{path}.pending") or PREFIX)
    elif storage.exists(spark, f"{path}.pending"):
        storage.delete(spark, f"{path}.pending")


def read_buckets(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the table, or ``None`` if it has none."""
    column = _column(spark, path)
    return spark.read.parquet(path).drop(column) if column else None


def buckets_of(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    """The rows in some buckets of the table, of which alone files are read, with their bucket."""
    column = _column(spark, path)
    return spark.read.parquet(path).where(F.col(column).isin(numbers))


def upsert_buckets(
    source: DataFrame, path: str, keys: str | list[str], buckets: int | None = None, order: str | list[str | Column] | None = None,
    written: bool = False, unique: bool = False,
) -> DataFrame | None:
    """Upsert ``source`` into the table at ``path`` and return its new state; ``None`` if it has no row.

    A new table gets so many ``buckets``, or a number by its size; one that is there keeps its own. With ``order``, a row only replaces one
    that is not later in the order of these. Columns that the table lacks are refused, and those
    that ``source`` lacks keep their values. Only buckets with rows that change are written. One writer at a time.
    ``written`` and ``unique`` are as in ``upsert_path``.
    """
    spark = source.sparkSession
    keys = parse_keys(keys)
    order = [order] if isinstance(order, str) else list(order or [])
    finish(spark, path)
    aside = scratch_path(spark, "upsert")
    column = _column(spark, path)
    try:
        if column is None:
            landed = source if written else materialize_at(source, f"{aside}/source")
            if not unique:
                assert_unique(landed, keys)
            if not landed.isEmpty():
                n = buckets or _number_for(landed)
                _write(landed.withColumn(f"{PREFIX}{n}", _bucket(keys, n)), path, f"{PREFIX}{n}")
            return read_buckets(spark, path)

        n = int(column.removeprefix(PREFIX))
        rows = aligned(source, spark.read.parquet(path).drop(column).schema).withColumn(column, _bucket(keys, n))
        landed = rows if written else materialize_at(rows, f"{aside}/source")
        if not unique:
            assert_unique(landed, keys)
        # As many numbers as there are buckets, at most.
        part = buckets_of(spark, path, [row[0] for row in landed.select(column).distinct().collect()])
        changes = materialize_at(changed_rows(landed, part, keys, order), f"{aside}/changes")
        touched = [row[0] for row in changes.select(column).distinct().collect()]
        if touched:
            _write(upsert(buckets_of(spark, path, touched), changes, keys), path, column)
        return read_buckets(spark, path)
    finally:
        storage.delete(spark, aside)


def _rows_in(rows: DataFrame, keys: list[str], n: int) -> dict[int, int]:
    """How many rows each bucket has that has any; as many numbers as there are buckets, at most."""
    return {row[0]: row[1] for row in rows.groupBy(_bucket(keys, n)).count().collect()}


def _latest(rows: DataFrame, keys: list[str], order: list[str | Column], counts: dict[int, int], n: int) -> DataFrame:
    """``dedupe_latest`` of rows that are dealt out by key before they are sorted, as few tasks may read them.

    Only if no bucket, and so no key, has far more rows than others: frequent keys are reduced before rows are moved.
    """
    even = max(counts.values(), default=0) * n <= 2 * sum(counts.values())
    return dedupe_latest(rows.hint("rebalance", *keys) if even else rows, keys, order)


def upsert_latest(source: DataFrame, path: str, keys: str | list[str], buckets: int, order: list[str | Column]) -> None:
    """Upsert rows of which a key may have several: of these and of the table's, the last one by ``order`` stays.

    ``order`` must tell all rows of a key apart that differ. The rows and their buckets meet in one aggregate, instead of being
    reduced, compared and put in one after the other. As in ``upsert_buckets``, only buckets with rows that change are put in
    place, and columns that ``source`` lacks keep their values, for which rows are put in by that.
    """
    spark = source.sparkSession
    keys = parse_keys(keys)
    finish(spark, path)
    column = _column(spark, path)
    if column is None:
        latest = _latest(source, keys, order, _rows_in(source, keys, buckets), buckets)
        _write(latest.withColumn(f"{PREFIX}{buckets}", _bucket(keys, buckets)), path, f"{PREFIX}{buckets}")
        return

    n = int(column.removeprefix(PREFIX))
    schema = spark.read.parquet(path).drop(column).schema
    rows = aligned(source, schema)
    if rows.columns != schema.names:
        upsert_buckets(dedupe_latest(rows, keys, order), path, keys, order=order, unique=True)
        return
    aside = scratch_path(spark, "upsert")
    try:
        counts = _rows_in(rows, keys, n)
        part = buckets_of(spark, path, list(counts)).drop(column)
        both = rows.withColumn("_stored", F.lit(False)).unionByName(part.withColumn("_stored", F.lit(True)))
        latest = _latest(both, keys, [*order, "_stored"], counts, n)
        changes = materialize_at(latest.withColumn(column, _bucket(keys, n)), f"{aside}/changes")
        touched = [row[0] for row in changes.where("not _stored").select(column).distinct().collect()]
        if touched:
            _write(changes.where(F.col(column).isin(touched)).drop("_stored"), path, column)
    finally:
        storage.delete(spark, aside)
