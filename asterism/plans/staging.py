"""Extract, clean, land by day, and upsert into the staging layer."""

from __future__ import annotations

import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import storage
from ..functions.cleaning import clean_newlines, clean_newlines_nested
from ..operators.mapping import VIOLATIONS
from ..operators.validation import NotNull, land_split
from ..session import scratch_path, scratch_scope
from ..sinks.files import increment_path, read_increment, write_increment
from ..sinks.buckets import read_buckets, upsert_buckets
from ..sinks.runlog import logged, rejected
from ..sinks.tables import latest_version, read_table, upsert_path
from ..sources.files import MALFORMED, is_empty, read_csv_raw, read_json_records
from ..sources.increments import CHANGE, extract_increment, snapshot_diff


def _load(
    cleaned: DataFrame, landing: str, path: str, keys: list[str], run_date: str | datetime.date, slice_by: str | None, log: str | None
) -> DataFrame | None:
    """Land a cleaned increment and upsert it; the landed copy is what is read again.

    Rows without a key, and malformed records, are landed apart in ``<landing>_invalid``, by day like the
    others, with the rules they break. ``log`` is the path of the run log, if there is one.
    """
    with logged(cleaned.sparkSession, log, "staging", "land and upsert", landing, path.rsplit("/", 1)[-1]) as run:
        return _landed(cleaned, landing, path, keys, run_date, slice_by, run)


def _landed(
    cleaned: DataFrame,
    landing: str,
    path: str,
    keys: list[str],
    run_date: str | datetime.date,
    slice_by: str | None,
    run: dict[str, Any],
) -> DataFrame | None:
    spark = cleaned.sparkSession
    rules = [NotNull(key) for key in keys]
    if MALFORMED in cleaned.columns:
        broken = F.when(F.col(MALFORMED).isNotNull(), F.array(F.lit("well_formed"))).otherwise(F.array().cast("array<string>"))
        cleaned = cleaned.withColumn(VIOLATIONS, broken)
    with scratch_scope(spark):
        valid, invalid, seen = land_split(cleaned, rules, scratch_path(spark, "staged"))
        run |= {"n_rows": seen["n_rows"], "error_msg": rejected(seen["n_invalid"])}
        valid = valid.drop(MALFORMED)
        write_increment(valid, landing, run_date)
        apart = f"{landing}_invalid"
        if seen["n_invalid"]:
            rest = [name for name in cleaned.columns if name not in (VIOLATIONS, MALFORMED)]
            row = F.to_json(F.struct(*rest))
            if MALFORMED in cleaned.columns:
                row = F.coalesce(F.col(MALFORMED), row)
            write_increment(invalid.select(VIOLATIONS, row.alias("row")), apart, run_date)
        else:
            storage.delete(spark, increment_path(apart, run_date))
    landed = read_increment(spark, landing, run_date)
    in_buckets = slice_by is None and latest_version(spark, path) is None
    if landed is None or landed.isEmpty():
        return read_buckets(spark, path) if in_buckets else read_table(spark, path)
    return upsert_buckets(landed, path, keys) if in_buckets else upsert_path(landed, path, keys, slice_by)


def stage_table(
    source: DataFrame,
    landing: str,
    path: str,
    keys: list[str],
    run_date: str | datetime.date,
    ts_col: str = "created_at",
    incremental: bool = True,
    slice_by: str | None = None,
    log: str | None = None,
    by_snapshot: bool = False,
) -> DataFrame | None:
    """Stage a table, or its rows of the day before ``run_date``.

    ``by_snapshot`` takes the rows that differ from what is staged instead, so that rows come too which are late or
    have changed without a new date. Rows that the source has lost stay staged.

    It is kept in buckets of its key, or sliced by a column or expression that its rows are staged by, such as
    their day; an increment then reads and rewrites what its keys are in. A table that was staged in
    another layout keeps it.

    Returns the staged table, or ``None`` when there was nothing to stage. Running a day
    again replaces what it landed and leaves the staged table as it was.
    """
    if by_snapshot:
        spark = source.sparkSession
        staged = read_table(spark, path) if latest_version(spark, path) is not None else read_buckets(spark, path)
        differing = snapshot_diff(clean_newlines(source), staged, keys)
        rows = differing.where(F.col(CHANGE) != "delete").drop(CHANGE)
    else:
        rows = extract_increment(source, ts_col, run_date) if incremental else source
    if is_empty(rows):
        return None
    return _load(clean_newlines(rows), landing, path, keys, run_date, slice_by, log)


def stage_json(
    spark: SparkSession,
    payload: str,
    schema: StructType,
    landing: str,
    path: str,
    keys: list[str],
    run_date: str | datetime.date,
    whole_file: bool = False,
    slice_by: str | None = None,
    log: str | None = None,
) -> DataFrame | None:
    """Stage the records of a landed payload; text is cleaned at every depth."""
    rows = read_json_records(spark, payload, schema, whole_file, malformed=True)
    if is_empty(rows):
        return None
    return _load(clean_newlines_nested(rows), landing, path, keys, run_date, slice_by, log)


def stage_csv(
    spark: SparkSession,
    file: str,
    landing: str,
    path: str,
    keys: list[str],
    run_date: str | datetime.date,
    sep: str = ",",
    schema: StructType | None = None,
    slice_by: str | None = None,
    multi_line: bool = False,
    log: str | None = None,
) -> DataFrame | None:
    """Stage a CSV file; without a schema all columns are text."""
    rows = read_csv_raw(spark, file, sep, schema, multi_line, malformed=True)
    if is_empty(rows):
        return None
    return _load(rows, landing, path, keys, run_date, slice_by, log)
