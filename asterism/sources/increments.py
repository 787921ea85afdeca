"""Parts of a table: those of some days, and those that differ from what is staged."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..functions.casting import day_before, parse_date, parse_keys, quoted
from ..session import materialize


def extract_increment(df: DataFrame, ts_col: str, run_date: str | datetime.date) -> DataFrame:
    """Rows of the day before ``run_date``.

    On a date or timestamp column the comparison reaches the scan as a range, so files and
    row groups of other days are skipped. Rows created earlier and changed later are not
    in the slice of a ``created_at``; use ``updated_at`` to get them.
    """
    return df.where(parse_date(ts_col) == day_before(run_date))


def date_range(df: DataFrame, ts_col: str, start: str, end: str) -> DataFrame:
    """Rows dated from ``start`` to ``end``, both days included."""
    return df.where(parse_date(ts_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


#: What has become of a key since a table was staged.
CHANGE = "change"


def _digest(df: DataFrame, names: list[str]) -> Column:
    """96 bits of a row's values, by two hashes; nulls count by their place."""
    columns = [F.to_json(F.struct(quoted(name))) if "map<" in df.schema[name].dataType.simpleString() else F.col(quoted(name)) for name in names]
    nulls = F.concat(*[F.col(quoted(name)).isNull().cast("int").cast("string") for name in names])
    return F.struct(F.xxhash64(nulls, *columns).alias("a"), F.hash(nulls, *columns).alias("b"))


def snapshot_diff(source: DataFrame, staged: DataFrame | None, keys: str | list[str]) -> DataFrame:
    """What a source table has that is not staged yet, whatever its dates say: ``source``'s columns and ``change``.

    ``insert`` and ``update`` have the row of the source; ``delete`` has the key of a staged row that the source
    lost, and nulls. Rows are compared by a digest of the columns that both tables have, with the types of
    ``staged``. Keys are unique on each side, nulls equal.

    Digests of both tables are shuffled once, by key, and whole rows only of what differs.
    """
    keys = parse_keys(keys)
    if staged is None:
        return source.withColumn(CHANGE, F.lit("insert"))
    shared = [name for name in source.columns if name in staged.columns]
    typed = source.select([F.col(quoted(name)).cast(staged.schema[name].dataType).alias(name) for name in shared])
    sides = [df.select(*[F.col(quoted(k)).alias(f"_key_{k}") for k in keys], _digest(df, shared).alias(side)) for side, df in (("new", typed), ("old", staged))]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    found = both.groupBy(*[f"_key_{k}" for k in keys]).agg(F.max("new").alias("new"), F.max("old").alias("old"))
    kind = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete").when(F.col("new") != F.col("old"), "update")
    found = materialize(found.select(*[f"_key_{k}" for k in keys], kind.alias(CHANGE)).where(F.col(CHANGE).isNotNull()), "changes")
    same = [F.col(quoted(k)).cast(staged.schema[k].dataType).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    rows, changes = storage.sides(source, found.where(F.col(CHANGE) != "delete"))
    changed = rows.join(changes, same).select(*[F.col(quoted(name)) for name in source.columns], CHANGE)
    gone = found.where(F.col(CHANGE) == "delete").select([
        F.col(f"_key_{name}").cast(source.schema[name].dataType).alias(name) if name in keys else F.lit(None).cast(source.schema[name].dataType).alias(name)
        for name in source.columns
    ] + [F.col(CHANGE)])
    return changed.unionByName(gone)
