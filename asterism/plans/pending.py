"""What a build could not finish: rows it rejected, and facts whose dimension rows have not come yet.

Rejected rows stand in ``<root>/invalid/table_name=<table>`` until they load. Each daily build tries them
again, and takes out those that it has judged anew. Facts that are loaded with a key that resolves to nothing are
noted in ``<root>/waiting/<table>`` with the natural key that is missing; each build resolves again those
whose key has come. Both have a row for each such row, so their size is that of the trouble and not of the table.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.documents import now
from ..operators.mapping import VIOLATIONS
from ..session import materialize, materialize_at
from ..sinks.tables import read_table, write_version

#: Columns of rejected rows, but for the parts of their path. ``source`` is the staging table of a row that
#: cannot be read, and null for a built row; ``key`` is its key there, or its natural key, and may be null.
REJECTED = "source string, key string, violations array<string>, row string, run_date date, created_at timestamp_ntz"
WAITING = "key string, dimension string, missing string"


def report(invalid: DataFrame, rest: list[str], key: Column, source: str | None = None, run_date: str | datetime.date | None = None) -> DataFrame:
    """Rejected rows as they are kept: their columns ``rest`` as JSON."""
    return invalid.select(
        F.lit(source).cast("string").alias("source"), key.cast("string").alias("key"), VIOLATIONS, F.to_json(F.struct(*rest)).alias("row"),
        F.lit(run_date).cast("date").alias("run_date"), now().alias("created_at"),
    )


def _folder(root: str, table: str) -> str:
    return f"{root}/invalid/table_name={table}"


def rejected_rows(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The rows of a table that wait to be loaded; ``None`` if there are none."""
    if not storage.names(spark, _folder(root, table)):
        return None
    return spark.read.schema(f"{REJECTED}, build string").option("basePath", _folder(root, table)).parquet(_folder(root, table)).drop("build")


def rejected_keys(spark: SparkSession, root: str, table: str, source: str | None = None) -> DataFrame | None:
    """The keys to be tried again, of built rows or of those of a staging table; ``None`` if there are none."""
    found = rejected_rows(spark, root, table)
    if found is None:
        return None
    found = found.where(F.col("source").eqNullSafe(F.lit(source)) & F.col("key").isNotNull()).select("key")
    return None if found.isEmpty() else found.distinct()


def settle(spark: SparkSession, root: str, table: str, rejected: DataFrame | None, judged: DataFrame | None) -> None:
    """Put what a build has rejected in place of what it has judged.

    ``judged`` has ``source`` and ``key`` of the rows that the build has tried; ``None`` if these are all.
    What is rejected again keeps the time of its first rejection. The new state is written beside the old one,
    which goes last, so that a build that dies leaves rows to be tried again and loses none.
    """
    before = rejected_rows(spark, root, table)
    if before is None and rejected is None:
        return
    folder, old = _folder(root, table), storage.names(spark, _folder(root, table))
    state = spark.createDataFrame([], REJECTED) if rejected is None else rejected.select(*[name.split()[0] for name in REJECTED.split(", ")])
    if before is not None:
        # A row without a key is known by what it is.
        same = [F.col("source").eqNullSafe(F.col("_source")), F.coalesce("key", "row").eqNullSafe(F.col("_known"))]
        times = before.groupBy(F.col("source").alias("_source"), F.coalesce("key", "row").alias("_known")).agg(F.min("created_at").alias("_first"))
        again = state.join(storage.kept_back(times), same, "left").withColumn("created_at", F.coalesce("_first", "created_at")).drop("_source", "_known", "_first")
        if judged is not None:
            tried = judged.select(F.col("source").alias("_source"), F.col("key").alias("_known"))
            # What has a key was judged under it.
            tried = tried.union(state.where("key IS NULL").select("source", "row"))
            # Keys alone tell whether a row was left out, which is seldom so.
            names = [F.col("source"), F.coalesce("key", "row").alias("row")]
            left = before.select(F.lit(None).cast("string").alias("key"), *names).join(storage.kept_back(tried), same, "left_anti")
            left = materialize(left.select(F.col("source").alias("_source"), F.col("row").alias("_known")).distinct(), "left")
            if not left.isEmpty():
                again = again.unionByName(before.join(storage.kept_back(left), same, "left_semi"))
        state = again
    build = f"build={uuid.uuid4().hex}"
    if materialize_at(state, f"{folder}/{build}").isEmpty():
        old = [*old, build]
    for name in old:
        storage.delete(spark, f"{folder}/{name}")
    if not storage.names(spark, folder):
        storage.delete(spark, folder)


def note_waiting(
    spark: SparkSession, root: str, table: str, loaded: DataFrame, key: str, wanted: Mapping[str, tuple[str, str]], whole: bool
) -> None:
    """Note which of the ``loaded`` facts wait for which dimension rows, in place of what was noted of them.

    ``wanted`` has, for a column that is null if unresolved, the dimension and the column with its natural key.
    ``whole`` says that all facts were loaded, so that nothing noted before holds.
    """
    path = f"{root}/waiting/{table}"
    parts = [
        loaded.where(F.col(column).isNull() & F.col(nk).isNotNull()).select(
            F.col(key).cast("string").alias("key"), F.lit(dimension).alias("dimension"), F.col(nk).cast("string").alias("missing")
        )
        for column, (dimension, nk) in wanted.items()
    ]
    before = read_table(spark, path)
    if not whole and loaded.isEmpty():
        return
    found = materialize(reduce(lambda a, b: a.union(b), parts), "waiting")
    if before is not None and not whole:
        found = found.union(before.join(storage.kept_back(loaded.select(F.col(key).cast("string").alias("key"))), "key", "left_anti"))
    if before is not None or not found.isEmpty():
        write_version(found, path)


def resolved_keys(spark: SparkSession, root: str, table: str, dimensions: Mapping[str, tuple[DataFrame, str]]) -> DataFrame | None:
    """Keys of the facts that wait for rows which ``dimensions`` have by now; ``None`` if there are none.

    ``dimensions`` has the table and the column of its natural key. Of a dimension, that column is read,
    and moved only if too many facts wait to be broadcast.
    """
    noted = read_table(spark, f"{root}/waiting/{table}")
    if noted is None or noted.isEmpty():
        return None
    parts = []
    for name, (dimension, nk) in dimensions.items():
        here = dimension.select(F.col(nk).cast("string").alias("missing"))
        waiting, here = storage.sides(noted.where(F.col("dimension") == name), here)
        parts.append(waiting.join(here, "missing").select("key"))
    found = materialize(reduce(lambda a, b: a.union(b), parts).distinct(), "resolved")
    return None if found.isEmpty() else found
