"""What the DataFrame API has no call for: files of any storage Spark reaches, and size estimates.

This is the only module that goes through Spark's JVM gateway.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: What a row takes beside its columns, as Spark counts it.
ROW_BYTES = 8


class AlreadyThere(RuntimeError):
    """A file that was to be created exists."""


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, sorted; none if it is absent."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder))


def delete(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def make_folder(spark: SparkSession, path: str, until_exit: bool = False) -> None:
    files, folder = _folder(spark, path)
    files.mkdirs(folder)
    if until_exit:
        files.deleteOnExit(folder)


def read_text(spark: SparkSession, path: str) -> str:
    files, file = _folder(spark, path)
    stream = files.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet."""
    files, file = _folder(spark, path)
    try:
        stream = files.create(file, False)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            raise AlreadyThere(path) from None
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a plan's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _spark_broadcasts(df: DataFrame) -> bool:
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)


def fits_broadcast(df: DataFrame, rows: Callable[[], int] | None = None) -> bool:
    """Whether the rows of ``df`` may be broadcast, by their number and the width of their types.

    Spark's estimate is that of the files, which are compressed: a table of numbers and keys can take a hundred times as
    much on the driver. Rows are counted only where Spark would broadcast, or by ``rows``, which may give more than there are.
    """
    if not _spark_broadcasts(df):
        return False
    return (rows or df.count)() * (ROW_BYTES + df._jdf.schema().defaultSize()) <= broadcast_limit(df.sparkSession)


def not_broadcast(df: DataFrame) -> DataFrame:
    """``df`` as the right side of a join for which Spark must not broadcast it by its own estimate."""
    return df.hint("merge") if _spark_broadcasts(df) else df


def kept_back(df: DataFrame, rows: Callable[[], int] | None = None) -> DataFrame:
    """``df`` as the right side of a join: not broadcast if its rows are too many for that."""
    return df if not _spark_broadcasts(df) or fits_broadcast(df, rows) else not_broadcast(df)


def sides(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sides of an inner join: one of them is broadcast if its rows may be, and else both are moved."""
    if fits_broadcast(right):
        return left, F.broadcast(right)
    if fits_broadcast(left):
        return F.broadcast(left), right
    return (left, right.hint("merge")) if _spark_broadcasts(left) or _spark_broadcasts(right) else (left, right)


def parses_text(df: DataFrame) -> bool:
    """Whether a plan reads files whose rows have to be parsed, whatever columns are wanted."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return any(f"Format: {kind}" in plan for kind in ("CSV", "JSON", "Text", "XML"))


def reads_in_order(df: DataFrame) -> bool:
    """Whether a plan only scans, filters, projects and unites files, so that a task that is run again sees the same rows in the same order."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    names = [line.lstrip(" :+-").removeprefix("*").split(") ", 1)[-1].split(" ", 1)[0].split("(", 1)[0] for line in plan.splitlines() if line.strip()]
    return set(names) <= {"Project", "Filter", "Union", "ColumnarToRow", "FileScan"}


def broadcast_limit(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


__all__ = [
    "AlreadyThere", "broadcast_limit", "create_text", "delete", "estimated_bytes", "exists", "fits_broadcast", "kept_back",
    "make_folder", "names", "not_broadcast", "parses_text", "read_text", "reads_in_order", "sides",
]
