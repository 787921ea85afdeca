"""File sinks. Every task writes its own part; nothing passes through the driver."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from ..functions.casting import parse_date
from ..sources.files import TIMESTAMP_FORMAT, read_or_none


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    """Replace ``path`` by CSV files with a header. Line breaks in text must be cleaned before.

    An empty text and a null are both written empty and read back as null. Blanks at the ends
    of a text are kept, which Spark's writer would strip by default.
    """
    df.write.mode("overwrite").options(
        header=True,
        sep=sep,
        escape='"',
        timestampNTZFormat=TIMESTAMP_FORMAT,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Replace ``path`` by JSON files, one object per line."""
    df.write.mode("overwrite").option("timestampNTZFormat", TIMESTAMP_FORMAT).json(path)


def increment_path(path: str, run_date: str | datetime.date) -> str:
    """Where the increment extracted on ``run_date`` is kept: under the day before."""
    if isinstance(run_date, str):
        run_date = datetime.date.fromisoformat(run_date)
    return f"{path}/ds={run_date - datetime.timedelta(days=1)}"


def write_increment(df: DataFrame, path: str, run_date: str | datetime.date) -> None:
    """Write the increment of one day; a rerun replaces that day and no other."""
    df.write.mode("overwrite").parquet(increment_path(path, run_date))


def write_increments(df: DataFrame, path: str, ts_col: str) -> None:
    """Land a whole table as the increments of its days, in one job; replaces those days.

    Days with many rows are split among tasks and small ones put together.
    """
    days = df.withColumn("ds", parse_date(ts_col)).hint("rebalance", "ds")
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ds").parquet(path)


def read_increment(spark: SparkSession, path: str, run_date: str | datetime.date) -> DataFrame | None:
    """The increment of one day, or ``None`` when that day has none."""
    return read_or_none(lambda: spark.read.parquet(increment_path(path, run_date)))
