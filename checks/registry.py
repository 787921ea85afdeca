"""Where the queries and their SQL are kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from asterism.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a data folder: ``t.orders`` reads ``orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

        self.made: dict[str, DataFrame] = {}

    def once(self, name: str, build: Callable[[], DataFrame], written: bool = False) -> DataFrame:
        """A table that is derived from the others, written the first time it is asked for if ``build`` has not."""
        if name not in self.made:
            self.made[name] = build() if written else materialize(build(), name)
        return self.made[name]

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def check(name: str, sql: str | None = None):
    """Register ``build(t)`` as a query, and the SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = partial(_run, build)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def _run(build: Callable[[Tables], DataFrame], spark: SparkSession, folder: str) -> DataFrame:
    return build(Tables(spark, folder))
