"""Which tables there are, and what columns they have."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage

# Schemas that hold a database's own tables.
SYSTEM_SCHEMAS = ("information_schema", "pg_catalog")


def list_tables(spark: SparkSession, folder: str, suffix: str = ".parquet") -> dict[str, str]:
    """Name and path of every table kept as ``<folder>/<name><suffix>``, by name."""
    found = storage.names(spark, folder)
    return {name.removesuffix(suffix): f"{folder}/{name}" for name in found if name.endswith(suffix)}


def list_catalog_tables(spark: SparkSession, exclude: Iterable[str] = SYSTEM_SCHEMAS) -> list[str]:
    """Qualified names of the session catalog's tables outside the excluded schemas; no views."""
    skipped = set(exclude)
    return sorted(
        f"{database.name}.{table.name}"
        for database in spark.catalog.listDatabases()
        if database.name not in skipped
        for table in spark.catalog.listTables(database.name)
        if not table.isTemporary and table.tableType != "VIEW"
    )


def catalog_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: table_name, column_name, ordinal (from 1), data_type."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, field.name, ordinal, field.dataType.simpleString())
        for name, df in tables.items()
        for ordinal, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, ordinal int, data_type string"
    )


def scan_tables(
    tables: dict[str, DataFrame], step: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Apply ``step`` to each table and stack the results under a ``table_name`` column."""
    parts = [step(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
