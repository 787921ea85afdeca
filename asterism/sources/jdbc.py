"""Tables of a database, read in parallel over a numeric, date or timestamp column."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    table: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options that let the database project and filter before rows cross the wire."""
    query = f"SELECT {', '.join(columns) if columns else '*'} FROM {table}"
    if where:
        query += f" WHERE {where}"
    return {"dbtable": f"({query}) data", "fetchsize": str(fetch_size)}


def range_query(dbtable: str, column: str) -> str:
    """A query for the least and greatest value of a column, which the database computes itself.

    Spark hands filters and columns down to this kind of source, but no aggregates.
    """
    return f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {dbtable}) bounds"


def quantile_query(dbtable: str, column: str, n: int) -> str:
    """A query for the values that cut a column into ``n`` parts with as many rows, which the database computes itself."""
    cuts = ", ".join(f"PERCENTILE_DISC({i / n}) WITHIN GROUP (ORDER BY {column}) AS q{i}" for i in range(1, n))
    return f"(SELECT {cuts} FROM {dbtable}) bounds"


def stride_bounds(df: DataFrame, column: str, n: int) -> list[Any]:
    """The same of a column that Spark can read, such as the table as it was staged; approximately."""
    if n < 2:
        return []
    return df.agg(F.percentile_approx(column, [i / n for i in range(1, n)])).first()[0] or []


def _literal(value: Any) -> str:
    if isinstance(value, bool) or value is None:
        raise ValueError(f"cannot be a bound: {value}")
    return str(value) if isinstance(value, (int, float, Decimal)) else "'" + str(value).replace("'", "''") + "'"


def stride_predicates(column: str, bounds: Sequence[Any]) -> list[str]:
    """Conditions of which each row meets exactly one: rows from one bound to before the next, nulls with the first.

    Equal bounds count once, so a value that holds much of a table has a stride of its own.
    """
    cuts = [_literal(value) for value in sorted({value for value in bounds if value is not None})]
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *between, f"{column} >= {cuts[-1]}"]


def hash_predicates(hashed: str, n: int) -> list[str]:
    """Conditions for text keys, which have no strides: ``hashed`` is the database's hash of one as a number."""
    first = f"(ABS({hashed} % {n}) = 0 OR {hashed} IS NULL)"
    return [first, *[f"ABS({hashed} % {n}) = {i}" for i in range(1, n)]]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    partition_col: str | None = None,
    n: int = 1,
    properties: dict[str, str] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read a table, or part of one, with ``n`` connections.

    ``predicates`` (of ``stride_predicates`` or ``hash_predicates``) are the strides where values are spread
    unevenly, or are text: each is a task's.

    With ``partition_col`` the range is asked of the database (one row), and each of the
    ``n`` tasks reads one stride of it; rows below and above the range are still read, by
    the first and the last task. Filters put on the result are pushed down as well.
    """
    options = jdbc_options(table, columns, where) | (properties or {})
    if predicates:
        given = {"fetchsize": options["fetchsize"]} | (properties or {})
        return spark.read.jdbc(url, options["dbtable"], predicates=list(predicates), properties=given)
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_col is None or n == 1:
        return reader.load()
    low, high = reader.option("dbtable", range_query(options["dbtable"], partition_col)).load().first()
    if low is None:
        return reader.load()
    return reader.options(
        partitionColumn=partition_col, lowerBound=str(low), upperBound=str(high), numPartitions=str(n)
    ).load()
