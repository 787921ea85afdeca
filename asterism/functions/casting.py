"""Casts that turn unreadable text into null instead of failing the job.

With ANSI mode on, a plain cast aborts the whole job on one bad value. These return null,
and ``operators.validation.Castable`` reports the rows it happened to.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column's name as SQL writes it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# What text can be read as each type. A cast finds that out by an exception,
# which takes many times as long as the pattern when much of a column is unreadable.
_WHOLE = r"^\s*[+-]?\d+\s*$"
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DOUBLE = r"^\s*[+-]?(\d+\.?\d*|\.\d+|NaN|Infinity)([eE][+-]?\d+)?\s*$"
_DATE = r"^\s*\d{4}-\d{2}-\d{2}([ T].*)?$"
PATTERNS = {
    "tinyint": _WHOLE,
    "smallint": _WHOLE,
    "int": _WHOLE,
    "bigint": _WHOLE,
    "decimal": _DECIMAL,
    "float": _DOUBLE,
    "double": _DOUBLE,
    "date": _DATE,
}
TRUE = ["true", "t", "yes", "y", "1"]
FALSE = ["false", "f", "no", "n", "0"]


def read_as(col: Column | str, kind: str) -> Column:
    """A column as the given type; text that cannot be read as it is null.

    A date is ``yyyy-MM-dd`` with or without a time part, not one of the shorter forms that
    a cast accepts: ``2008`` is not 1 January. The type test is settled when the query is
    planned, so columns that are not text are simply cast.
    """
    column = _column(col)
    family = kind.split("(")[0]
    if family == "boolean":
        word = F.lower(F.trim(column.cast("string")))
        return F.when(word.isin(TRUE), True).when(word.isin(FALSE), False)
    if family not in PATTERNS:
        return column.try_cast(kind)
    not_text = F.typeof(column) != "string"
    return F.when(not_text | column.cast("string").rlike(PATTERNS[family]), column.try_cast(kind))


def parse_date(col: Column | str) -> Column:
    return read_as(col, "date")


def to_int(col: Column | str) -> Column:
    return read_as(col, "int")


def to_bool(col: Column | str) -> Column:
    return read_as(col, "boolean")


def to_decimal(col: Column | str, precision: int = 15, scale: int = 2) -> Column:
    return read_as(col, f"decimal({precision},{scale})")


def to_ts(col: Column | str) -> Column:
    """ISO timestamp without zone."""
    return read_as(col, "timestamp_ntz")


def to_text(col: Column | str) -> Column:
    return _column(col).cast("string")


def day_before(day: Column | str | datetime.date) -> Column:
    """The day before a date column, or before a given date (``date`` or ``yyyy-MM-dd``)."""
    if isinstance(day, Column):
        return F.date_sub(day, 1)
    if isinstance(day, str):
        day = datetime.date.fromisoformat(day)
    return F.lit(day - datetime.timedelta(days=1))


def type_name(df: DataFrame, name: str) -> str:
    """Type of a column, as Spark spells it."""
    return df.schema[name].dataType.simpleString()


def parse_keys(spec: str | list[str]) -> list[str]:
    """Key columns from ``"id"``, ``"[a, b]"`` or a list."""
    if not isinstance(spec, str):
        return list(spec)
    names = [part.strip().strip("'\"") for part in spec.strip().removeprefix("[").removesuffix("]").split(",")]
    if not all(names):
        raise ValueError(f"not a key list: {spec!r}")
    return names
