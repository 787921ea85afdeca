"""Source columns to target columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import read_as

#: Column with the names of the rules that a row breaks.
VIOLATIONS = "violations"


class Rule(NamedTuple):
    """One line of a mapping: target column, source column, and its type (none: as it is)."""

    target: str
    source: str
    type: str | None = None


def map_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns, source name to target name; the others stay."""
    return df.withColumnsRenamed(dict(names))


def _cast(rule: Rule) -> Column:
    if rule.type is None:
        return F.col(rule.source)
    if rule.type == "string":
        return F.col(rule.source).cast("string")
    return read_as(rule.source, rule.type)


def unreadable(source: str, kind: str) -> Column:
    """The name of the violation where a column has a value that cannot be read as the type; else null."""
    value = F.col(source)
    return F.when(value.isNotNull() & read_as(value, kind).isNull(), F.lit(f"{kind}({source})"))


def apply_mapping(df: DataFrame, rules: Sequence[Rule | tuple], report: bool = False) -> DataFrame:
    """The target columns of a mapping, in its order, in one projection.

    Only the sources it names are read. A value that does not fit its type becomes null; with
    ``report``, the column ``violations`` names it, evaluated on the source in the same pass.
    """
    rules = [Rule(*rule) for rule in rules]
    columns = [_cast(rule).alias(rule.target) for rule in rules]
    if report:
        typed = [rule for rule in rules if rule.type not in (None, "string")]
        names = F.array_compact(F.array(*[unreadable(rule.source, rule.type) for rule in typed])) if typed else F.array()
        columns.append(names.cast("array<string>").alias(VIOLATIONS))
    return df.select(columns)


def tag(df: DataFrame, **constants: Any) -> DataFrame:
    """Constant columns in front of the others."""
    return df.select(*[F.lit(value).alias(name) for name, value in constants.items()], "*")
