"""The gate between the build and the load: rules, valid and invalid rows, a report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import read_as
from ..session import COMPRESSION, observed
from .joins import left_lookup
from .mapping import VIOLATIONS


@dataclass(frozen=True)
class NotNull:
    """The column has a value."""

    column: str

    @property
    def name(self) -> str:
        return f"not_null({self.column})"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Castable:
    """The text of the column, if any, can be read as the type."""

    column: str
    type: str

    @property
    def name(self) -> str:
        return f"{self.type}({self.column})"

    def broken(self) -> Column:
        value = F.col(self.column)
        return value.isNotNull() & read_as(value, self.type).isNull()


@dataclass(frozen=True)
class ForeignKey:
    """The key in the column, if any, occurs in the parent's column."""

    column: str
    parent: DataFrame
    parent_column: str

    @property
    def name(self) -> str:
        return f"foreign_key({self.column})"

    def attach(self, df: DataFrame, flag: str, counted: DataFrame) -> DataFrame:
        """``df`` with a column that is true where the parent has the key."""
        keys = self.parent.select(F.col(self.parent_column).alias("_parent")).distinct()
        keys = keys.withColumn(flag, F.lit(True))
        counted = counted.select(F.col(self.column).alias("_parent"))
        df = df.withColumn("_parent", F.col(self.column))
        return left_lookup(df, keys, "_parent", counted).drop("_parent")


Rule = NotNull | Castable | ForeignKey


def tag_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with an array of the names of the rules each row breaks, after those it has already.

    All rules of a table are checked in the same pass; a foreign key adds a join.
    """
    checks = []
    tagged = df
    for number, rule in enumerate(rules):
        if isinstance(rule, ForeignKey):
            flag = f"_found_{number}"
            tagged = rule.attach(tagged, flag, counted=df)
            broken = F.col(rule.column).isNotNull() & F.col(flag).isNull()
        else:
            broken = rule.broken()
        checks.append(F.when(broken, F.lit(rule.name)))
    names = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    if VIOLATIONS in df.columns:
        names = F.concat(VIOLATIONS, names)
    return tagged.select(*[name for name in df.columns if name != VIOLATIONS], names.alias(VIOLATIONS))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the others with their ``violations``."""
    tagged = tag_violations(df, rules)
    whole = F.size(VIOLATIONS) == 0
    return tagged.where(whole).drop(VIOLATIONS), tagged.where(~whole)


def land_split(
    df: DataFrame, rules: Sequence[Rule], path: str
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """As ``split_valid``, written under ``path`` in one pass and read back from there.

    Each half is a partition of the landed table, so reading one does not touch the other.
    The third result counts ``n_rows`` and ``n_invalid``, as seen while writing.
    """
    tagged = tag_violations(df, rules)
    tagged = tagged.withColumn("is_valid", F.size(VIOLATIONS) == 0)
    tagged, seen = observed(
        tagged, n_rows=F.count(F.lit(1)), n_invalid=F.count_if(~F.col("is_valid"))
    )
    tagged.write.mode("overwrite").option("compression", COMPRESSION).partitionBy("is_valid").parquet(path)
    landed = df.sparkSession.read.schema(tagged.schema).parquet(path)
    valid = landed.where("is_valid").drop("is_valid", VIOLATIONS)
    return valid, landed.where("NOT is_valid").drop("is_valid"), seen.get


def validation_report(invalid: DataFrame) -> DataFrame:
    """Rows that break each rule: ``rule``, ``row_count``."""
    broken = invalid.select(F.explode(VIOLATIONS).alias("rule"))
    return broken.groupBy("rule").agg(F.count(F.lit(1)).alias("row_count"))
