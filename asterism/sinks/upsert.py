"""Insert new keys, replace the supplied columns of known ones."""

from __future__ import annotations

from functools import cache, reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import storage
from ..functions.casting import parse_keys, quoted


class DuplicateKeys(ValueError):
    """A key occurs more than once in rows that an upsert would write."""


def duplicate_keys(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """Keys held by more than one row, with their ``row_count``."""
    counts = df.groupBy(*parse_keys(keys)).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.where("row_count > 1")


def assert_unique(df: DataFrame, keys: str | list[str]) -> None:
    """Raise ``DuplicateKeys`` unless every key occurs once; nulls count as equal."""
    found = duplicate_keys(df, keys).take(5)
    if found:
        raise DuplicateKeys(f"{parse_keys(keys)} not unique, e.g. {[row.asDict() for row in found]}")


def content_hash(schema: StructType) -> Column:
    """A number made of all columns, which decides between rows that an order leaves equal, wherever they meet."""
    def plain(field) -> Column:
        # Neither maps nor variants can be hashed.
        column = F.col(quoted(field.name))
        return F.to_json(F.struct(column)) if any(kind in field.dataType.simpleString() for kind in ("map<", "variant")) else column

    return F.xxhash64(*[plain(field) for field in schema.fields])


def dedupe_latest(df: DataFrame, keys: str | list[str], order: list[str | Column]) -> DataFrame:
    """The last row of each key by ``order``, which should tell the rows of a key apart.

    An aggregate, so that each task reduces its rows of a key to one before the shuffle.
    """
    keys = parse_keys(keys)
    rest = [name for name in df.columns if name not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(df.columns)


def match(keys: list[str]) -> Column:
    """Null-safe equality of columns with those renamed to ``_key_<name>``."""
    return reduce(and_, [F.col(key).eqNullSafe(F.col(f"_key_{key}")) for key in keys])


def _renamed_keys(df: DataFrame, keys: list[str]) -> list[Column]:
    return [df[key].alias(f"_key_{key}") for key in keys]


def aligned(source: DataFrame, schema: StructType) -> DataFrame:
    """``source`` in the order and types of the columns it shares with ``schema``; others are refused."""
    unknown = [name for name in source.columns if name not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")
    return source.select(
        [
            F.col(quoted(name)) if source.schema[name].dataType == schema[name].dataType else F.col(quoted(name)).cast(schema[name].dataType).alias(name)
            for name in schema.names
            if name in source.columns
        ]
    )


def upsert(target: DataFrame, source: DataFrame, keys: str | list[str]) -> DataFrame:
    """``target`` with the rows of ``source`` put in; keys must be unique in ``source``.

    New keys are inserted. Of known keys, the columns that the source has are replaced,
    by nulls too; the others keep the target's values.

    The source is the small side, and the target's rows are only moved when the source is
    too large to be broadcast. Then both sides are shuffled on the key, which is unique on
    each side, so that no partition is heavier than the others.
    """
    keys = parse_keys(keys)
    source = aligned(source, target.schema)
    supplied = source.columns
    source_keys = source.select(_renamed_keys(source, keys))
    if len(supplied) == len(target.columns):
        return target.join(storage.kept_back(source_keys), match(keys), "left_anti").unionByName(source)

    changes = source.select(
        F.lit(True).alias("_hit"),
        *_renamed_keys(source, keys),
        *[F.col(name).alias(f"_new_{name}") for name in supplied if name not in keys],
    )
    n_source = cache(source.count)
    updated = target.join(storage.kept_back(changes, n_source), match(keys), "left").select(
        [
            F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
            if name in supplied and name not in keys
            else F.col(name)
            for name in target.columns
        ]
    )
    known = target.select(keys).join(storage.kept_back(source_keys, n_source), match(keys), "left_semi")
    known = known.select(_renamed_keys(known, keys))
    # No more of the target's keys are known than the source has.
    inserted = source.join(storage.kept_back(known, n_source), match(keys), "left_anti")
    return updated.unionByName(inserted, allowMissingColumns=True)
