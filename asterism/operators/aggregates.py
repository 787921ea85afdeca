"""One row per key, and distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: str | list[str], order: list[str], last: bool = False) -> DataFrame:
    """The first row of each key by ``order``, or the last; ``order`` tells its rows apart.

    Each task reduces its rows of a key to one before the shuffle, so a key with very many
    rows is no heavier than the others.
    """
    keys = [keys] if isinstance(keys, str) else keys
    rest = [name for name in df.columns if name not in keys]
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(df.columns)


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct()
