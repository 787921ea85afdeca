"""Surrogate keys."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import storage
from ..session import materialize, observed
from ..sinks.upsert import DuplicateKeys

# monotonically_increasing_id() is (partition << 33) + position in the partition.
POSITION_BITS = 33


def with_dense_id(
    df: DataFrame, order_by: str | list[str], out: str, start: int = 1, unique: bool = True,
    distinct: bool = False, keep: list[str] | None = None,
) -> DataFrame:
    """``df`` numbered ``start, start + 1, …`` in the order of ``order_by``, ``out`` first.

    The rows are partitioned by range and sorted, numbered within their partition, and
    written aside. A partition's first number follows from the count of rows in those
    before it: one number per partition, and all that the driver gets to see. The result
    adds it to the position while it reads the written rows, without a join or a shuffle.

    ``order_by`` must be a key for the numbers to be the same in every run. With
    ``unique=False`` all other columns break ties, and rows equal in every column are told
    apart by a number that is written down first, so that they too spread over partitions. Rows that
    come straight from files have it in their place there. ``distinct`` refuses a key that is there twice, which the
    sorted partitions show; ``keep`` are the columns that the result has, if not all.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    columns = df.columns
    if not unique:
        df = df.withColumn("_tie", F.monotonically_increasing_id())
        if not storage.reads_in_order(df):
            df = materialize(df, f"ties-{out}")
        order += [name for name in columns if name not in order] + ["_tie"]
    columns = columns if keep is None else keep
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    repeated = F.lit(False)
    if distinct:
        # Rows of a key are together, and sorted, already.
        placed = placed.withColumn("_alike", F.count(F.lit(1)).over(Window.partitionBy(*order)))
        repeated = F.col("_alike") > 1
    placed = placed.select(*columns, F.monotonically_increasing_id().alias("_place"), repeated.alias("_repeated"))
    placed = materialize(placed, f"numbered-{out}")
    part = F.shiftright("_place", POSITION_BITS)
    found = placed.groupBy(part).agg(F.count(F.lit(1)), F.count_if("_repeated")).collect()
    if any(row[2] for row in found):
        raise DuplicateKeys(f"{order} not unique, e.g. {[row.asDict() for row in placed.where('_repeated').select(order).take(5)]}")
    counts = {row[0]: row[1] for row in found}
    before = accumulate((counts.get(i, 0) for i in range(max(counts, default=0) + 1)), initial=start)
    first = F.get(F.expr(f"array({', '.join(f'{n}L' for n in before)})"), part.cast("int"))
    position = F.col("_place").bitwiseAND((1 << POSITION_BITS) - 1)
    return placed.select((first + position).alias(out), *columns)


def assign_ids(
    known: DataFrame | None, new: DataFrame, nk: str | list[str], sk: str
) -> DataFrame:
    """``new`` with a surrogate per natural key: that of ``known`` if it has one, else the next.

    ``new`` has one row per key; a null is a key like any other.
    """
    if known is None:
        return with_dense_id(new, nk, sk)
    nk = [nk] if isinstance(nk, str) else nk
    known = known.select(*[F.col(name).alias(f"_nk_{name}") for name in nk], sk)
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_nk_{name}")) for name in nk])
    last = known.agg(F.coalesce(F.max(sk), F.lit(0))).first()[0]
    matched = new.join(storage.kept_back(known), same, "left").select(sk, *new.columns)
    matched, seen = observed(matched, added=F.count_if(F.col(sk).isNull()))
    matched = materialize(matched, f"matched-{sk}")
    if not seen.get["added"]:
        return matched
    added = matched.where(F.col(sk).isNull()).drop(sk)
    return matched.where(F.col(sk).isNotNull()).unionByName(
        with_dense_id(added, nk, sk, start=last + 1)
    )


def with_hash_id(df: DataFrame, nk: str, out: str) -> DataFrame:
    """A key that needs no order and no earlier keys: the MD5 of the natural key as text."""
    return df.select(F.md5(F.col(nk).cast("string")).alias(out), "*")
