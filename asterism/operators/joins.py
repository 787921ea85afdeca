"""Left joins that keep the row count of the left side."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.casting import parse_date

#: A key is frequent if it has this share of what a partition gets when all get the same.
FREQUENT = 0.5
#: Keys that may be counted as frequent, and items that the sketch which finds them keeps.
MOST_FREQUENT = 5_000
TRACKED = 100_000


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def frequent_keys(df: DataFrame, on: list[str], parts: int) -> list[tuple[int, int]]:
    """Hashes of the keys that are too frequent for one of ``parts`` partitions, and into how many
    pieces each is to be cut. Rows without a key have the hash of null.

    One pass with a sketch of bounded size, which tasks merge: no key is shuffled. Its counts may be
    too large, which costs a few pieces too many, and never too small for a frequent key.
    """
    keyless = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in on])
    hashed = df.select(F.when(~keyless, F.xxhash64(*on)).alias("k"))
    most = min(MOST_FREQUENT, max(16, int(2 * parts / FREQUENT)))
    row = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {max(TRACKED, 4 * most)})").alias("top")).first()
    fair = max(1.0, row["n"] / parts)
    return [(item["item"], int(-(-item["count"] // fair)) + 1) for item in row["top"] or [] if item["count"] > FREQUENT * fair]


def left_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    counted: DataFrame | None = None,
    small: bool | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``df`` with the columns of ``dim``, which must have one row per key, or nulls.

    A dimension whose rows may be broadcast is joined as it is, and a larger one by a merge join if no key of
    ``df`` is frequent, also where Spark's estimate by compressed files would let it broadcast. Rows of frequent keys must not meet in one task: they are cut into pieces by a
    salt, and ``dim`` has its row of such a key once for each piece, which makes a few rows for
    each partition. Nothing is broadcast for that but the salts.

    Keys are counted in ``counted`` if given: where ``df`` is itself a join, the table it
    started from has the same keys and need not be joined again. ``small`` overrides the
    size check, ``parts`` the number of shuffle partitions.
    """
    on = [on] if isinstance(on, str) else on
    taken = [name for name in dim.columns if name not in on]
    if storage.fits_broadcast(dim) if small is None else small:
        return df.join(dim, on, "left")
    spark = df.sparkSession
    frequent = frequent_keys(df if counted is None else counted, on, parts or _partitions(spark))
    if not frequent:
        return df.join(storage.not_broadcast(dim), on, "left").select(*df.columns, *taken)

    # At most MOST_FREQUENT rows of two numbers.
    pieces = F.broadcast(spark.createDataFrame(frequent, "_hash long, _pieces int"))
    keyless = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in on])
    hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    left = df.withColumn("_key", F.when(~keyless, F.xxhash64(*on)))
    left = left.join(pieces, F.col("_key").eqNullSafe(F.col("_hash")), "left")
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.coalesce(F.col("_pieces"), F.lit(1)).cast("long")))
    right = dim.withColumn("_key", F.xxhash64(*on)).join(pieces, F.col("_key") == F.col("_hash"), "left")
    salts = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_pieces"), F.lit(1)).cast("long") - 1)
    right = right.select(*on, *taken, F.explode(salts).alias("_salt"))
    return left.join(right, [*on, "_salt"], "left").select(*df.columns, *taken)


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    nk: str,
    sk: str,
    out: str | None = None,
    counted: DataFrame | None = None,
    **how,
) -> DataFrame:
    """``df`` with the surrogate ``sk`` that ``dim`` has for the natural key in ``df[key]``."""
    keys = dim.select(F.col(nk).alias("_nk"), F.col(sk).alias("_sk"))
    counted = (df if counted is None else counted).select(F.col(key).alias("_nk"))
    found = left_lookup(df.withColumn("_nk", F.col(key)), keys, "_nk", counted, **how)
    return found.drop("_nk").withColumnRenamed("_sk", out or sk)


def lookup_roles(
    df: DataFrame, dim: DataFrame, roles: Mapping[str, str], nk: str, sk: str, row: str | list[str], small: bool | None = None
) -> DataFrame:
    """``df`` with the surrogate ``sk`` of one dimension for each of several keys, as a person and who they report to.

    ``roles`` has the output column for each key column; ``row`` is a key of ``df``. A dimension that Spark can
    broadcast is joined for each role. A larger one is looked up once: the keys of all roles are unfolded to rows, of
    which only they and ``row`` are moved, and folded back; ``df`` itself is moved once, whatever the number of roles.
    """
    keys = dim.select(F.col(nk).alias("_nk"), F.col(sk).alias("_sk"))
    if storage.fits_broadcast(keys) if small is None else small:
        for key, out in roles.items():
            df = lookup_key(df, dim, key, nk, sk, out, small=True)
        return df
    row = [row] if isinstance(row, str) else list(row)
    names = list(roles)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_role"), F.col(key).alias("_nk")) for i, key in enumerate(names)]))
    unfolded = df.select(*[F.col(name).alias(f"_row_{name}") for name in row], each.alias("_each")).select(*[f"_row_{name}" for name in row], "_each.*")
    # A key that is missing has nothing to be looked up.
    found = left_lookup(unfolded.where("_nk IS NOT NULL"), keys, "_nk", small=False)
    values = [F.max(F.when(F.col("_role") == i, F.col("_sk"))).alias(f"_out_{i}") for i in range(len(names))]
    folded = found.groupBy(*[f"_row_{name}" for name in row]).agg(*values)
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_row_{name}")) for name in row])
    return df.join(folded, same, "left").select(*df.columns, *[F.col(f"_out_{i}").alias(roles[key]) for i, key in enumerate(names)])


def with_date_id(df: DataFrame, ts_col: str, dim_date: DataFrame, out: str = "date_id") -> DataFrame:
    """``df`` with the id of the day of ``ts_col``; null without a day in the calendar.

    A calendar has one row per day, so Spark can broadcast it.
    """
    days = dim_date.select(F.col("date_actual").alias("_day"), F.col("date_id").alias(out))
    return left_lookup(df.withColumn("_day", parse_date(ts_col)), days, "_day").drop("_day")


def left_join_measures(spine: DataFrame, *measures: DataFrame, on: str) -> DataFrame:
    """``spine`` with the columns of each measure table, which has one row per key.

    For a spine that has been aggregated, such as to a row per key and day: then no key has
    more rows than there are days, and plain joins on the same key do.
    """
    return reduce(lambda rows, table: rows.join(table, on, "left"), measures, spine)
