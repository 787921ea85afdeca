"""Column profiles: type, samples, completeness and negative values.

A table is read twice: once for the counts and a bound on the samples of each column, once for the
values within the bounds. The first pass takes columns in groups, as the code generated for
hundreds of aggregates gets too long to be compiled; each group reads its own columns only, which
costs no more where files are by column. Rows of text files are first written by column, so that they
are parsed once.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, NumericType, StringType, StructField

from .. import storage
from ..functions.casting import quoted
from ..functions.documents import json_doc, now, to_json_text
from ..functions.quality import pct, quality_label
from ..schemas import PROFILE, struct
from ..session import materialize, run_all, scratch_scope
from ..sinks.runlog import logged
from ..sinks.tables import append, ensure_table
from .keys import with_dense_id
from .mapping import tag

COLUMNS_PER_SCAN = 12
SAMPLE_SIZE = 5


def _simple(field: StructField) -> bool:
    return isinstance(field.dataType, AtomicType) and not isinstance(field.dataType, BinaryType)


def _value(field: StructField) -> str:
    """SQL for a column's values in an order of their own; nested and binary ones as text."""
    return quoted(field.name) if _simple(field) else f"CAST({quoted(field.name)} AS STRING)"


def _scan(df: DataFrame, fields: list[StructField], n: int) -> list[dict[str, Any]]:
    """Counts of some columns, and the text of a bound on the ``n`` smallest values of each.

    The bound is the n-th smallest of the least values of ``n + 3`` hash buckets. These are
    values of the column, so at least ``n`` distinct ones lie within the bound, and hardly
    more do. Without that many values there is no bound, and none is needed.
    """
    buckets = n + 3 if n else 0
    values = df.selectExpr(
        *[f"{_value(field)} AS v{i}" for i, field in enumerate(fields)],
        *[f"pmod(xxhash64({_value(field)}), {buckets}) AS h{i}" for i, field in enumerate(fields) if n],
    )
    aggregates = ["count(1) AS n_rows"]
    for i, field in enumerate(fields):
        negatives = f"count_if(v{i} < 0)" if isinstance(field.dataType, NumericType) else "0L"
        least = ", ".join(f"min(IF(h{i} = {b}, v{i}, NULL))" for b in range(buckets))
        bound = f"get(array_sort(array_distinct(array_compact(array({least})))), {n - 1})" if n else "NULL"
        aggregates += [f"count(v{i}) AS c{i}", f"{negatives} AS g{i}", f"CAST({bound} AS STRING) AS b{i}"]
    row = values.agg(*map(F.expr, aggregates)).first()
    return [
        dict(n_rows=row["n_rows"], not_null_count=row[f"c{i}"], negative_count=row[f"g{i}"], bound=row[f"b{i}"])
        for i in range(len(fields))
    ]


def _stats(df: DataFrame, n: int) -> list[dict[str, Any]]:
    """What ``_scan`` finds, per column; text goes apart, as it slows down other aggregates."""
    fields = df.schema.fields
    plain = [f for f in fields if _simple(f) and not isinstance(f.dataType, StringType)]
    texts = [f for f in fields if f not in plain]
    found = {}
    for kind in (plain, texts):
        for at in range(0, len(kind), COLUMNS_PER_SCAN):
            group = kind[at : at + COLUMNS_PER_SCAN]
            found |= {field.name: stats for field, stats in zip(group, _scan(df, group, n))}
    return [found[name] for name in df.columns]


def _samples(df: DataFrame, stats: list[dict[str, Any]], n: int) -> DataFrame:
    """``ordinal`` and ``found``, the ``n`` smallest distinct values of each column as text, by one scan.

    Few distinct values are within a column's bound, so what a task gathers stays small.
    """
    gathered = []
    for field, found in zip(df.schema.fields, stats):
        value = F.expr(_value(field))
        if found["bound"] is not None:
            kind = field.dataType if _simple(field) else StringType()
            value = F.when(value <= F.lit(found["bound"]).cast(kind), value)
        smallest = F.slice(F.array_sort(F.collect_set(value)), 1, n)
        gathered.append(F.transform(smallest, lambda v: v.cast("string")))
    places = F.array(*[F.struct(F.lit(at).alias("ordinal"), column.alias("found")) for at, column in enumerate(gathered, start=1)])
    return df.agg(places.alias("p")).select(F.explode("p").alias("p")).select("p.*")


def sample_values(df: DataFrame, name: str, n: int = SAMPLE_SIZE) -> DataFrame:
    """The ``n`` smallest distinct values of a column, as text, in the column ``value``."""
    one = df.select(quoted(name))
    field = one.schema.fields[0]
    return _samples(one, _scan(one, [field], n), n).select(F.explode("found").alias("value"))


def profile(df: DataFrame, table_name: str, sample_size: int = SAMPLE_SIZE) -> DataFrame:
    """One row per column of ``df``.

    table_name, column_name, ordinal, data_type, n_rows, not_null_count,
    percentage_completeness, data_quality_completeness_result, is_negative_values, and
    sample_data: the smallest distinct values as text, empty if there are none.
    """
    spark = df.sparkSession
    if storage.parses_text(df):
        df = materialize(df, "profiled")
    stats = _stats(df, sample_size)
    counts = spark.createDataFrame(
        [
            (at, f.name, f.dataType.simpleString(), s["n_rows"], s["not_null_count"], s["negative_count"])
            for at, (f, s) in enumerate(zip(df.schema.fields, stats), start=1)
        ],
        "ordinal int, column_name string, data_type string, n_rows bigint, not_null_count bigint, "
        "negative_count bigint",
    )
    if sample_size and df.columns:
        counts = counts.join(_samples(df, stats, sample_size), "ordinal", "left")
    else:
        counts = counts.withColumn("found", F.lit(None).cast("array<string>"))
    whole, filled = F.col("n_rows"), F.col("not_null_count")
    return counts.select(
        F.lit(table_name).alias("table_name"),
        "column_name",
        "ordinal",
        "data_type",
        "n_rows",
        "not_null_count",
        pct(filled, whole).alias("percentage_completeness"),
        quality_label(filled, whole).alias("data_quality_completeness_result"),
        (F.col("negative_count") > 0).alias("is_negative_values"),
        F.coalesce("found", F.array().cast("array<string>")).alias("sample_data"),
    )


def profile_document(profiles: DataFrame, schema: str = "-") -> DataFrame:
    """One row per table of a profile: n_rows, n_cols and two maps keyed by column."""
    columns = F.collect_list(
        F.struct(
            "ordinal",
            "column_name",
            json_doc(data_type="data_type", sample_data="sample_data").alias("profile"),
            json_doc(
                percentage_completeness="percentage_completeness",
                data_quality_completeness_result="data_quality_completeness_result",
                is_negative_values="is_negative_values",
            ).alias("quality"),
        )
    )
    tables = profiles.groupBy("table_name", "n_rows").agg(F.array_sort(columns).alias("columns"))

    def keyed(part: str) -> Column:
        return F.map_from_entries(F.transform("columns", lambda c: F.struct(c["column_name"], c[part])))

    return tables.select(
        F.lit(schema).alias("schema"),
        "table_name",
        "n_rows",
        F.size("columns").alias("n_cols"),
        keyed("profile").alias("data_profile"),
        keyed("quality").alias("data_quality"),
    )


def profile_all(tables: Mapping[str, DataFrame], sample_size: int = SAMPLE_SIZE) -> DataFrame:
    """The profiles of several tables, stacked; they are made side by side.

    Each is written when it is ready, so that no plan has the scans of all tables.
    """
    spark = next(iter(tables.values())).sparkSession

    def made(name: str) -> DataFrame:
        return materialize(profile(tables[name], name, sample_size), "profile")

    return reduce(DataFrame.unionByName, run_all(spark, [partial(made, name) for name in tables]))


def persist_profiles(
    tables: Mapping[str, DataFrame],
    path: str,
    person_in_charge: str,
    source: str = "-",
    schema: str = "-",
    sample_size: int = SAMPLE_SIZE,
    log: str | None = None,
) -> dict[str, str]:
    """Profile tables one by one and append each profile when it is ready.

    A table that fails leaves the others' profiles in place; what it failed with is returned by name. ``log`` is
    the path of the run log, which gets a row for each table, if there is one.
    """
    failed = {}
    for name, df in tables.items():
        try:
            with logged(df.sparkSession, log, "profiling", "profile and append", source, name) as run, scratch_scope(df.sparkSession):
                document = materialize(profile_document(profile(df, name, sample_size), schema), "document")
                persist_profile(tag_profile(document, person_in_charge, source), path)
                run["n_rows"] = document.first()["n_rows"]
        except Exception as error:
            failed[name] = str(error)
    return failed


def tag_profile(documents: DataFrame, person_in_charge: str, source: str = "-") -> DataFrame:
    return tag(documents, person_in_charge=person_in_charge, source=source)


def persist_profile(documents: DataFrame, path: str) -> None:
    """Append tagged profile documents, as JSON text, under the next ids and the load time."""
    spark: SparkSession = documents.sparkSession
    schema = struct(PROFILE)
    last = ensure_table(spark, path, schema).agg(F.coalesce(F.max("profile_id"), F.lit(0))).first()[0]
    numbered = with_dense_id(documents, ["source", "schema", "table_name"], "profile_id", start=last + 1)
    rows = numbered.withColumns(
        {
            "data_profile": to_json_text("data_profile"),
            "data_quality": to_json_text("data_quality"),
            "created_at": now(),
        }
    )
    append(rows.select(schema.names), path)
