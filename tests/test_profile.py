import importlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from asterism import operators as ops


def by_column(profiles):
    return {row.column_name: row for row in profiles.collect()}


def test_goldens_of_a_recorded_profile(spark):
    """81 rows of which 63 and 69 have a value."""
    df = spark.range(81).select(
        F.col("id").alias("milestone_id"),
        F.when(F.col("id") < 63, "url").alias("source_url"),
        F.when(F.col("id") < 69, "text").alias("source_description"),
    )
    found = by_column(ops.profile(df, "milestone"))
    url, text, key = found["source_url"], found["source_description"], found["milestone_id"]
    assert (url.percentage_completeness, url.data_quality_completeness_result) == (Decimal("77.78"), "Bad")
    assert (text.percentage_completeness, text.data_quality_completeness_result) == (Decimal("85.19"), "Bad")
    assert (key.percentage_completeness, key.data_quality_completeness_result) == (Decimal("100.00"), "Good")
    assert key.sample_data == ["0", "1", "2", "3", "4"] and url.sample_data == ["url"]


def test_types_negatives_and_samples(spark):
    df = spark.createDataFrame(
        [(-1, Decimal("-0.01"), -0.5, False, None, [1], "b"), (2, Decimal("5"), 1.0, True, None, [-2], "a")],
        "i int, d decimal(15,2), f double, flag boolean, gone string, list array<int>, `odd name` string",
    )
    found = by_column(ops.profile(df, "t"))
    negative = {name: row.is_negative_values for name, row in found.items()}
    assert negative == {"i": True, "d": True, "f": True, "flag": False, "gone": False, "list": False, "odd name": False}
    assert found["gone"].sample_data == [] and found["gone"].percentage_completeness == 0
    assert found["d"].data_type == "decimal(15,2)" and found["d"].sample_data == ["-0.01", "5.00"]
    assert found["flag"].sample_data == ["false", "true"] and found["odd name"].sample_data == ["a", "b"]
    assert found["list"].sample_data == ["[-2]", "[1]"]


def test_empty_table(spark):
    rows = ops.profile(spark.createDataFrame([], "a int, b string"), "t").collect()
    assert [(r.n_rows, r.percentage_completeness, r.data_quality_completeness_result, r.sample_data) for r in rows] == [
        (0, Decimal("0.00"), "Bad", [])
    ] * 2


@pytest.mark.parametrize("distinct", [1, 3, 5, 6, 40, 20_000])
def test_samples_equal_brute_force(spark, distinct):
    df = spark.range(20_000).select(
        ((F.col("id") * 7919) % distinct).alias("n"), F.md5(((F.col("id") * 7919) % distinct).cast("string")).alias("t")
    )
    values = df.distinct().toPandas()
    found = by_column(ops.profile(df, "t"))
    assert found["n"].sample_data == [str(v) for v in sorted(set(values.n))[:5]]
    assert found["t"].sample_data == sorted(set(values.t))[:5]
    assert [r.value for r in ops.sample_values(df, "t", 3).collect()] == sorted(set(values.t))[:3]


def test_wide_table_in_groups(spark):
    df = spark.range(10).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(60)])
    rows = ops.profile(df, "wide").orderBy("ordinal").collect()
    assert [r.column_name for r in rows] == df.columns
    assert all(r.not_null_count == 10 for r in rows) and rows[59].sample_data[0] == "59"


def test_counts_of_halves_add_up(spark):
    df = spark.range(1000).select(F.col("id"), F.nullif(F.col("id") % 7, F.lit(3)).alias("v"))
    halves = [by_column(ops.profile(df.where(rule), "t", 0)) for rule in ("id < 400", "id >= 400")]
    whole = by_column(ops.profile(df, "t", 0))
    for name, row in whole.items():
        assert row.not_null_count == sum(half[name].not_null_count for half in halves)


def test_documents_are_kept_as_json(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, t string")
    documents = ops.profile_document(ops.profile_all({"b": df, "a": df.limit(1)}))
    for _ in range(2):
        ops.persist_profile(ops.tag_profile(documents, "owner", "public(db)"), str(tmp_path / "p"))
    saved = spark.read.parquet(str(tmp_path / "p")).orderBy("profile_id").collect()
    assert [(r.profile_id, r.table_name) for r in saved] == [(1, "a"), (2, "b"), (3, "a"), (4, "b")]
    row = saved[1]
    assert (row.n_rows, row.n_cols, row.schema, row.source, row.person_in_charge) == (2, 2, "-", "public(db)", "owner")
    assert json.loads(row.data_profile) == {
        "id": {"data_type": "int", "sample_data": ["1", "2"]},
        "t": {"data_type": "string", "sample_data": ["x"]},
    }
    assert json.loads(row.data_quality)["t"] == {
        "percentage_completeness": 50.0,
        "data_quality_completeness_result": "Bad",
        "is_negative_values": False,
    }
    assert row.created_at is not None


def test_text_files_are_parsed_once(spark, tmp_path, monkeypatch):
    module = importlib.import_module("asterism.operators.profile")

    (tmp_path / "a.csv").write_text("id,note\n1,x\n2,\n3,y\n")
    df = spark.read.option("header", True).csv(str(tmp_path / "a.csv"))
    written = []
    materialize = module.materialize
    monkeypatch.setattr(module, "materialize", lambda rows, label: written.append(label) or materialize(rows, label))
    found = {r.column_name: r for r in module.profile(df, "t").collect()}
    assert written == ["profiled"] and found["note"].sample_data == ["x", "y"] and found["note"].not_null_count == 2
    module.profile(spark.range(5), "t").collect()
    assert written == ["profiled"]


def test_one_failing_table_leaves_the_others(spark, tmp_path):
    from asterism.operators import persist_profiles

    broken = spark.range(3).selectExpr("raise_error('no such disk') AS x")
    failed = persist_profiles({"good": spark.range(3).toDF("x"), "broken": broken, "other": spark.range(2).toDF("y")}, str(tmp_path / "p"), "me")
    assert list(failed) == ["broken"] and "no such disk" in failed["broken"]
    assert {r.table_name for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {"good", "other"}


def test_names_with_dots_and_backticks(spark):
    from asterism.functions import clean_newlines
    from asterism.operators import profile, sample_values

    df = spark.createDataFrame([("a\nb", 1)], ["x.y", "z`w"])
    assert clean_newlines(df).collect()[0][0] == "a b"
    assert {r.column_name: r.sample_data for r in profile(df, "t").collect()} == {"x.y": ["a\nb"], "z`w": ["1"]}
    assert sample_values(df, "z`w").collect()[0][0] == "1"
