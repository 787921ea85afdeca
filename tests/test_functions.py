import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from asterism import functions as fn
from asterism.functions.cleaning import ANY_LINE_BREAK


def one(df):
    return tuple(df.first())


def test_clean_newlines_keeps_names_types_and_other_columns(spark):
    df = spark.createDataFrame([("a\nb\r\nc", 1, None)], "`a b` string, n int, t string")
    assert one(fn.clean_newlines(df)) == ("a b\r c", 1, None)
    assert one(fn.clean_newlines(df, ANY_LINE_BREAK)) == ("a b c", 1, None)
    assert fn.clean_newlines(df).dtypes == df.dtypes


def test_clean_newlines_nested_at_every_depth(spark):
    schema = "s struct<a:string,l:array<struct<t:string,n:int>>>, m map<string,array<string>>, e array<string>"
    df = spark.createDataFrame([((("x\ny"), [("p\nq", 1), None]), {"k\n": ["v\nw", None]}, None), (None, None, [])], schema)
    cleaned = fn.clean_newlines_nested(df)
    assert cleaned.dtypes == df.dtypes
    first, second = cleaned.collect()
    assert first.s.a == "x y" and first.s.l[0].t == "p q" and first.s.l[1] is None
    assert first.m == {"k\n": ["v w", None]} and first.e is None
    assert second.s is None and second.m is None and second.e == []


@pytest.mark.parametrize(
    "text, day",
    [
        ("2008-06-18", datetime.date(2008, 6, 18)),
        ("2008-06-18 08:14:06.000", datetime.date(2008, 6, 18)),
        ("2008-06-18T08:14:06", datetime.date(2008, 6, 18)),
        ("2008", None),
        ("2008-06", None),
        ("2008-13-01", None),
        ("2008-02-30", None),
        ("18.06.2008", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, day):
    df = spark.createDataFrame([(text,)], "s string")
    assert one(df.select(fn.parse_date("s"))) == (day,)


@pytest.mark.parametrize("text, flag", [("True", True), ("False", False), ("abc", None), (None, None)])
def test_to_bool(spark, text, flag):
    df = spark.createDataFrame([(text,)], "s string")
    assert one(df.select(fn.to_bool("s"))) == (flag,)


def test_casts_of_unreadable_text_are_null(spark):
    df = spark.createDataFrame([("12x",)], "s string")
    assert one(df.select(fn.to_int("s"), fn.to_decimal("s"), fn.to_ts("s"))) == (None, None, None)


def test_decimals_keep_cents_of_large_amounts(spark):
    df = spark.createDataFrame([("104000000001.23",)], "s string")
    assert one(df.select(fn.to_decimal("s"))) == (Decimal("104000000001.23"),)


@pytest.mark.parametrize(
    "part, whole, percent, label",
    [
        (63, 81, "77.78", "Bad"),
        (69, 81, "85.19", "Bad"),
        (90, 100, "90.00", "Bad"),
        (90_004, 100_000, "90.00", "Good"),
        (100, 100, "100.00", "Good"),
        (0, 0, "0.00", "Bad"),
        (0, 5, "0.00", "Bad"),
    ],
)
def test_percentage_and_label(spark, part, whole, percent, label):
    df = spark.createDataFrame([(part, whole)], "p bigint, w bigint")
    result = df.select(fn.pct(F.col("p"), F.col("w")), fn.quality_label(F.col("p"), F.col("w")))
    assert one(result) == (Decimal(percent), label)


def test_day_before(spark):
    df = spark.createDataFrame([(datetime.date(2024, 3, 1),)], "d date")
    leap = datetime.date(2024, 2, 29)
    dates = df.select(fn.day_before(F.col("d")), fn.day_before("2024-03-01"), fn.day_before(datetime.date(2024, 3, 1)))
    assert one(dates) == (leap, leap, leap)


@pytest.mark.parametrize("spec", ["[a, b]", "['a','b']", ["a", "b"]])
def test_parse_keys(spec):
    assert fn.parse_keys(spec) == ["a", "b"]


def test_parse_keys_single_and_bad():
    assert fn.parse_keys("id") == ["id"]
    with pytest.raises(ValueError):
        fn.parse_keys("[a,]")


def test_type_name(spark):
    df = spark.createDataFrame([], "a decimal(15,2), b timestamp_ntz")
    assert [fn.type_name(df, name) for name in df.columns] == ["decimal(15,2)", "timestamp_ntz"]


def test_documents(spark):
    df = spark.createDataFrame([("x", 1)], "s string, n int")
    doc = fn.to_json_text(fn.json_doc(data_type="s", sample=F.array("n")))
    merged = fn.to_json_text(fn.merge_docs(F.create_map(F.lit("a"), "n"), F.create_map(F.lit("b"), "n")))
    assert one(df.select(doc, merged)) == ('{"data_type":"x","sample":[1]}', '{"a":1,"b":1}')
