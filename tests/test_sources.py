import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from asterism import sources
from asterism.schemas import STAGING, struct


def test_missing_path_is_none_and_other_errors_are_raised(spark, tmp_path):
    assert sources.read_or_none(lambda: spark.read.parquet(str(tmp_path / "absent"))) is None
    with pytest.raises(AnalysisException):
        sources.read_or_none(lambda: spark.range(1).select("absent"))


def test_whole_file_payload(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '[\n {"milestone_id": 1, "milestone_at": "2008-06-09", "object_id": "c:12",\n'
        '  "created_at": "2008-06-18 08:14:06.000", "description": "two\\nlines"},\n'
        ' {"milestone_id": 3, "milestone_code": "other"}\n]'
    )
    schema = struct(STAGING["milestones"])
    for field in schema.fields:
        field.nullable = True
    schema["created_at"].dataType = struct("a string").fields[0].dataType
    found = {row.milestone_id: row for row in sources.read_json_records(spark, str(tmp_path), schema, whole_file=True).collect()}
    assert found[1].description == "two\nlines" and found[1].milestone_at == datetime.date(2008, 6, 9)
    assert found[1].created_at == "2008-06-18 08:14:06.000"
    assert found[3].milestone_code == "other" and found[3].object_id is None


def test_increment_takes_the_whole_day_and_nothing_else(spark, staged):
    at = ["2024-05-09 23:59:59", "2024-05-10 00:00:00", "2024-05-10 23:59:59", "2024-05-11 00:00:00"]
    rows = [dict(investment_id=i, created_at=datetime.datetime.fromisoformat(t)) for i, t in enumerate(at)]
    rows.append(dict(investment_id=9))
    found = sources.extract_increment(staged("investments", *rows), "created_at", "2024-05-11")
    assert sorted(row.investment_id for row in found.collect()) == [1, 2]


def test_increment_of_text_timestamps(spark):
    df = spark.createDataFrame([("2007-05-25 07:03:54.000",), ("2007-05-26",), ("x",)], "created_at string")
    assert sources.extract_increment(df, "created_at", "2007-05-26").count() == 1


def test_increment_filter_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = sources.extract_increment(orders, "o_orderdate", "1998-06-16")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_date_range_includes_both_ends(spark):
    df = spark.createDataFrame([("2008-06-08",), ("2008-06-09",), ("2008-06-29",), ("2008-06-30",)], "d string")
    df = df.withColumn("d", F.to_date("d"))
    assert sources.date_range(df, "d", "2008-06-09", "2008-06-29").count() == 2


def test_empty(spark):
    none, some = spark.range(0), spark.range(1)
    assert sources.is_empty(none) and not sources.is_empty(some)
    assert sources.all_empty(none, none) and not sources.all_empty(none, some)


def test_catalog_tables_leave_out_views_and_system_schemas(spark, tmp_path):
    spark.sql("CREATE DATABASE pg_catalog")
    spark.sql(f"CREATE TABLE pg_catalog.t (a int) USING parquet LOCATION '{tmp_path}/t'")
    spark.sql(f"CREATE TABLE funds (a int) USING parquet LOCATION '{tmp_path}/funds'")
    spark.range(1).createOrReplaceTempView("funds_view")
    try:
        assert sources.list_catalog_tables(spark) == ["default.funds"]
    finally:
        spark.sql("DROP TABLE funds")
        spark.sql("DROP DATABASE pg_catalog CASCADE")


def test_listed_files(spark):
    listed = sources.list_tables(spark, "/root/testdata/sf0.001")
    assert len(listed) == 14 and listed["orders"].endswith("/orders.parquet")


def test_jdbc_query_projects_and_filters_in_the_database():
    options = sources.jdbc_options("staging.funding_rounds", ["funding_round_id", "raised_amount_usd"], "created_at >= '2024-01-01'")
    assert options["dbtable"] == (
        "(SELECT funding_round_id, raised_amount_usd FROM staging.funding_rounds WHERE created_at >= '2024-01-01') data"
    )
    assert sources.jdbc_options("t")["dbtable"] == "(SELECT * FROM t) data"


def test_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,price,day,name\n1,2.5,2024-01-01,x\n2,,2024-01-02,y\n")
    found = sources.read_csv_inferred(spark, str(tmp_path))
    assert found.dtypes == [("id", "int"), ("price", "double"), ("day", "date"), ("name", "string")]
    assert sources.read_csv_raw(spark, str(tmp_path)).dtypes == [(n, "string") for n in found.columns]


class Reader:
    """Stands in for ``spark.read``: keeps the options, and answers the question for the range."""

    def __init__(self, bounds, given=None):
        self.bounds, self.given = bounds, given or {}

    def format(self, _):
        return self

    def option(self, name, value):
        return Reader(self.bounds, self.given | {name: value})

    def options(self, **more):
        return Reader(self.bounds, self.given | more)

    def load(self):
        return self

    def first(self):
        return self.bounds


@pytest.mark.parametrize("bounds, parts", [((1, 900), "4"), ((None, None), None)])
def test_jdbc_strides_cover_the_range(spark, bounds, parts):
    class Session:
        read = Reader(bounds)

    read = sources.read_jdbc(Session, "jdbc:x", "funds", partition_col="id", n=4, properties={"user": "u"})
    assert read.given["dbtable"] == "(SELECT * FROM funds) data" and read.given["user"] == "u"
    assert read.given.get("numPartitions") == parts
    assert read.given.get("lowerBound") == ("1" if parts else None) and read.given.get("upperBound") == ("900" if parts else None)


def test_range_is_computed_by_the_database():
    assert sources.jdbc.range_query("(SELECT * FROM t) data", "id") == (
        "(SELECT MIN(id) AS low, MAX(id) AS high FROM (SELECT * FROM t) data) bounds"
    )


def test_csv_records_over_several_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"two\nlines"\n2,one\n')
    found = sources.read_csv_raw(spark, str(tmp_path), multi_line=True, malformed=True)
    assert [(r.id, r.note, r._malformed) for r in found.collect()] == [("1", "two\nlines", None), ("2", "one", None)]


@pytest.mark.parametrize("values", [[1, 1, 1, 1, 2, 9], [5], [None, None], [], ["a", "b'c", None, "z"], [1.5, -2.25, 0.0]])
def test_strides_are_disjoint_and_cover(spark, values):
    kind = "string" if any(isinstance(v, str) for v in values) else "double"
    df = spark.createDataFrame([(v if v is None or kind == "string" else float(v),) for v in values], f"x {kind}")
    bounds = sources.stride_bounds(df, "x", 4) if kind == "double" else ["b'c", "a", "b'c"]
    for predicates in (sources.stride_predicates("x", bounds), sources.hash_predicates("hash(x)" if kind == "double" else "crc32(x)", 3)):
        met = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
        assert [row[0] for row in df.select(met).collect()] == [1] * len(values)


def test_a_value_with_most_rows_has_a_stride_of_its_own(spark):
    df = spark.createDataFrame([(7,)] * 900 + [(i,) for i in range(100)], "x int")
    predicates = sources.stride_predicates("x", sources.stride_bounds(df, "x", 10))
    assert "x >= 7 AND x < " in " ".join(predicates) or predicates[-1] == "x >= 7"
    assert sources.quantile_query("t", "x", 3).count("PERCENTILE_DISC") == 2


def test_snapshot_diff(spark, rows):
    kinds = "a int, b string, v double, m map<string,int>"
    staged = spark.createDataFrame([(1, "x", 1.0, None), (2, None, None, {"k": 1}), (3, "x", 3.0, None), (None, None, 4.0, None)], kinds)
    source = spark.createDataFrame([("1", "x", 1.0, "n"), ("2", None, 0.0, "n"), (None, None, 4.0, "n"), ("5", "new", None, "n")], "a string, b string, v double, other string")
    found = sources.snapshot_diff(source, staged.drop("m"), ["a", "b"])
    assert found.columns == ["a", "b", "v", "other", "change"]
    assert rows(found) == sorted([("2", None, 0.0, "n", "update"), ("5", "new", None, "n", "insert"), ("3", "x", None, None, "delete")], key=repr)
    assert rows(sources.snapshot_diff(staged, staged, "a")) == []
    # A null and an empty text, or values that change places, are changes.
    one, two = [spark.createDataFrame([(1, *v)], "k int, x string, y string") for v in ((None, ""), ("", None))]
    assert rows(sources.snapshot_diff(one, two, "k")) == [(1, None, "", "update")]
    assert {r.change for r in sources.snapshot_diff(staged, None, "a").collect()} == {"insert"}


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64b")
    yield
    spark.conf.set(name, before)


CSV = [("1", "plain"), ("2", "two\nlines"), ("3", 'say ""hi""\nand, go\n\non'), ("4", "x" * 300 + "\n" + "y" * 300), ("5", '""'), ("6", "last")]


def test_csv_records_over_many_splits(spark, rows, tmp_path, small_splits):
    text = "id,note\n" + "".join(f'{i},"{note}"\n' for i, note in CSV) + "\n7,\n8"
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text('id,note\n9,"never closed\n10,x')
    found = sources.read_csv_raw(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert found.rdd.getNumPartitions() > 5
    whole = spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path / "a.csv"))
    assert rows(found) == rows(whole) and found.columns == whole.columns
    assert {r.id: r.note for r in found.collect()}["3"] == 'say "hi"\nand, go\n\non'
    both = sources.read_csv_raw(spark, str(tmp_path), multi_line=True, malformed=True)
    assert both.count() == len(CSV) + 3
    typed = sources.read_csv_raw(spark, str(tmp_path / "a.csv"), schema=struct("id int, note string"), multi_line=True, malformed=True)
    assert {r.id for r in typed.where("_malformed IS NULL").collect()} == {1, 2, 3, 4, 5, 6, 7}
    assert [r._malformed for r in typed.where("_malformed IS NOT NULL").collect()] == ["8"]


def test_json_records_over_many_splits(spark, rows, tmp_path, small_splits):
    import json

    records = [{"id": i, "note": note, "deep": {"list": [1, 2], "own": {"a": "}]"}, "text": '{"['}} for i, note in enumerate(["a", 'b"}', "c\\", "d" * 500, "", "e\n[{"])]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=2))
    (tmp_path / "b.json").write_text(json.dumps(records))
    (tmp_path / "c.json").write_text("\n" + json.dumps(records[3] | {"id": 77}, indent=1))
    (tmp_path / "d.json").write_text("[]")
    schema = struct("id int, note string, deep struct<list: array<int>, own: struct<a: string>, text: string>")
    found = sources.read_json_records(spark, str(tmp_path), schema, whole_file=True)
    whole = spark.read.schema(schema).json(str(tmp_path), multiLine=True)
    assert rows(found) == rows(whole) and found.count() == 2 * len(records) + 1
    assert sources.read_json_records(spark, str(tmp_path / "d.json"), schema, whole_file=True).count() == 0


def test_a_payload_that_breaks_off(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"id": 1},\n{"id": \n')
    found = sources.read_json_records(spark, str(tmp_path), struct("id int"), whole_file=True, malformed=True).collect()
    assert [(r.id, r._malformed is None) for r in sorted(found, key=lambda r: r.id or 9)] == [(1, True), (None, False)]
