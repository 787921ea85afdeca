import datetime

import pytest
from pyspark.sql import functions as F

from asterism import operators as ops
from asterism import sinks
from asterism.sinks import tables
from asterism.schemas import RUN_LOG, struct
from asterism.session import observed
from asterism.sources import read_csv_raw

SCHEMA = "id int, day string, a string, b string"


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "d1", "x", "p"), (2, "d1", "y", "q"), (3, "d2", "z", "r"), (None, "d2", "n", "s")], SCHEMA)


@pytest.fixture
def delta(spark):
    return spark.createDataFrame([(2, "d1", "Y", None), (4, "d3", "new", "t"), (None, "d2", "N", "s")], SCHEMA)


MERGED = [(1, "d1", "x", "p"), (2, "d1", "Y", None), (3, "d2", "z", "r"), (4, "d3", "new", "t"), (None, "d2", "N", "s")]


def test_upsert_whole_rows(base, delta, rows):
    once = sinks.upsert(base, delta, "id")
    assert rows(once) == MERGED
    assert rows(sinks.upsert(once, delta, "id")) == MERGED


def test_upsert_keeps_absent_columns_and_takes_nulls(base, delta, rows):
    merged = sinks.upsert(base, delta.select("a", "id").withColumn("a", F.nullif("a", F.lit("Y"))), ["id"])
    assert rows(merged) == [
        (1, "d1", "x", "p"),
        (2, "d1", None, "q"),
        (3, "d2", "z", "r"),
        (4, None, "new", None),
        (None, "d2", "N", "s"),
    ]


def test_upsert_composite_key_and_types(spark, rows):
    target = spark.createDataFrame([(1, "a", 1.5), (1, "b", 2.5)], "x int, y string, v double")
    source = spark.createDataFrame([("1", "b", "9"), ("1", "c", "3")], "x string, y string, v string")
    assert rows(sinks.upsert(target, source, "[x, y]")) == [(1, "a", 1.5), (1, "b", 9.0), (1, "c", 3.0)]


def test_upsert_refuses_unknown_columns(base):
    with pytest.raises(ValueError, match="extra"):
        sinks.upsert(base, base.withColumn("extra", F.lit(1)), "id")


def test_small_increment_does_not_move_the_target(spark, base, delta, tmp_path):
    delta.write.parquet(str(tmp_path / "delta"))
    landed = spark.read.parquet(str(tmp_path / "delta"))
    plan = sinks.upsert(base, landed, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_duplicate_keys_stop_an_upsert(spark, base, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(sinks.DuplicateKeys, match="not unique"):
        sinks.upsert_path(base.union(base), path, "id")
    assert sinks.read_table(spark, path) is None
    latest = sinks.dedupe_latest(base.union(base.withColumn("a", F.upper("a"))), "id", ["day", "a"])
    sinks.assert_unique(latest, "id")
    assert latest.count() == 4


@pytest.mark.parametrize("slice_by", [None, "day"])
def test_upsert_path(spark, base, delta, rows, tmp_path, slice_by):
    path = str(tmp_path / "t")
    assert rows(sinks.upsert_path(base, path, "id", slice_by)) == rows(base)
    assert rows(sinks.upsert_path(delta, path, "id", slice_by)) == MERGED
    assert rows(sinks.upsert_path(delta, path, "id", slice_by)) == MERGED
    assert sinks.latest_version(spark, path) == 2  # the third changed nothing
    sinks.drop_old_versions(spark, path, keep=1)
    assert rows(sinks.read_table(spark, path)) == MERGED


def test_only_touched_slices_are_written(spark, base, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_path(base.withColumn("day", F.nullif("day", F.lit("d2"))), path, "id", "day")
    change = spark.createDataFrame([(1, "d1", "changed", None)], SCHEMA)
    sinks.upsert_path(change, path, "id", "day")
    first, second = (tables._version(spark, path, n).slices for n in (1, 2))
    assert len(first) == 2 and sum(first[name] != second[name] for name in first) == 1
    assert {r.id: r.a for r in sinks.read_table(spark, path).collect()} == {1: "changed", 2: "y", 3: "z", None: "n"}


def test_slices_of_any_values(spark, rows, tmp_path):
    values = ["2024-01-01 10:00:00", "a/b=c%", "A/B=C%", "é ß", "", None, "x" * 300, "007", "__HIVE__"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    path = str(tmp_path / "t")
    sinks.upsert_path(df, path, "id", slice_by="v")
    assert rows(sinks.read_table(spark, path)) == rows(df)
    change = df.where("id % 2 = 0")
    assert rows(sinks.upsert_path(change, path, "id", slice_by="v")) == rows(df)
    assert sinks.latest_version(spark, path) == 1


def test_unfinished_version_is_not_seen(spark, base, rows, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        sinks.write_version(base, path)
        base.limit(1).write.parquet(f"{path}/data/abandoned/upsert_slice=all")
        (tmp_path / "t" / "versions" / "00000002.json").write_text('{"slice_by": nu')
        assert rows(sinks.read_table(spark, path)) == rows(base)
        assert sinks.write_version(base.limit(2), path) == 3
        assert sinks.read_table(spark, path).count() == 2
        sinks.upsert_path(base, path, "id")
        assert rows(sinks.read_table(spark, path)) == rows(base)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_second_writer_is_refused(spark, base, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.upsert_path(base, path, "id")
    write = tables._write

    def slow(*how):
        monkeypatch.setattr(tables, "_write", write)
        sinks.write_version(base.limit(1), path)
        return write(*how)

    monkeypatch.setattr(tables, "_write", slow)
    with pytest.raises(sinks.ConcurrentWrite):
        sinks.upsert_path(base.withColumn("a", F.lit("mine")), path, "id")
    assert rows(sinks.read_table(spark, path)) == rows(base.limit(1))


@pytest.mark.parametrize("first, then", [(None, "day"), ("day", None), ("day", "id"), ("day", "id % 2")])
def test_layouts_are_converted(spark, base, delta, rows, tmp_path, first, then):
    path = str(tmp_path / "t")
    sinks.upsert_path(base, path, "id", first)
    assert rows(sinks.upsert_path(delta, path, "id", then)) == MERGED
    assert tables.current_version(spark, path).slice_by == then
    assert tables.current_version(spark, path).n_rows == len(MERGED)


def test_moved_keys_leave_their_slice(spark, base, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_path(base, path, "id", "day")
    sinks.upsert_path(spark.createDataFrame([(1, "d9", "moved", None)], SCHEMA), path, "id", "day")
    found = sinks.read_table(spark, path).where("id = 1").collect()
    assert [(r.day, r.a) for r in found] == [("d9", "moved")]
    assert tables.current_version(spark, path).n_rows == base.count()


def test_unknown_columns_are_refused_in_new_slices_too(spark, base, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_path(base, path, "id", "day")
    more = spark.createDataFrame([(77, "d77", "x", None)], SCHEMA).withColumn("extra", F.lit(1))
    with pytest.raises(ValueError, match="extra"):
        sinks.upsert_path(more, path, "id", "day")
    sinks.upsert_path(more.select("id", "day"), path, "id", "day")
    assert sinks.read_table(spark, path).where("id = 77").first().a is None


def test_older_rows_do_not_replace_later_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    for values in ([(1, 10, "new")], [(1, 5, "stale"), (2, 5, "two")], [(1, 10, "same time")]):
        found = sinks.upsert_path(spark.createDataFrame(values, "id int, at int, v string"), path, "id", order="at")
    assert {r.id: r.v for r in found.collect()} == {1: "same time", 2: "two"}


def test_replacing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    kinds = "c string, d int, n int"
    sinks.upsert_path(spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 3), (None, 1, 4)], kinds), path, ["c", "d"], "d")
    affected = spark.createDataFrame([("a",), ("x",)], "c string")
    new = spark.createDataFrame([("a", 2, 20), ("a", 3, 30)], kinds)
    got = sinks.upsert_path(new, path, ["c", "d"], "d", replacing=affected)
    assert rows(got) == sorted([("a", 2, 20), ("a", 3, 30), ("b", 1, 3), (None, 1, 4)], key=repr)


def test_old_versions_go_with_their_data(spark, base, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        sinks.upsert_path(base.withColumn("a", F.lit(str(i))), path, "id")
    assert len(list((tmp_path / "t" / "versions").glob("*.json"))) == tables.KEPT_VERSIONS
    assert len(list((tmp_path / "t" / "data").iterdir())) == tables.KEPT_VERSIONS


def test_history_alias():
    assert sinks.target_name("funds_history") == "funds"
    assert sinks.target_name("history_funds") == "history_funds"


def test_csv_edges(spark, rows, tmp_path):
    values = [("semi;colon",), ('quo"te',), ("back\\slash",), ("\\",), (" blanks ",), ("comma,",), ("é,ß",)]
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(values)], "id int, t string")
    for sep in ";,":
        path = str(tmp_path / f"csv{ord(sep)}")
        sinks.write_csv(df, path, sep)
        assert rows(read_csv_raw(spark, path, sep, df.schema)) == rows(df)


def test_csv_empty_text_reads_as_null_and_times_keep_microseconds(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(1, "", at), (2, None, None)], "id int, t string, at timestamp_ntz")
    sinks.write_csv(df, str(tmp_path / "c"))
    found = {r.id: r for r in read_csv_raw(spark, str(tmp_path / "c"), ";", df.schema).collect()}
    assert found[1].t is None and found[2].t is None and found[1].at == at and found[2].at is None


def test_increments(spark, base, tmp_path):
    path = str(tmp_path / "inc")
    assert sinks.increment_path("x", "2024-03-01") == "x/ds=2024-02-29"
    assert sinks.read_increment(spark, path, "2024-03-01") is None
    for df in (base, base.limit(2)):
        sinks.write_increment(df, path, "2024-03-01")
    sinks.write_increment(base, path, "2024-03-02")
    assert sinks.read_increment(spark, path, "2024-03-01").count() == 2
    assert sinks.read_increment(spark, path, datetime.date(2024, 3, 2)).count() == 4


def test_ensure_and_append(spark, base, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.ensure_table(spark, path, base.schema).count() == 0
    sinks.append(base, path)
    assert sinks.ensure_table(spark, path, base.schema).count() == 4


def test_run_log(spark, base, tmp_path):
    path = str(tmp_path / "log")
    with sinks.logged(spark, path, "staging", "load", "db", "funds") as run:
        counted, seen = observed(base)
        counted.write.parquet(str(tmp_path / "funds"))
        run["n_rows"] = seen.get["n_rows"]
    with pytest.raises(RuntimeError):
        with sinks.logged(spark, path, "staging", "load", "db", "ipos"):
            raise RuntimeError("no connection")
    log = spark.read.parquet(path)
    assert log.schema.names == struct(RUN_LOG).names
    found = {r.table_name: r for r in log.collect()}
    assert found["funds"].status == "success" and found["funds"].n_rows == 4 and found["funds"].error_msg is None
    assert found["ipos"].status == "failed" and found["ipos"].error_msg == "no connection"
    assert found["funds"].id != found["ipos"].id and found["funds"].etl_date is not None


@pytest.fixture
def wide(spark):
    return spark.range(1000).selectExpr("cast(id as int) id", "concat('d', id % 7) day", "cast(id as string) a", "'b' b")


def files_of(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_upsert_into_buckets(spark, base, delta, rows, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.read_buckets(spark, path) is None
    assert sinks.upsert_buckets(base.limit(0), path, "id", 4) is None
    assert rows(sinks.upsert_buckets(base, path, "id", 4)) == rows(base)
    assert rows(sinks.upsert_buckets(delta, path, "id", 8)) == MERGED
    before = files_of(tmp_path)
    assert rows(sinks.upsert_buckets(delta, path, "id")) == MERGED
    assert files_of(tmp_path) == before
    part = spark.createDataFrame([("2", "only")], "id string, a string")
    assert {r.id: (r.a, r.b) for r in sinks.upsert_buckets(part, path, "id").collect()}[2] == ("only", None)
    with pytest.raises(ValueError, match="extra"):
        sinks.upsert_buckets(base.withColumn("extra", F.lit(1)), path, "id")
    with pytest.raises(sinks.DuplicateKeys):
        sinks.upsert_buckets(base.union(base), path, "id")


def test_five_rows_touch_their_buckets_only(spark, wide, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_buckets(wide, path, "id", 50)
    before = files_of(tmp_path)
    change = wide.where("id % 200 = 1").withColumn("a", F.lit("new"))
    found = sinks.upsert_buckets(change, path, "id")
    after = files_of(tmp_path)
    touched = {p.parent.name for p in set(before) ^ set(after)}
    assert 1 <= len(touched) <= 5
    assert found.count() == 1000 and found.where("a = 'new'").count() == 5
    numbers = [int(name.split("=")[1]) for name in touched]
    read = sinks.buckets_of(spark, path, numbers)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket_of_50" in plan
    assert {r[0].split("/")[-2] for r in read.select(F.input_file_name()).distinct().collect()} == touched


def test_a_run_that_dies_is_finished_by_the_next(spark, base, delta, rows, tmp_path, monkeypatch):
    from asterism.sinks import buckets

    path = str(tmp_path / "t")
    sinks.upsert_buckets(base, path, "id", 4)
    put = buckets._put_in_place

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(buckets, "_put_in_place", dies)
    with pytest.raises(RuntimeError):
        sinks.upsert_buckets(delta, path, "id")
    monkeypatch.setattr(buckets, "_put_in_place", put)
    # Half of the buckets gone, as a run would leave them that dies between deleting and renaming.
    for folder in list((tmp_path / "t").glob("bucket_of_4=*"))[:2]:
        name = folder.name
        if (tmp_path / "t.pending" / name).exists():
            folder.rename(tmp_path / f"was-{name}")
    assert rows(sinks.upsert_buckets(delta.limit(0), path, "id")) == MERGED
    (tmp_path / "t.pending").mkdir()
    (tmp_path / "t.pending" / "part").write_text("")
    assert rows(sinks.upsert_buckets(delta.limit(0), path, "id")) == MERGED


@pytest.mark.parametrize("fixed", [False, True])
def test_an_upsert_reads_the_slices_of_its_keys_only(spark, wide, tmp_path, monkeypatch, fixed):
    path = str(tmp_path / "t")
    sinks.upsert_path(wide, path, "id", "day")
    read, seen = tables.Version.read, []

    def noted(self, session, where, only=None):
        seen.append(only)
        return read(self, session, where, only)

    monkeypatch.setattr(tables.Version, "read", noted)
    change = wide.where("id = 3").withColumn("a", F.lit("new"))
    sinks.upsert_path(change, path, "id", "day", slices_fixed=fixed)
    # Whole reads are of the table as it is handed on, and of the keys unless slices are fixed.
    assert [only for only in seen if only is not None] and all(len(only) == 1 for only in seen if only is not None)


def test_an_upsert_writes_aside_what_changes_and_nothing_else(spark, tmp_path, monkeypatch):
    path, made = str(tmp_path / "t"), []
    aside = tables.materialize_at

    def counted(df, to):
        found = aside(df, to)
        made.append(found.count())
        return found

    monkeypatch.setattr(tables, "materialize_at", counted)
    rows = spark.range(100).selectExpr("id", "id % 4 AS day", "id AS v")
    sinks.upsert_into(rows, path, "id", "day", written=True, unique=True)
    assert not made
    sinks.upsert_into(rows, path, "id", "day", written=True, unique=True)
    assert made == [0]
    made.clear()
    sinks.upsert_into(rows.selectExpr("id", "day", "if(id < 7, -1, v) AS v"), path, "id", "day", written=True, unique=True)
    assert made == [7]
    assert sinks.read_table(spark, path).where("v = -1").count() == 7


def test_new_keys_are_numbered_after_those_of_the_table(spark, rows, tmp_path):
    def number(new, first):
        return ops.with_dense_id(new, "k", "sk", first, distinct=True)

    path = str(tmp_path / "t")
    for keys in ("bd", "abcd"):
        source = spark.createDataFrame([(k, len(keys)) for k in keys], "k string, v int")
        sinks.upsert_into(source, path, "k", "v", surrogate="sk", number=number)
    assert rows(sinks.read_table(spark, path), "k", "sk", "v") == [("a", 3, 4), ("b", 1, 4), ("c", 4, 4), ("d", 2, 4)]
    with pytest.raises(sinks.DuplicateKeys):
        twice = spark.createDataFrame([("x", 1), ("x", 1)], "k string, v int")
        sinks.upsert_into(twice, str(tmp_path / "other"), "k", surrogate="sk", number=number)


@pytest.fixture
def nothing_is_small(spark):
    """No table is broadcast, as if all were large."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("slice_by", [None, "day"])
def test_many_rows_are_compared_and_put_in_by_one_join(spark, base, delta, rows, tmp_path, slice_by, nothing_is_small, monkeypatch):
    monkeypatch.setattr(tables, "upsert", None)  # which would move the table again
    path = str(tmp_path / "t")
    sinks.upsert_path(base, path, "id", slice_by)
    more = delta.union(base.where("id = 1"))
    assert rows(sinks.upsert_path(more, path, "id", slice_by)) == MERGED
    version = tables.latest_version(spark, path)
    sinks.upsert_path(more, path, "id", slice_by)
    assert tables.latest_version(spark, path) == version
    # A row that moves to another slice leaves the old one; columns that are not supplied stay.
    moved = more.withColumn("day", F.lit("d9")).drop("b")
    assert rows(sinks.upsert_path(moved, path, "id", slice_by)) == sorted(
        [(r[0], "d9" if r[0] != 3 else r[1], *r[2:]) for r in MERGED], key=repr)
    assert tables.current_version(spark, path).n_rows == 5
    # A row does not replace a later one.
    older = more.withColumns({"day": F.lit("d0"), "a": F.lit("older")})
    sinks.upsert_path(older, path, "id", slice_by, order="day")
    assert sinks.read_table(spark, path).where("a = 'older'").isEmpty()


def test_rows_of_files_are_written_to_their_slices_where_they_are_read(spark, tmp_path, monkeypatch):
    spark.range(1000).selectExpr("id", "id % 3 AS day").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    assert not tables._slices_in_place(df, "day")
    monkeypatch.setattr(tables, "LEAST_FILE_BYTES", 100)
    assert tables._slices_in_place(df, "day")
    assert not tables._slices_in_place(df.repartition(3), "day")
    assert not tables._slices_in_place(df, "id")
    sinks.upsert_path(df, str(tmp_path / "t"), "id", "day")
    found = sinks.read_table(spark, str(tmp_path / "t"))
    assert (found.count(), found.select("day").distinct().count()) == (1000, 3)
