from asterism import sinks
from asterism.sinks import buckets, tables
from asterism.streaming import increments, upsert_stream

SCHEMA = "id int, at int, v string"


def test_each_file_is_taken_once_and_the_last_row_wins(spark, rows, tmp_path):
    landing, path, checkpoint = (str(tmp_path / name) for name in ("landing", "table", "checkpoint"))

    def drop(*values):
        spark.createDataFrame(list(values), SCHEMA).coalesce(1).write.mode("append").parquet(landing)

    def run(files=1000):
        schema = spark.createDataFrame([], SCHEMA).schema
        upsert_stream(spark, landing, schema, path, ["id"], ["at"], checkpoint, "id % 4", files).awaitTermination()
        return rows(sinks.read_table(spark, path))

    drop((1, 1, "a"), (2, 1, "b"), (2, 2, "B"))
    assert run() == [(1, 1, "a"), (2, 2, "B")]
    assert run() == [(1, 1, "a"), (2, 2, "B")] and sinks.latest_version(spark, path) == 1
    drop((2, 3, "late"), (3, 1, "c"))
    assert run() == [(1, 1, "a"), (2, 3, "late"), (3, 1, "c")] and sinks.latest_version(spark, path) == 2


def test_order_wins_over_the_batch(spark, rows, tmp_path):
    tables = []
    for files in (1, 1000):
        landing, path, checkpoint = (str(tmp_path / f"{name}{files}") for name in ("landing", "table", "checkpoint"))
        for values in ([(1, 10, "new"), (2, 1, "b")], [(1, 5, "stale"), (2, 2, "B")]):
            spark.createDataFrame(values, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        schema = spark.createDataFrame([], SCHEMA).schema
        upsert_stream(spark, landing, schema, path, ["id"], ["at"], checkpoint, "id", files).awaitTermination()
        tables.append(rows(sinks.read_table(spark, path)))
    assert tables == [[(1, 10, "new"), (2, 2, "B")]] * 2


def test_rows_that_the_order_leaves_equal(spark, rows, tmp_path):
    """One table for every order of files and size of batches, in both layouts."""
    files = [[(1, 7, "a"), (2, 1, None)], [(1, 7, "b"), (2, 1, "x")], [(1, 7, "c"), (1, 6, "z"), (3, None, "n")]]
    found = set()
    for n, (order, per_batch, slice_by) in enumerate([((0, 1, 2), 1, None), ((2, 1, 0), 1, None), ((1, 2, 0), 2, None), ((0, 2, 1), 3, None), ((2, 0, 1), 1, "id % 2")]):
        landing, path, checkpoint = (str(tmp_path / f"{name}{n}") for name in ("landing", "table", "checkpoint"))
        for i in order:
            spark.createDataFrame(files[i], SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        schema = spark.createDataFrame([], SCHEMA).schema
        upsert_stream(spark, landing, schema, path, ["id"], ["at"], checkpoint, slice_by, per_batch, buckets=3).awaitTermination()
        found.add(tuple(rows(sinks.read_table(spark, path) if slice_by else sinks.read_buckets(spark, path))))
    assert len(found) == 1 and len(found.pop()) == 3


def test_a_batch_lists_the_slices_of_the_table_at_most_once(spark, tmp_path, monkeypatch):
    reads = []
    whole = tables.Version.read
    monkeypatch.setattr(tables.Version, "read", lambda self, *args, **how: reads.append(1) or whole(self, *args, **how))
    rows = spark.range(200).selectExpr("id", "id AS at")
    for n, drop in enumerate((rows, rows.withColumn("at", rows["at"] - 1))):
        drop.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        upsert_stream(
            spark, str(tmp_path / "in"), rows.schema, str(tmp_path / "table"), ["id"], ["at"], str(tmp_path / "log"), "id div 10"
        ).awaitTermination()
        assert len(reads) == n
    found = sinks.read_table(spark, str(tmp_path / "table"))
    assert found.count() == tables.current_version(spark, str(tmp_path / "table")).n_rows == 200
    assert found.where("id = at").count() == 200


def test_a_batch_is_compared_with_its_buckets_once(spark, tmp_path, monkeypatch):
    made = []
    aside = buckets.materialize_at
    monkeypatch.setattr(buckets, "materialize_at", lambda df, to: made.append(to.rsplit("/", 1)[1]) or aside(df, to))
    rows = spark.range(200).selectExpr("id", "id AS at")
    for drop in (rows, rows.withColumn("at", rows["at"] + 1)):
        drop.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        upsert_stream(
            spark, str(tmp_path / "in"), rows.schema, str(tmp_path / "table"), ["id"], ["at"], str(tmp_path / "log"), buckets=4
        ).awaitTermination()
    assert made == ["changes"]
    assert sinks.read_buckets(spark, str(tmp_path / "table")).where("at = id + 1").count() == 200


def test_a_batch_and_its_buckets_meet_in_one_aggregate(spark, rows, tmp_path, monkeypatch):
    """With a frequent key and without one: nothing is written or joined before, and only buckets that change are put in place."""
    def fail(*_, **__):
        raise AssertionError("written or compared apart")

    monkeypatch.setattr(increments, "materialize_at", fail)
    monkeypatch.setattr(buckets, "changed_rows", fail)
    hinted = []
    reduced = buckets.dedupe_latest
    monkeypatch.setattr(buckets, "dedupe_latest", lambda df, *how: hinted.append("rebalance" in df._jdf.queryExecution().logical().toString().lower()) or reduced(df, *how))
    path = str(tmp_path / "table")
    drops = [("id", "id", "'a'"), ("id", "id - 1", "'stale'"), ("if(id < 300, 7, id)", "id + 1000", "'b'"), ("id div 2", "id + 1", "cast(null as string)")]
    for key, at, v in drops:
        drop = spark.range(400).selectExpr(f"cast({key} as int) id", f"cast({at} as int) at", f"{v} v")
        drop.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        files = set(spark.read.parquet(path).inputFiles()) if hinted else set()
        upsert_stream(spark, str(tmp_path / "in"), drop.schema, path, ["id"], ["at"], str(tmp_path / "log"), buckets=4).awaitTermination()
        same = files == set(spark.read.parquet(path).inputFiles())
        assert same == (v == "'stale'")
    assert hinted == [True, True, False, True]
    found = {row[0]: row[1:] for row in rows(sinks.read_buckets(spark, path))}
    later = {i: (2 * i + 2, None) for i in range(200)}
    assert found == {i: (i, "a") for i in range(400)} | later | {i: (i + 1000, "b") for i in range(300, 400)} | {7: (1299, "b")}


def test_columns_that_a_stream_lacks_keep_their_values(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    sinks.upsert_buckets(spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], SCHEMA), path, ["id"], 4)
    drop = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (3, 1)], "id int, at int")
    drop.coalesce(1).write.parquet(str(tmp_path / "in"))
    upsert_stream(spark, str(tmp_path / "in"), drop.schema, path, ["id"], ["at"], str(tmp_path / "log")).awaitTermination()
    assert rows(sinks.read_buckets(spark, path)) == [(1, 3, "a"), (2, 5, "b"), (3, 1, None)]
