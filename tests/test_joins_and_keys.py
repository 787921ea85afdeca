import datetime
import importlib

import pytest
from pyspark.sql import functions as F

from asterism import operators as ops
from asterism import storage
from asterism.operators.mapping import VIOLATIONS
from asterism.plans import calendar, pending
from asterism.plans.facts import investment_rows
from asterism.session import materialize, scratch_path
from asterism.sinks import tables
from asterism.sinks.tables import changed_rows
from asterism.sinks.upsert import upsert


@pytest.fixture
def skewed(spark):
    """A third of the rows have one key, a third have none, some keys are unknown."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 3 == 1, n % 500)
    return spark.range(9000).select(n.alias("row"), key.cast("bigint").alias("k"), (n % 10).alias("v"))


@pytest.mark.parametrize("parts", [2, 8, 2000])
def test_lookup_with_hot_keys_equals_plain_join(spark, skewed, parts):
    dim = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("sk"), F.lit("x").alias("name"))
    dim = dim.withColumn("name", F.when(F.col("k") != 7, F.col("name")))
    plain = ops.left_lookup(skewed, dim, "k", small=True)
    split = ops.left_lookup(skewed, dim, "k", small=False, parts=parts)
    names = ["row", "k", "v", "sk", "name"]
    assert split.select(names).exceptAll(plain.select(names)).isEmpty()
    assert plain.select(names).exceptAll(split.select(names)).isEmpty()
    assert split.count() == 9000


def test_lookup_spreads_hot_and_missing_keys(spark, skewed):
    """No partition of the join's shuffle gets more than its share by far."""
    dim = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("sk"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = ops.left_lookup(skewed, dim, "k", small=False)
        sizes = [row[1] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 9000 and max(sizes) < 3000


def test_frequent_keys(spark, skewed):
    found = ops.frequent_keys(skewed, ["k"], 8)
    hot = spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    assert {key for key, _ in found} == {hot, None} and all(pieces >= 2 for _, pieces in found)
    even = spark.range(9000).select(F.col("id").alias("k"))
    assert ops.frequent_keys(even, ["k"], 8) == [] and ops.frequent_keys(even.limit(0), ["k"], 8) == []


def test_lookup_without_skew_is_a_plain_join(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    dim = df.withColumn("sk", F.col("k") * 2)
    assert "_salt" not in ops.left_lookup(df, dim, "k", small=False)._jdf.queryExecution().toString()


def test_lookup_on_two_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "x int, y string")
    dim = spark.createDataFrame([(1, "a", 10), (2, "c", 20)], "x int, y string, sk int")
    found = ops.left_lookup(df, dim, ["x", "y"], small=False)
    assert sorted(map(tuple, found.select("x", "sk").collect()), key=repr) == [(1, 10), (1, None), (2, None)]


def test_lookup_key_renames(spark):
    df = spark.createDataFrame([("c:1",), ("c:9",), (None,)], "company string")
    dim = spark.createDataFrame([(5, "c:1")], "company_id int, company_nk string")
    keyed = ops.lookup_key(df, dim, "company", "company_nk", "company_id", out="buyer_id")
    assert sorted(map(tuple, keyed.collect()), key=repr) == [("c:1", 5), ("c:9", None), (None, None)]


def test_date_id_of_midnight_text_and_unknown_days(spark):
    df = spark.createDataFrame(
        [("2008-06-18 23:59:59",), ("2008-06-19",), ("2050-01-01",), ("soon",), (None,)], "at string"
    )
    days = calendar(spark, datetime.date(2008, 1, 1), datetime.date(2008, 12, 31))
    found = ops.with_date_id(df, "at", days)
    assert found.columns == ["at", "date_id"]
    assert {row.at: row.date_id for row in found.collect()} == {
        "2008-06-18 23:59:59": 20080618,
        "2008-06-19": 20080619,
        "2050-01-01": None,
        "soon": None,
        None: None,
    }


def test_pick_one_keeps_nulls_and_column_order(spark):
    df = spark.createDataFrame([(3, "c:1", None), (1, "c:1", "x"), (2, None, "y")], "office int, nk string, city string")
    assert sorted(map(tuple, ops.pick_one(df, "nk", ["office"]).collect())) == [(1, "c:1", "x"), (2, None, "y")]
    assert (3, "c:1", None) in map(tuple, ops.pick_one(df, "nk", ["office"], last=True).collect())


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_dense_ids_do_not_depend_on_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(1000).select(F.format_string("n%04d", F.col("id") * 7919 % 1000).alias("nk"))
        found = ops.with_dense_id(df.repartition(5), "nk", "id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {row.nk: row.id for row in found} == {f"n{i:04d}": i + 1 for i in range(1000)}


def test_dense_ids_of_many_equal_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    ids = [row.id for row in ops.with_dense_id(df, "k", "id", unique=False).collect()]
    assert sorted(ids) == list(range(1, 3001))


def test_dense_ids_of_nothing(spark):
    assert ops.with_dense_id(spark.range(0), "id", "sk").count() == 0


def test_assign_ids_keeps_known_and_continues(spark):
    first = ops.assign_ids(None, spark.createDataFrame([("b",), ("d",)], "nk string"), "nk", "sk")
    again = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "nk string")
    second = ops.assign_ids(first, again, "nk", "sk")
    assert {row.nk: row.sk for row in second.collect()} == {"b": 1, None: 3, "a": 4, "c": 5}
    third = ops.assign_ids(second, again, "nk", "sk")
    assert sorted(map(tuple, third.collect()), key=repr) == sorted(map(tuple, second.collect()), key=repr)


@pytest.mark.parametrize("small", [True, False])
def test_lookup_of_several_roles(spark, rows, small, monkeypatch):
    module = importlib.import_module("asterism.operators.joins")
    lookup, calls = module.left_lookup, []
    monkeypatch.setattr(module, "left_lookup", lambda df, *how, **named: calls.append(df.columns) or lookup(df, *how, **named))
    df = spark.createDataFrame([(1, "a", "b", "x"), (2, "a", None, "y"), (3, None, None, "z"), (4, "q", "a", "w")], "id int, one string, two string, note string")
    dim = spark.createDataFrame([("a", 10), ("b", 20), (None, 99)], "nk string, sk int")
    found = ops.lookup_roles(df, dim, {"one": "one_id", "two": "two_id"}, "nk", "sk", "id", small=small)
    assert found.columns == ["id", "one", "two", "note", "one_id", "two_id"]
    assert rows(found, "id", "note", "one_id", "two_id") == [(1, "x", 10, 20), (2, "y", 10, None), (3, "z", None, None), (4, "w", None, 10)]
    # One lookup, to which a role brings its key and the row's.
    assert small or calls == [["_row_id", "_role", "_nk"]]


@pytest.fixture
def compressed(spark):
    """400,000 rows in far fewer bytes of files than they take in memory: Spark would broadcast them."""
    df = materialize(spark.range(400_000).select(F.concat(F.lit("c:"), F.col("id")).alias("k"), F.col("id").alias("sk")).orderBy("sk"), "compressed")
    assert storage.estimated_bytes(df) <= storage.broadcast_limit(spark)
    return df


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_table_in_small_files_is_not_broadcast(spark, compressed):
    rows = compressed.select(F.col("k"), F.lit(1).alias("v"))
    assert "BroadcastHashJoin" not in plan(ops.left_lookup(rows, compressed, "k"))
    assert "BroadcastHashJoin" not in plan(rows.join(storage.kept_back(compressed), "k", "left_semi"))
    a, b = storage.sides(rows, compressed)
    assert "BroadcastHashJoin" not in plan(a.join(b, "k"))
    few = compressed.where("sk < 1000")
    assert "BroadcastHashJoin" in plan(ops.left_lookup(rows, few, "k"))
    for a, b in (storage.sides(few, compressed), storage.sides(compressed, few)):
        assert "BroadcastHashJoin" in plan(a.join(b, "k"))
    found = ops.left_lookup(rows, compressed, "k").agg(F.count("sk"), F.sum("sk")).first()
    assert tuple(found) == (400_000, 399_999 * 200_000)


def test_amounts_of_many_rounds_are_not_broadcast(spark, compressed, staged):
    dim = compressed.select(F.col("sk").alias("funding_round_id"), F.col("k").alias("funding_round_nk"))
    empty = spark.createDataFrame([], "nk string, id long")
    rounds = compressed.select(F.col("k").alias("funding_round_id"), F.lit(1).alias("raised_amount_usd"))
    investments = staged("investments", {"investment_id": 1})
    built = investment_rows(
        investments, rounds, calendar(spark), empty.toDF("company_nk", "company_id"), empty.toDF("investor_nk", "investor_id"), dim
    )
    assert "BroadcastHashJoin [funding_round_nk" not in plan(built)


def test_upsert_of_many_rows_in_small_files_is_not_broadcast(spark, compressed):
    target = materialize(compressed.withColumn("name", F.lit("x")), "target")
    assert "BroadcastHashJoin" not in plan(upsert(target, target, "k"))
    assert "BroadcastHashJoin" not in plan(upsert(target, compressed, "k"))
    assert "BroadcastHashJoin" not in plan(changed_rows(compressed, target, ["k"], []))
    few = materialize(compressed.where("sk < 1000"), "few")
    assert "BroadcastHashJoin" in plan(upsert(target, few, "k"))
    changed = upsert(target, few.withColumn("sk", F.col("sk") + 1), "k").agg(F.count("name"), F.sum("sk")).first()
    assert tuple(changed) == (400_000, 399_999 * 200_000 + 1000)


def broadcasts(monkeypatch, module, run):
    """The physical plans of what ``run`` writes aside in a module, that have a broadcast."""
    plans = []
    for name in ("materialize", "materialize_at"):
        if hasattr(module, name):
            monkeypatch.setattr(module, name, lambda df, path, write=getattr(module, name): plans.append(plan(df)) or write(df, path))
    run()
    assert plans
    return [text for text in plans if "BroadcastHashJoin" in text]


def test_replaced_keys_in_small_files_are_not_broadcast(spark, compressed, monkeypatch):
    """The rows of many affected keys, as a daily build replaces them."""
    path = scratch_path(spark, "replaced")
    tables.upsert_into(compressed, path, "k", written=True, unique=True)
    keys = compressed.select("k")
    run = lambda: tables.upsert_into(compressed.where("sk % 100 > 0"), path, "k", replacing=keys, written=True, unique=True)
    assert broadcasts(monkeypatch, tables, run) == []
    assert tuple(tables.read_table(spark, path).agg(F.count("k"), F.max("sk")).first()) == (396_000, 399_999)


def test_many_waiting_facts_in_small_files_are_not_broadcast(spark, compressed, monkeypatch):
    root = scratch_path(spark, "waiting")
    loaded = compressed.select(F.col("sk").alias("nk"), F.lit(None).cast("long").alias("id"), F.col("k").alias("missing"))
    dims = {"d": (compressed.where("sk % 100 > 0"), "k")}
    pending.note_waiting(spark, root, "t", loaded, "nk", {"id": ("d", "missing")}, whole=True)
    found = []
    run = lambda: found.append(pending.resolved_keys(spark, root, "t", dims))
    assert broadcasts(monkeypatch, pending, run) == []
    assert found[0].count() == 396_000
    run = lambda: pending.note_waiting(spark, root, "t", loaded.where("nk % 100 > 0"), "nk", {"id": ("d", "missing")}, whole=False)
    written = []
    monkeypatch.setattr(pending, "write_version", lambda df, path: written.append(plan(df)))
    run()
    assert written and "BroadcastHashJoin" not in written[0]


def test_many_rejected_rows_in_small_files_are_not_broadcast(spark, compressed, monkeypatch):
    root = scratch_path(spark, "rejected")
    rows = compressed.select("k", F.array(F.lit("r")).alias(VIOLATIONS), "sk")
    state = pending.report(rows, ["sk"], F.col("k"))
    pending.settle(spark, root, "t", state, None)
    judged = compressed.select(F.lit(None).cast("string").alias("source"), F.col("k").alias("key"))
    run = lambda: pending.settle(spark, root, "t", state.where("key <> 'c:7'"), judged)
    assert broadcasts(monkeypatch, pending, run) == []
    assert pending.rejected_rows(spark, root, "t").count() == 399_999
