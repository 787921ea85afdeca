"""Sources."""

from functools import reduce

from pyspark.sql import functions as F

from asterism import sources
from asterism.session import materialize, scratch_path
from asterism.sinks import write_csv
from asterism.sources.files import MALFORMED, TIMESTAMP_FORMAT

from .registry import Tables, check

EIGHT = ["customer", "orders", "lineitem", "part", "supplier", "events", "documents", "pages"]
ALL = EIGHT + ["region", "nation", "benchmark", "labels", "conversations", "embeddings"]


def counts_sql(names):
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in names)


def row_count(df):
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


@check(
    "src_2_jdbc_incremental",
    "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-06-16' - 1",
)
def incremental(t: Tables):
    return sources.extract_increment(t.orders, "o_orderdate", "1998-06-16")


@check(
    "src_1_quantile_strides",
    """SELECT l_orderkey, l_linenumber, l_partkey, 1 AS by_number, 1 AS by_skewed, 1 AS by_time, 1 AS by_text FROM lineitem""",
)
def quantile_strides(t: Tables):
    """In how many strides a row is: of an even column, of one with few values and nulls, of times, and of hashed text."""
    rows = t.lineitem.withColumn("few", F.when(F.col("l_quantity") > 5, F.least("l_linenumber", F.lit(2))))
    rows = rows.withColumn("key", F.when(F.col("l_quantity") > 5, F.col("l_orderkey").cast("string")))
    strides = {
        "by_number": sources.stride_predicates("l_partkey", sources.stride_bounds(rows, "l_partkey", 8)),
        "by_skewed": sources.stride_predicates("few", sources.stride_bounds(rows, "few", 8)),
        "by_time": sources.stride_predicates("l_shipdate", sources.stride_bounds(rows, "l_shipdate", 8)),
        "by_text": sources.hash_predicates("crc32(key)", 8),
    }
    met = {name: sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0)) for name, predicates in strides.items()}
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", *[column.alias(name) for name, column in met.items()])


@check(
    "src_2_snapshot_diff",
    """WITH staged AS (SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
      CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority) FROM orders WHERE o_orderkey % 5 <> 0),
    source AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0)
    SELECT s.*, CASE WHEN d.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS change FROM source s LEFT JOIN staged d ON s.o_orderkey = d.o_orderkey
    WHERE d.o_orderkey IS NULL OR s.o_totalprice <> d.o_totalprice OR s.o_orderpriority IS DISTINCT FROM d.o_orderpriority
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, 'delete' FROM staged WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)""",
)
def snapshot_diff(t: Tables):
    """Rows that came late, changed without a new date, or went, against what is staged."""
    staged = t.orders.where("o_orderkey % 5 <> 0").withColumns({
        "o_totalprice": F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_orderpriority": F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")),
    })
    return sources.snapshot_diff(t.orders.where("o_orderkey % 3 <> 0"), staged, "o_orderkey")


@check("src_3_jdbc_projected", "SELECT o_orderkey, o_totalprice FROM orders")
def projected(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice")


@check(
    "src_4_csv_header",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
    CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
)
def csv_header(t: Tables):
    path = scratch_path(t.spark, "customer-csv")
    write_csv(t.customer, path, sep=",")
    return sources.read_csv_raw(t.spark, path)


@check(
    "src_5_csv_delimited",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
    CAST(o_totalprice AS VARCHAR) AS o_totalprice,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS o_orderdate, o_orderpriority FROM orders""",
)
def csv_delimited(t: Tables):
    path = scratch_path(t.spark, "orders-csv")
    write_csv(t.orders, path)
    return sources.read_csv_raw(t.spark, path, sep=";")


@check(
    "src_4_csv_malformed",
    """SELECT CASE WHEN c_custkey % 10 > 2 THEN c_custkey END AS c_custkey, CASE WHEN c_custkey % 10 > 2 THEN c_acctbal END AS c_acctbal,
    CASE c_custkey % 10 WHEN 0 THEN c_custkey || ';much' WHEN 1 THEN CAST(c_custkey AS VARCHAR) WHEN 2 THEN c_custkey || ';1;2' END
      AS malformed FROM customer""",
)
def csv_malformed(t: Tables):
    """Records with an unreadable value, a value too few and one too many keep their text."""
    key, kind = F.col("c_custkey").cast("string"), F.col("c_custkey") % 10
    line = F.when(kind == 0, F.concat(key, F.lit(";much"))).when(kind == 1, key).when(kind == 2, F.concat(key, F.lit(";1;2")))
    line = line.otherwise(F.concat(key, F.lit(";"), F.col("c_acctbal").cast("string")))
    path = scratch_path(t.spark, "malformed-csv")
    t.customer.select(line.alias("c_custkey;c_acctbal")).write.options(header=True, quote="\u0000").csv(path)
    schema = t.customer.select("c_custkey", "c_acctbal").schema
    rows = sources.read_csv_raw(t.spark, path, ";", schema, malformed=True)
    whole = F.col(MALFORMED).isNull()
    return rows.select(*[F.when(whole, F.col(c)).alias(c) for c in schema.names], F.col(MALFORMED).alias("malformed"))


@check(
    "src_7_json_malformed",
    "SELECT CASE WHEN event_id % 7 > 0 THEN event_id END AS event_id, event_id % 7 = 0 AS malformed FROM events",
)
def json_malformed(t: Tables):
    """Every seventh payload breaks off."""
    record = F.to_json(F.struct("event_id", "event_type"))
    line = F.when(F.col("event_id") % 7 == 0, F.substring(record, 1, 15)).otherwise(record)
    path = scratch_path(t.spark, "malformed-json")
    t.events.select(line).write.text(path)
    schema = t.events.select("event_id", "event_type").schema
    rows = sources.read_json_records(t.spark, path, schema, malformed=True)
    return rows.select("event_id", F.col(MALFORMED).isNotNull().alias("malformed"), "event_type").drop("event_type")


def small_splits(t: Tables, path: str, read):
    """What ``read`` gives where the text files in ``path`` are cut into a dozen splits and more."""
    name = "spark.sql.files.maxPartitionBytes"
    before = t.spark.conf.get(name)
    size = t.spark.read.text(path).agg(F.sum(F.octet_length("value") + 1)).first()[0]
    t.spark.conf.set(name, str(max(4096, size // 12)))
    try:
        return materialize(read(), "records")
    finally:
        t.spark.conf.set(name, before)


@check("src_4_csv_multi_line", "SELECT doc_id, text, lang FROM documents WHERE text IS NOT NULL AND text <> ''")
def csv_multi_line(t: Tables):
    """Texts with line breaks and quotes, in files of which many tasks read a part each."""
    path = scratch_path(t.spark, "documents-csv")
    rows = t.documents.where("text IS NOT NULL AND text <> ''").select("doc_id", "text", "lang")
    write_csv(rows, path, sep=",")
    return small_splits(t, path, lambda: sources.read_csv_raw(t.spark, path, schema=rows.schema, multi_line=True))


@check("src_7_json_array", "SELECT conv_id, turn, role, text FROM conversations")
def json_array(t: Tables):
    """One array of records that spans lines, in files of which many tasks read a part each."""
    path = scratch_path(t.spark, "conversations-json")
    record = F.to_json(F.struct("conv_id", "turn", F.struct("role", "text").alias("message")), {"pretty": "true"})
    rows = t.conversations.select(F.concat(record, F.lit(",")).alias("value"))
    # Each file is an array: brackets before its first record and after its last one.
    numbered = rows.withColumn("part", F.spark_partition_id())
    ends = numbered.select("part").distinct()
    parts = [ends.select("part", F.lit(0).alias("o"), F.lit("[").alias("value")), numbered.select("part", F.lit(1), "value"), ends.select("part", F.lit(2), F.lit('{"conv_id": null}]'))]
    whole = reduce(lambda a, b: a.union(b), parts).repartition("part").sortWithinPartitions("part", "o")
    whole.select("value").write.text(path)
    schema = t.conversations.select("conv_id", "turn", F.struct("role", "text").alias("message")).schema
    found = small_splits(t, path, lambda: sources.read_json_records(t.spark, path, schema, whole_file=True))
    return found.where("conv_id IS NOT NULL").select("conv_id", "turn", "message.role", "message.text")


@check(
    "src_6_csv_inferred",
    """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer""",
)
def csv_inferred(t: Tables):
    path = scratch_path(t.spark, "customer-csv")
    write_csv(t.customer, path, sep=",")
    return sources.read_csv_inferred(t.spark, path)


@check("src_7_json_records", "SELECT * FROM events")
def json_records(t: Tables):
    path = scratch_path(t.spark, "events-payload")
    record = F.to_json(F.struct("*"), {"timestampNTZFormat": TIMESTAMP_FORMAT})
    t.events.select(F.concat(F.lit("["), record, F.lit("]"))).write.text(path)
    return sources.read_json_records(t.spark, path, t.events.schema)


@check(
    "src_8_api_date_range",
    "SELECT * FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'",
)
def api_date_range(t: Tables):
    return sources.date_range(t.events, "ts", "2024-01-05", "2024-01-11")


@check("src_9_multi_table_scan", counts_sql(ALL))
def multi_table_scan(t: Tables):
    return sources.scan_tables({name: getattr(t, name) for name in ALL}, row_count)


@check("src_10_catalog_tables", counts_sql(ALL))
def catalog_tables(t: Tables):
    listed = sources.list_tables(t.spark, t.folder)
    return sources.scan_tables({name: t.spark.read.parquet(path) for name, path in listed.items()}, row_count)


@check("src_11_skip_missing", counts_sql(["customer", "orders"]))
def skip_missing(t: Tables):
    found = {name: sources.read_or_none(lambda: getattr(t, name)) for name in ["customer", "funds", "orders"]}
    return sources.scan_tables({name: df for name, df in found.items() if df is not None}, row_count)


@check(
    "src_12_skip_empty",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS table_name, count(*) AS n_rows FROM orders
    WHERE CAST(o_orderdate AS DATE) IN (DATE '1980-01-01', DATE '1998-06-15', DATE '1999-12-31') GROUP BY 1""",
)
def skip_empty(t: Tables):
    runs = {"1980-01-01": "1980-01-02", "1998-06-15": "1998-06-16", "1999-12-31": "2000-01-01"}
    days = {day: sources.extract_increment(t.orders, "o_orderdate", run) for day, run in runs.items()}
    return sources.scan_tables({day: df for day, df in days.items() if not sources.is_empty(df)}, row_count)
