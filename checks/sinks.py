"""Sinks."""

from pyspark.sql import functions as F

from asterism import sinks
from asterism.functions import clean_newlines
from asterism.session import materialize, observed, scratch_path
from asterism.sources import read_csv_raw, read_json_records, scan_tables

from .registry import Tables, check
from .sources import row_count


@check("snk_1_csv_overwrite", "SELECT * FROM lineitem")
def csv_overwrite(t: Tables):
    path = scratch_path(t.spark, "lineitem-csv")
    for _ in range(2):
        sinks.write_csv(t.lineitem, path)
    return read_csv_raw(t.spark, path, sep=";", schema=t.lineitem.schema)


@check(
    "snk_2_csv_comma",
    "SELECT doc_id, replace(text, chr(10), ' ') AS text, lang, source, n_chars FROM documents",
)
def csv_comma(t: Tables):
    path = scratch_path(t.spark, "documents-csv")
    sinks.write_csv(clean_newlines(t.documents), path, sep=",")
    return read_csv_raw(t.spark, path, schema=t.documents.schema)


def changed_orders(t: Tables):
    later = t.orders.where("o_orderdate >= '1999-01-01'")
    return later.withColumn("o_totalprice", F.col("o_totalprice") + 1)


def early_orders(t: Tables):
    return t.orders.where("o_orderdate < '2000-01-01'")


UPSERT_SQL = """
WITH delta AS (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders WHERE o_orderdate >= '1999-01-01'),
base AS (SELECT * FROM orders WHERE o_orderdate < '2000-01-01')
SELECT * FROM base WHERE NOT EXISTS (SELECT 1 FROM delta WHERE delta.o_orderkey = base.o_orderkey)
UNION ALL SELECT * FROM delta"""


@check("snk_3_upsert", UPSERT_SQL)
def upsert(t: Tables):
    path = scratch_path(t.spark, "orders")
    sinks.upsert_path(early_orders(t), path, "o_orderkey")
    return sinks.upsert_path(changed_orders(t), path, "[o_orderkey]")


@check("snk_3_upsert_sliced", UPSERT_SQL)
def upsert_sliced(t: Tables):
    """Only the quarters that the change touches are rewritten."""

    def with_quarter(df):
        return df.withColumn("quarter", F.date_format("o_orderdate", "yyyyQ"))

    path = scratch_path(t.spark, "orders")
    sinks.upsert_path(with_quarter(early_orders(t)), path, "o_orderkey", slice_by="quarter")
    changed = with_quarter(changed_orders(t))
    return sinks.upsert_path(changed, path, "o_orderkey", slice_by="quarter").drop("quarter")


@check("snk_3_upsert_pruned", UPSERT_SQL)
def upsert_pruned(t: Tables):
    """A table in buckets of its key; the change reads and writes the buckets of its keys, and a second time nothing."""
    path = scratch_path(t.spark, "orders")
    sinks.upsert_buckets(early_orders(t), path, "o_orderkey", buckets=16)
    for _ in range(2):
        found = sinks.upsert_buckets(changed_orders(t), path, "o_orderkey")
    return found


@check("snk_3_upsert_relayout", UPSERT_SQL)
def upsert_relayout(t: Tables):
    """A whole table, then a change by quarters, then the same change by years and without slices."""
    path = scratch_path(t.spark, "orders")
    sinks.upsert_path(early_orders(t), path, "o_orderkey")
    sinks.upsert_path(changed_orders(t).where("o_orderkey % 2 = 0"), path, "o_orderkey", "date_format(o_orderdate, 'yyyyQ')")
    sinks.upsert_path(changed_orders(t).where("o_orderkey % 2 <> 0"), path, "o_orderkey", "year(o_orderdate)")
    return sinks.upsert_path(changed_orders(t).where("o_orderkey % 3 = 0"), path, "o_orderkey")


@check(
    "snk_3_upsert_moved_slice",
    """SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus) FROM orders""",
)
def upsert_moved_slice(t: Tables):
    """Orders by status; those whose status changes are in one slice only afterwards."""
    path = scratch_path(t.spark, "orders")
    sinks.upsert_path(t.orders, path, "o_orderkey", "o_orderstatus")
    changed = t.orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("O"))
    return sinks.upsert_path(changed, path, "o_orderkey", "o_orderstatus")


@check(
    "snk_3_upsert_new_column",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= '2001-01-01' THEN 'late' ELSE o_orderstatus END AS o_orderstatus,
    'refused' AS extra FROM orders""",
)
def upsert_new_column(t: Tables):
    """A column that the table lacks is refused, in a new slice as well; nothing of it is written."""
    path = scratch_path(t.spark, "orders")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    late = rows.where("year >= 2001").withColumn("o_orderstatus", F.lit("late"))
    sinks.upsert_path(rows.where("year < 2001"), path, "o_orderkey", "year")
    try:
        sinks.upsert_path(late.withColumn("extra", F.lit(1)), path, "o_orderkey", "year")
        outcome = "accepted"
    except ValueError:
        outcome = "refused"
    sinks.upsert_path(late, path, "o_orderkey", "year")
    return sinks.read_table(t.spark, path).drop("year").withColumn("extra", F.lit(outcome))


@check(
    "snk_3_upsert_columns",
    """
WITH delta AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders
               WHERE o_orderdate >= '1999-01-01'),
base AS (SELECT * FROM orders WHERE o_orderdate < '2000-01-01')
SELECT coalesce(b.o_orderkey, d.o_orderkey) AS o_orderkey, b.o_custkey,
  CASE WHEN d.o_orderkey IS NOT NULL THEN d.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
  b.o_totalprice, b.o_orderdate, b.o_orderpriority
FROM base b FULL JOIN delta d ON b.o_orderkey = d.o_orderkey""",
)
def upsert_columns(t: Tables):
    """Columns the source lacks keep their values; nulls it supplies replace values."""
    delta = changed_orders(t).select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"))
    return sinks.upsert(early_orders(t), delta, ["o_orderkey"])


@check(
    "snk_4_upsert_duplicate_guard",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_guard(t: Tables):
    return sinks.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


REST = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@check(
    "snk_4_upsert_last_wins",
    f"""SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {REST.replace(",", " DESC,")} DESC) = 1""",
)
def last_wins(t: Tables):
    return sinks.dedupe_latest(t.lineitem, ["l_orderkey", "l_linenumber"], REST.split(", "))


@check(
    "snk_5_history_alias",
    """SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer UNION ALL
    SELECT 'orders', count(*) FROM orders""",
)
def history_alias(t: Tables):
    root = scratch_path(t.spark, "warehouse")
    loads = {"customer": (t.customer, "c_custkey"), "orders_history": (t.orders, "o_orderkey")}
    for name, (df, key) in loads.items():
        sinks.upsert_path(df, f"{root}/{sinks.target_name(name)}", key)
    return scan_tables({name: sinks.read_table(t.spark, f"{root}/{name}") for name in ["customer", "orders"]}, row_count)


@check("snk_6_append", "SELECT * FROM orders")
def append(t: Tables):
    path = scratch_path(t.spark, "orders")
    sinks.append(t.orders.where("o_orderstatus = 'F'"), path)
    sinks.append(t.orders.where("o_orderstatus <> 'F'"), path)
    return t.spark.read.parquet(path)


@check("snk_7_create_if_absent", "SELECT * FROM customer")
def create_if_absent(t: Tables):
    path = scratch_path(t.spark, "customer")
    sinks.ensure_table(t.spark, path, t.customer.schema)
    sinks.append(t.customer, path)
    return sinks.ensure_table(t.spark, path, t.customer.schema)


@check("snk_8_increment_naming", "SELECT *, CAST(ts AS DATE) AS ds FROM events")
def increment_naming(t: Tables):
    """All days are landed, one of them a second time, which replaces it."""
    path = scratch_path(t.spark, "events")
    sinks.write_increments(t.events, path, "ts")
    day = t.events.where(F.to_date("ts") == "2024-01-10")
    sinks.write_increment(day, path, "2024-01-11")
    return t.spark.read.parquet(path)


@check("snk_9_json_write", "SELECT * FROM conversations")
def json_write(t: Tables):
    path = scratch_path(t.spark, "conversations")
    sinks.write_json(t.conversations, path)
    return read_json_records(t.spark, path, t.conversations.schema)


@check(
    "snk_10_run_log",
    """SELECT 'orders' AS table_name, 'success' AS status, CAST(NULL AS VARCHAR) AS error_msg, count(*) AS n_rows
    FROM orders UNION ALL SELECT 'lineitem', 'failed', 'not unique', NULL""",
)
def run_log(t: Tables):
    root = scratch_path(t.spark, "log")
    tables = {"orders": (t.orders, ["o_orderkey"]), "lineitem": (t.lineitem, ["l_orderkey", "l_linenumber"])}
    for name, (df, keys) in tables.items():
        try:
            with sinks.logged(t.spark, f"{root}/etl_log", "staging", "load", "files", name) as run:
                counted, seen = observed(df)
                sinks.upsert_path(materialize(counted, name), f"{root}/{name}", keys)
                run["n_rows"] = seen.get["n_rows"]
        except sinks.DuplicateKeys:
            pass
    log = t.spark.read.parquet(f"{root}/etl_log")
    return log.select("table_name", "status", F.regexp_extract("error_msg", "not unique", 0).alias("error_msg"), "n_rows")
