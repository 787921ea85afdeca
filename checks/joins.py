"""Joins, aggregates and keys."""

import datetime

from pyspark.sql import functions as F

from asterism import operators as ops
from asterism.plans import calendar
from asterism.sources import catalog_columns, scan_tables

from .analog import lines
from .registry import Tables, check
from .sources import ALL, row_count


def days(t: Tables):
    """A calendar that leaves out some of the days in the data."""
    return calendar(t.spark, datetime.date(1996, 1, 1), datetime.date(2000, 12, 31))


def day_id(ts: str) -> str:
    """SQL for the key that ``days`` has for a timestamp."""
    return (
        f"CASE WHEN CAST({ts} AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' "
        f"THEN CAST(strftime({ts}, '%Y%m%d') AS INTEGER) END"
    )


def money(name: str):
    return F.col(name).cast("decimal(15,2)")


@check("jon_1_date_lookup", f"SELECT l_orderkey, l_linenumber, l_partkey, {day_id('l_shipdate')} AS date_id FROM lineitem")
def date_lookup(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return ops.with_date_id(rows, "l_shipdate", days(t)).drop("l_shipdate")


def order_sums(t: Tables):
    return t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(money("o_totalprice")).cast("decimal(25,2)").alias("total"), F.count(F.lit(1)).alias("n_orders")
    )


@check(
    "jon_2_measure_join",
    """WITH s AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS total,
      count(*) AS n_orders FROM orders GROUP BY 1),
    d AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1)
    SELECT c_custkey, c_name, total, n_orders, last_day FROM customer
    LEFT JOIN s ON c_custkey = s.o_custkey LEFT JOIN d ON c_custkey = d.o_custkey""",
)
def measure_join(t: Tables):
    last = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(F.to_date("o_orderdate")).alias("last_day")
    )
    spine = t.customer.select("c_custkey", "c_name")
    return ops.left_join_measures(spine, order_sums(t), last, on="c_custkey")


@check(
    "jon_3_dim_presence_join",
    """SELECT o_custkey, count(*) AS n_orders FROM orders
    LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) ON o_custkey = c_custkey GROUP BY 1""",
)
def dim_presence_join(t: Tables):
    """With distinct keys on the right and none of its columns selected, Catalyst drops the join."""
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    keys = ops.distinct_values(t.customer, "c_custkey").withColumnRenamed("c_custkey", "o_custkey")
    return counts.join(keys, "o_custkey", "left").select("o_custkey", "n_orders")


ROUND_SQL = """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, o_totalprice FROM lineitem
LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') ON l_orderkey = o_orderkey"""


def rounds(t: Tables):
    known = t.orders.where("o_orderpriority <> '5-LOW'")
    return known.select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")


@check("jon_4_round_join", ROUND_SQL)
def round_join(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return ops.left_lookup(rows, rounds(t), "l_orderkey")


@check("jon_4_round_join_hot_keys", ROUND_SQL)
def round_join_hot_keys(t: Tables):
    """The way for dimensions too large to be broadcast, with frequent keys set apart."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return ops.left_lookup(rows, rounds(t), "l_orderkey", small=False, parts=2_000)


@check(
    "jon_5_fk_lookup",
    """WITH s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_name) AS investor_id FROM supplier WHERE s_acctbal > 0),
    p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS company_id FROM part),
    o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS round_id FROM orders)
    SELECT l_orderkey, l_linenumber, l_partkey, investor_id, company_id, round_id FROM lineitem
    LEFT JOIN s ON l_suppkey = s_suppkey LEFT JOIN p ON l_partkey = p_partkey LEFT JOIN o ON l_orderkey = o_orderkey""",
)
def fk_lookup(t: Tables):
    supplier = ops.with_dense_id(t.supplier.where("s_acctbal > 0"), "s_name", "investor_id")
    part = ops.with_dense_id(t.part.select("p_partkey"), "p_partkey", "company_id")
    orders = ops.with_dense_id(t.orders.select("o_orderkey"), "o_orderkey", "round_id")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    keyed = ops.lookup_key(rows, supplier, "l_suppkey", "s_suppkey", "investor_id", counted=rows)
    keyed = ops.lookup_key(keyed, part, "l_partkey", "p_partkey", "company_id", counted=rows)
    keyed = ops.lookup_key(keyed, orders, "l_orderkey", "o_orderkey", "round_id", counted=rows)
    return keyed.drop("l_suppkey")


@check(
    "jon_6_fk_lookup_twice",
    """SELECT n_name, o_orderkey, c.c_name AS customer_name, s.s_name AS supplier_name FROM
    (SELECT o_orderkey, o_custkey, o_custkey % 150 AS suppkey FROM orders)
    LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c.c_custkey
    LEFT JOIN supplier s ON suppkey = s.s_suppkey LEFT JOIN nation ON c.c_nationkey = n_nationkey""",
)
def fk_lookup_twice(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", (F.col("o_custkey") % 150).alias("suppkey"))
    people = t.customer.where("c_acctbal > 0").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    people = people.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("customer_name"), "n_name")
    companies = t.supplier.select(F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("supplier_name"))
    keyed = ops.left_lookup(rows, people, "o_custkey", counted=rows)
    keyed = ops.left_lookup(keyed, companies, "suppkey", counted=rows)
    return keyed.select("n_name", "o_orderkey", "customer_name", "supplier_name")


@check(
    "jon_6_fk_lookup_roles",
    """SELECT l_orderkey, l_linenumber, line_id, a.p_name AS part_name, b.p_name AS other_name FROM
    (SELECT *, CASE WHEN l_quantity < 40 THEN (l_partkey * 7) % 100000 END AS other,
      row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS line_id FROM lineitem)
    LEFT JOIN part a ON l_partkey = a.p_partkey LEFT JOIN part b ON other = b.p_partkey""",
)
def fk_lookup_roles(t: Tables):
    """Two parts of a line item, looked up at once in a dimension that is not broadcast."""
    rows = lines(t).withColumn("other", F.when(F.col("l_quantity") < 40, (F.col("l_partkey") * 7) % 100_000))
    found = ops.lookup_roles(rows, t.part, {"l_partkey": "part_name", "other": "other_name"}, "p_partkey", "p_name", "line_id", small=False)
    return found.select("l_orderkey", "l_linenumber", "line_id", "part_name", "other_name")


# The columns and types of the test tables.
COLUMNS = {
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp_ntz")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "bigint")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
    "embeddings": [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")],
}


@check(
    "jon_7_catalog_inner",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS n_rows, '{name}' AS column_name, {at} AS ordinal, "
        f"'{kind}' AS data_type FROM {table}"
        for table, columns in COLUMNS.items()
        for at, (name, kind) in enumerate(columns, start=1)
    ),
)
def catalog_inner(t: Tables):
    """The list of tables, with their row counts, and the list of columns."""
    tables = {name: getattr(t, name) for name in ALL}
    return scan_tables(tables, row_count).join(catalog_columns(tables), "table_name")


@check(
    "agg_1_count_by_key_date",
    f"""SELECT l_suppkey, {day_id('l_shipdate')} AS date_id, count(l_partkey) AS n FROM lineitem GROUP BY ALL""",
)
def count_by_key_date(t: Tables):
    dated = ops.with_date_id(t.lineitem, "l_shipdate", days(t))
    return dated.groupBy("l_suppkey", "date_id").agg(F.count("l_partkey").alias("n"))


@check(
    "agg_2_sum_by_key",
    """SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice AS DECIMAL(15,2)) END)
    AS DECIMAL(25,2)) AS total FROM orders GROUP BY 1""",
)
def sum_by_key(t: Tables):
    """Nulls are left out; a key with nulls only sums to null."""
    amount = F.when(F.col("o_orderstatus") != "F", money("o_totalprice"))
    return t.orders.groupBy("o_custkey").agg(F.sum(amount).cast("decimal(25,2)").alias("total"))


@check("agg_3_distinct", "SELECT DISTINCT l_suppkey FROM lineitem")
def distinct(t: Tables):
    return ops.distinct_values(t.lineitem, "l_suppkey")


@check("agg_4_row_count", "SELECT count(*) AS n_rows FROM lineitem")
def count(t: Tables):
    return row_count(t.lineitem)


@check("agg_5_col_count", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def col_count(t: Tables):
    return row_count(t.lineitem).withColumn("n_cols", F.lit(len(t.lineitem.columns)))


@check("agg_6_not_null_count", "SELECT count(nullif(p_size, 1)) AS size_count, count(p_brand) AS brand_count FROM part")
def not_null_count(t: Tables):
    return t.part.agg(F.count(F.expr("nullif(p_size, 1)")).alias("size_count"), F.count("p_brand").alias("brand_count"))


@check(
    "agg_7_negative_count",
    """SELECT count(*) FILTER (c_acctbal < 0) AS n, count(*) FILTER (c_acctbal < 0) > 0 AS any_negative,
    count(*) FILTER (c_custkey < 0) > 0 AS any_key FROM customer""",
)
def negative_count(t: Tables):
    n = F.count_if(F.col("c_acctbal") < 0)
    return t.customer.agg(
        n.alias("n"), (n > 0).alias("any_negative"), (F.count_if(F.col("c_custkey") < 0) > 0).alias("any_key")
    )


@check("agg_8_distinct_sample", "SELECT DISTINCT c_name AS value FROM customer ORDER BY 1 LIMIT 5")
def distinct_sample(t: Tables):
    return ops.sample_values(t.customer, "c_name")


@check(
    "agg_9_one_row_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def one_row_per_key(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return ops.pick_one(rows, "o_custkey", ["o_orderdate", "o_orderkey"], last=True)


@check("lim_1_limit", "SELECT DISTINCT p_type, p_brand FROM part ORDER BY 1, 2 LIMIT 5")
def limit(t: Tables):
    return ops.distinct_values(t.part, "p_type", "p_brand").orderBy("p_type", "p_brand").limit(5)


@check("id_1_surrogate_dense", "SELECT row_number() OVER (ORDER BY c_name DESC, c_custkey) AS customer_id, * FROM customer")
def surrogate_dense(t: Tables):
    """Ordered by a name that is compared from behind, to tell the order from that of the file."""
    reverse = t.customer.withColumn("_order", -F.substring("c_name", 10, 9).cast("int"))
    return ops.with_dense_id(reverse, ["_order", "c_custkey"], "customer_id").drop("_order")


@check(
    "id_1_surrogate_dense_bag",
    """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line_id, * FROM lineitem""",
)
def surrogate_dense_bag(t: Tables):
    return ops.with_dense_id(t.lineitem, ["l_orderkey", "l_linenumber"], "line_id", unique=False)


@check(
    "id_2_surrogate_stable",
    """WITH old AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS id FROM customer WHERE c_acctbal < 5000),
    new AS (SELECT c_name, row_number() OVER (ORDER BY c_name) + (SELECT max(id) FROM old) AS id FROM customer
            WHERE c_acctbal >= 5000)
    SELECT id AS customer_id, c.* FROM customer c JOIN (SELECT * FROM old UNION ALL SELECT * FROM new) k
    ON c.c_name = k.c_name""",
)
def surrogate_stable(t: Tables):
    first = ops.assign_ids(None, t.customer.where("c_acctbal < 5000"), "c_name", "customer_id")
    return ops.assign_ids(first, t.customer, "c_name", "customer_id")


@check("id_3_surrogate_hash", "SELECT md5(CAST(c_custkey AS VARCHAR)) AS customer_key, * FROM customer")
def surrogate_hash(t: Tables):
    return ops.with_hash_id(t.customer, "c_custkey", "customer_key")
