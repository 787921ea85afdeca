"""Projections, filters and column functions."""

from pyspark.sql import functions as F

from asterism import functions as fn
from asterism.functions.cleaning import ANY_LINE_BREAK
from asterism.operators import apply_mapping, map_columns, tag

from .registry import Tables, check


@check("prj_1_select", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def select(t: Tables):
    return t.customer.select("c_custkey", "c_name", "c_mktsegment")


@check(
    "prj_2_rename",
    """SELECT c_custkey AS company_nk, c_name AS company_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer""",
)
def rename(t: Tables):
    return map_columns(t.customer, {"c_custkey": "company_nk", "c_name": "company_name"})


@check("prj_3_derive_copy", "SELECT *, o_custkey AS company_nk FROM orders")
def derive_copy(t: Tables):
    return t.orders.withColumn("company_nk", F.col("o_custkey"))


@check(
    "prj_4_drop",
    """SELECT o_orderkey, o_totalprice, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def drop(t: Tables):
    """Dropping by name drops both sides' copies of a join key."""
    orders = t.orders.select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("nk"))
    customers = t.customer.select(F.col("c_custkey").alias("nk"), "c_name")
    return orders.join(customers, orders.nk == customers.nk, "left").drop("nk")


@check("prj_5_add_constants", "SELECT 'owner' AS person_in_charge, 'public(db)' AS source, * FROM supplier")
def add_constants(t: Tables):
    return tag(t.supplier, person_in_charge="owner", source="public(db)")


@check(
    "prj_6_map_spec",
    """SELECT CAST(s_suppkey AS VARCHAR) AS investor_nk, s_name AS investor_name,
    CAST(s_acctbal AS DECIMAL(15,2)) AS balance, s_nationkey AS nation_id FROM supplier""",
)
def map_spec(t: Tables):
    rules = [
        ("investor_nk", "s_suppkey", "string"),
        ("investor_name", "s_name"),
        ("balance", "s_acctbal", "decimal(15,2)"),
        ("nation_id", "s_nationkey", "int"),
    ]
    return apply_mapping(t.supplier, rules)


@check(
    "flt_1_eq_date",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem
    WHERE CAST(l_shipdate AS DATE) = DATE '1998-06-15'""",
)
def eq_date(t: Tables):
    day = F.to_date("l_shipdate")
    rows = t.lineitem.where(day == fn.day_before("1998-06-16"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", day.alias("ship_day"))


@check("flt_2_not_null", "SELECT p_partkey, nullif(p_size, 1) AS p_size FROM part WHERE nullif(p_size, 1) IS NOT NULL")
def not_null(t: Tables):
    sizes = t.part.select("p_partkey", F.expr("nullif(p_size, 1)").alias("p_size"))
    return sizes.where(F.col("p_size").isNotNull())


@check(
    "flt_3_negative",
    """SELECT c_name AS name, c_acctbal AS balance FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT s_name, s_acctbal FROM supplier WHERE s_acctbal < 0""",
)
def negative(t: Tables):
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = t.supplier.select("s_name", "s_acctbal")
    return customers.union(suppliers).where(F.col("balance") < 0)


@check(
    "flt_4_threshold_label",
    """SELECT c_nationkey, CASE WHEN 100 * count(*) FILTER (c_acctbal > 0) > 90 * count(*) THEN 'Good' ELSE 'Bad' END
    AS label FROM customer GROUP BY c_nationkey""",
)
def threshold_label(t: Tables):
    filled, whole = F.count_if(F.col("c_acctbal") > 0), F.count(F.lit(1))
    return t.customer.groupBy("c_nationkey").agg(fn.quality_label(filled, whole).alias("label"))


@check("flt_5_not_in", "SELECT * FROM events WHERE event_type NOT IN ('view', 'click')")
def not_in(t: Tables):
    return t.events.where(~F.col("event_type").isin("view", "click"))


@check(
    "scl_1_clean_newlines",
    "SELECT doc_id, replace(text, chr(10), ' ') AS text, lang, source, n_chars FROM documents",
)
def clean_newlines(t: Tables):
    return fn.clean_newlines(t.documents)


@check(
    "scl_1_clean_line_breaks",
    r"SELECT page_id, url, regexp_replace(html, '\r\n|\r|\n', ' ', 'g') AS html FROM pages",
)
def clean_line_breaks(t: Tables):
    return fn.clean_newlines(t.pages, ANY_LINE_BREAK)


@check(
    "scl_2_clean_newlines_nested",
    """WITH c AS (SELECT conv_id, turn, role, text, replace(text, chr(10), ' ') AS cleaned FROM conversations)
    SELECT conv_id, turn, cleaned AS in_struct, cleaned AS in_array, cleaned AS in_map, role || chr(10) AS map_key FROM c""",
)
def clean_nested(t: Tables):
    """Text is cleaned inside structs, arrays and map values, and map keys are left alone."""
    nested = t.conversations.select(
        "conv_id",
        "turn",
        F.struct("role", F.struct("text").alias("body")).alias("message"),
        F.array(F.struct("text")).alias("parts"),
        F.create_map(F.concat("role", F.lit("\n")), "text").alias("by_role"),
    )
    cleaned = fn.clean_newlines_nested(nested)
    return cleaned.select(
        "conv_id",
        "turn",
        F.col("message.body.text").alias("in_struct"),
        F.col("parts")[0]["text"].alias("in_array"),
        F.map_values("by_role")[0].alias("in_map"),
        F.map_keys("by_role")[0].alias("map_key"),
    )


@check(
    "scl_3_parse_date",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_ts, CAST(o_orderdate AS DATE) AS from_text,
    CAST(o_orderdate AS DATE) AS from_day, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS from_mixed
    FROM orders""",
)
def parse_date(t: Tables):
    text = F.col("o_orderdate").cast("string")
    mixed = F.when(F.col("o_orderstatus") == "F", text)
    mixed = mixed.when(F.col("o_orderstatus") == "O", F.substring(text, 1, 4)).otherwise("unknown")
    return t.orders.select(
        "o_orderkey",
        fn.parse_date("o_orderdate").alias("from_ts"),
        fn.parse_date(F.concat(text, F.lit(".000"))).alias("from_text"),
        fn.parse_date(F.substring(text, 1, 10)).alias("from_day"),
        fn.parse_date(mixed).alias("from_mixed"),
    )


@check(
    "scl_4_to_int",
    """SELECT p_partkey, TRY_CAST(p_brand AS INTEGER) AS brand, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_number,
    TRY_CAST(CAST(p_size AS VARCHAR) AS INTEGER) AS size FROM part""",
)
def to_int(t: Tables):
    return t.part.select(
        "p_partkey",
        fn.to_int("p_brand").alias("brand"),
        fn.to_int(F.expr("substr(p_brand, 7)")).alias("brand_number"),
        fn.to_int(fn.to_text("p_size")).alias("size"),
    )


@check(
    "scl_5_to_bool",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN false WHEN 'O' THEN true END AS is_open FROM orders""",
)
def to_bool(t: Tables):
    text = F.when(F.col("o_orderstatus") == "F", "False").when(F.col("o_orderstatus") == "O", "True").otherwise("abc")
    return t.orders.select("o_orderkey", fn.to_bool(text).alias("is_open"))


@check(
    "scl_6_to_decimal",
    """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(15,2)) AS price, CAST(o_totalprice / 1024 AS DECIMAL(9,6)) AS part,
    TRY_CAST(o_orderpriority AS DECIMAL(15,2)) AS bad
    FROM orders""",
)
def to_decimal(t: Tables):
    return t.orders.select(
        "o_orderkey",
        fn.to_decimal(fn.to_text("o_totalprice")).alias("price"),
        fn.to_decimal(F.col("o_totalprice") / 1024, 9, 6).alias("part"),
        fn.to_decimal("o_orderpriority").alias("bad"),
    )


@check("scl_7_to_ts", "SELECT event_id, ts, TRY_CAST(event_type AS TIMESTAMP) AS bad FROM events")
def to_ts(t: Tables):
    return t.events.select("event_id", fn.to_ts(fn.to_text("ts")).alias("ts"), fn.to_ts("event_type").alias("bad"))


@check(
    "scl_8_to_text",
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_text, CAST(l_linenumber AS VARCHAR) AS line_text,
    l_returnflag AS flag_text, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day_text FROM lineitem""",
)
def to_text(t: Tables):
    return t.lineitem.select(
        fn.to_text("l_orderkey").alias("order_text"),
        fn.to_text("l_linenumber").alias("line_text"),
        fn.to_text("l_returnflag").alias("flag_text"),
        fn.to_text(F.to_date("l_shipdate")).alias("day_text"),
    )


@check(
    "scl_9_day_before",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) - 1 AS ds,
    strftime(CAST(o_orderdate AS DATE) - 1, '%Y-%m-%d') AS ds_text FROM orders""",
)
def day_before(t: Tables):
    ds = fn.day_before(F.to_date("o_orderdate"))
    return t.orders.select("o_orderkey", ds.alias("ds"), F.date_format(ds, "yyyy-MM-dd").alias("ds_text"))


@check(
    "scl_10_pct",
    """WITH g AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS part FROM orders GROUP BY 1)
    SELECT o_custkey, CAST(CAST((part * 20000 + n) // (2 * n) AS DECIMAL(9,2)) / 100 AS DECIMAL(5,2)) AS pct FROM g""",
)
def pct(t: Tables):
    part = F.count_if(F.col("o_orderstatus") == "F")
    return t.orders.groupBy("o_custkey").agg(fn.pct(part, F.count(F.lit(1))).alias("pct"))


@check(
    "scl_11_json_doc",
    """SELECT c_custkey, CAST(json_object('data_type', c_mktsegment, 'key', c_custkey) AS VARCHAR) AS doc,
    CAST(json_object(c_name, c_nationkey, 'nation', c_nationkey) AS VARCHAR) AS merged FROM customer""",
)
def json_doc(t: Tables):
    doc = fn.json_doc(data_type="c_mktsegment", key="c_custkey")
    merged = fn.merge_docs(F.create_map("c_name", "c_nationkey"), F.create_map(F.lit("nation"), "c_nationkey"))
    return t.customer.select(
        "c_custkey", fn.to_json_text(doc).alias("doc"), fn.to_json_text(merged).alias("merged")
    )


@check(
    "scl_12_to_json_text",
    """SELECT o_orderkey, CAST(json_object('o_custkey', o_custkey, 'o_orderstatus', o_orderstatus,
    'o_orderpriority', o_orderpriority) AS VARCHAR) AS doc FROM orders""",
)
def to_json_text(t: Tables):
    doc = fn.to_json_text(F.struct("o_custkey", "o_orderstatus", "o_orderpriority"))
    return t.orders.select("o_orderkey", doc.alias("doc"))


@check(
    "scl_13_type_name",
    """SELECT * FROM (SELECT count(o_orderkey) AS n, 'o_orderkey' AS column_name, 'bigint' AS data_type FROM orders
    UNION ALL SELECT count(o_orderdate), 'o_orderdate', 'timestamp_ntz' FROM orders
    UNION ALL SELECT count(o_totalprice), 'o_totalprice', 'double' FROM orders)""",
)
def type_name(t: Tables):
    names = ["o_orderkey", "o_orderdate", "o_totalprice"]
    columns = [
        F.struct(F.count(n).alias("n"), F.lit(n).alias("column_name"), F.lit(fn.type_name(t.orders, n)).alias("data_type"))
        for n in names
    ]
    return t.orders.agg(F.array(*columns).alias("columns")).select(F.inline("columns"))


@check("scl_14_new_id", "SELECT count(*) AS n_rows, count(*) AS n_ids, true AS well_formed, true AS stamped FROM orders")
def new_id(t: Tables):
    rows = t.orders.select(fn.new_id().alias("id"), fn.now().alias("at"))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.bool_and(F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("well_formed"),
        F.bool_and(F.col("at") > F.lit("2020-01-01").cast("timestamp_ntz")).alias("stamped"),
    )


@check(
    "scl_15_key_spec",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL",
)
def key_spec(t: Tables):
    keys = fn.parse_keys("[l_orderkey, l_linenumber]")
    return t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
