"""Profiles and the validation gate."""

from pyspark.sql import functions as F

from asterism import operators as ops
from asterism.session import scratch_path

from .joins import COLUMNS
from .registry import Tables, check
from .sources import ALL

NUMERIC = ("bigint", "int", "double")
ARRAY = "'array'"
PROFILED = ALL


def samples_sql(table: str, column: str) -> str:
    """The five smallest distinct values of a column, as rows (value, place) with text values."""
    return (
        f"SELECT CAST(value AS VARCHAR) AS value, row_number() OVER (ORDER BY s.value) AS place FROM "
        f"(SELECT DISTINCT {column} AS value FROM {table} WHERE {column} IS NOT NULL) s "
        f"ORDER BY s.value LIMIT 5"
    )


def profile_sql(table: str, at: int, column: str, kind: str) -> str:
    negative = f"coalesce(bool_or({column} < 0), false)" if kind in NUMERIC else "false"
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, CAST({at} AS INTEGER) AS ordinal,
    '{kind}' AS data_type, count(*) AS n_rows, count({column}) AS not_null_count,
    CAST(CAST((count({column}) * 20000 + count(*)) // (2 * count(*)) AS DECIMAL(9,2)) / 100 AS DECIMAL(5,2))
      AS percentage_completeness,
    CASE WHEN count({column}) * 100 > count(*) * 90 THEN 'Good' ELSE 'Bad' END AS data_quality_completeness_result,
    {negative} AS is_negative_values,
    {shown_sql(table, column, kind)} AS samples FROM {table}"""


def shown_sql(table: str, column: str, kind: str) -> str:
    """Samples in one text. Engines print an array of floats differently, so of these only the number counts."""
    text = f"(SELECT string_agg({"'array'" if kind.startswith('array') else 'value'}, '|' ORDER BY place) FROM ({samples_sql(table, column)}))"
    return text


def shown(kind, samples):
    return F.array_join(F.transform(samples, lambda v: F.when(kind.startswith("array"), F.lit("array")).otherwise(v)), "|")


def all_columns(names):
    return [(table, at, *column) for table in names for at, column in enumerate(COLUMNS[table], start=1)]


def flat(profiles):
    return profiles.withColumn("samples", shown(F.col("data_type"), F.col("sample_data"))).drop("sample_data")


@check("prf_1_profile_table", " UNION ALL ".join(profile_sql(*column) for column in all_columns(PROFILED)))
def profile_table(t: Tables):
    return flat(ops.profile_all({name: getattr(t, name) for name in PROFILED}))


GAPS = """SELECT p_partkey, nullif(p_size, 1) AS p_size, CASE WHEN p_size <= 44 THEN p_brand END AS p_brand,
CASE WHEN p_size < 45 THEN p_type END AS p_type, nullif(p_name, p_name) AS p_name FROM part"""


@check(
    "prf_2_completeness",
    f"""WITH gaps AS ({GAPS}) SELECT column_name, not_null_count, percentage_completeness,
    data_quality_completeness_result FROM ("""
    + " UNION ALL ".join(
        profile_sql("gaps", at, column, "bigint" if column == "p_partkey" else "string")
        for at, column in enumerate(["p_partkey", "p_size", "p_brand", "p_type", "p_name"], start=1)
    )
    + ")",
)
def completeness(t: Tables):
    t.part.createOrReplaceTempView("part_rows")
    gaps = t.spark.sql(GAPS.replace("FROM part", "FROM part_rows"))
    return ops.profile(gaps, "gaps").select(
        "column_name", "not_null_count", "percentage_completeness", "data_quality_completeness_result"
    )


@check(
    "prf_3_negatives",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        + ("min({0}) < 0".format(column) if kind in NUMERIC else "min({0}) IS NULL".format(column))
        + f" AS is_negative_values FROM {table}"
        for table, _, column, kind in all_columns(ALL)
    ),
)
def negatives(t: Tables):
    profiles = ops.profile_all({name: getattr(t, name) for name in ALL})
    return profiles.select("table_name", "column_name", "is_negative_values")


@check(
    "prf_4_sample",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, {ARRAY if column == 'embedding' else 'value'} AS value "
        f"FROM ({samples_sql(table, column)})"
        for table, _, column, _ in all_columns(ALL)
    ),
)
def sample(t: Tables):
    profiles = ops.profile_all({name: getattr(t, name) for name in ALL})
    # Engines print floats differently, so of arrays only the number of samples is compared.
    value = F.when(F.col("column_name") == "embedding", F.lit("array")).otherwise(F.col("value"))
    return profiles.select("table_name", "column_name", F.explode("sample_data").alias("value")).withColumn("value", value)


DOCUMENT_SQL = " UNION ALL ".join(
    f"SELECT 'main' AS schema, table_name, n_rows, {len(COLUMNS[table])} AS n_cols, column_name, data_type, samples, "
    f"percentage_completeness, data_quality_completeness_result, is_negative_values FROM ({profile_sql(table, at, column, kind)})"
    for table, at, column, kind in all_columns(PROFILED)
)


@check("prf_5_profile_document", DOCUMENT_SQL)
def profile_document(t: Tables):
    """The documents of all tables, taken apart again for comparison."""
    documents = ops.profile_document(ops.profile_all({n: getattr(t, n) for n in PROFILED}), schema="main")
    entries = documents.select(
        "schema", "table_name", "n_rows", "n_cols", "data_quality", F.explode("data_profile").alias("column_name", "p")
    )
    quality = F.col("data_quality")[F.col("column_name")]
    return entries.select(
        "schema",
        "table_name",
        "n_rows",
        "n_cols",
        "column_name",
        "p.data_type",
        shown(F.col("p.data_type"), F.col("p.sample_data")).alias("samples"),
        quality["percentage_completeness"].alias("percentage_completeness"),
        quality["data_quality_completeness_result"].alias("data_quality_completeness_result"),
        quality["is_negative_values"].alias("is_negative_values"),
    )


def documents_of(t: Tables, names):
    return ops.profile_document(ops.profile_all({name: getattr(t, name) for name in names}))


@check(
    "prf_6_tag_profile",
    """SELECT 'owner' AS person_in_charge, 'public(db)' AS source, '-' AS schema, 'orders' AS table_name,
    count(*) AS n_rows, 6 AS n_cols FROM orders""",
)
def tag_profile(t: Tables):
    tagged = ops.tag_profile(documents_of(t, ["orders"]), "owner", "public(db)")
    return tagged.drop("data_profile", "data_quality")


@check(
    "prf_7_persist_profile",
    """SELECT CAST(row_number() OVER (ORDER BY load, table_name) AS BIGINT) AS profile_id, 'owner' AS person_in_charge,
    '-' AS source, '-' AS schema, table_name, n_rows, n_cols, completeness FROM (
    SELECT 1 AS load, 'customer' AS table_name, count(*) AS n_rows, 5 AS n_cols, '100.00' AS completeness FROM customer
    UNION ALL SELECT 1, 'orders', count(*), 6, NULL FROM orders
    UNION ALL SELECT 2, 'customer', count(*), 5, '100.00' FROM customer)""",
)
def persist_profile(t: Tables):
    """Two loads; the second continues the ids of the first."""
    path = scratch_path(t.spark, "profiles")
    for names in (["customer", "orders"], ["customer"]):
        ops.persist_profile(ops.tag_profile(documents_of(t, names), "owner"), path)
    completeness = F.get_json_object("data_quality", "$.c_name.percentage_completeness").cast("decimal(5,2)")
    saved = t.spark.read.parquet(path).withColumn("completeness", completeness.cast("string"))
    return saved.drop("data_profile", "data_quality", "created_at")


@check(
    "prf_7_persist_profiles",
    " UNION ALL ".join(
        f"SELECT {at}::BIGINT AS profile_id, '{table}' AS table_name, count(*) AS n_rows, {len(COLUMNS[table])} AS n_cols, 'success' AS status, "
        f"count(*) AS logged_rows FROM {table}"
        for at, table in enumerate(ALL, start=1)
    )
    + " UNION ALL SELECT NULL, 'absent', NULL, NULL, 'failed', NULL",
)
def persist_profiles(t: Tables):
    """Every table, and one that cannot be read: the others' profiles are there, and the run log has them all."""
    path, log = scratch_path(t.spark, "profiles"), scratch_path(t.spark, "log")
    broken = t.region.selectExpr("raise_error('cannot be read') AS x")
    ops.persist_profiles({name: getattr(t, name) for name in ALL} | {"absent": broken}, path, "owner", "files", log=log)
    saved = t.spark.read.parquet(path).select("profile_id", "table_name", "n_rows", "n_cols")
    runs = t.spark.read.parquet(log).select("table_name", "status", F.col("n_rows").alias("logged_rows"))
    return runs.join(saved, "table_name", "left")


@check(
    "prf_8_profile_catalog",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS n_rows, {len(columns)} AS n_cols, "
        + " + ".join(f"count({name})" for name, _ in columns)
        + f" AS filled FROM {table}"
        for table, columns in COLUMNS.items()
    ),
)
def profile_catalog(t: Tables):
    profiles = ops.profile_all({name: getattr(t, name) for name in ALL}, sample_size=0)
    return profiles.groupBy("table_name", "n_rows").agg(
        F.count(F.lit(1)).cast("int").alias("n_cols"), F.sum("not_null_count").alias("filled")
    )


def gaps_in_orders(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.expr("nullif(o_custkey, 7)").alias("o_custkey"),
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
    )


@check(
    "val_1_not_null_rule",
    """SELECT o_orderkey, concat_ws(',', CASE WHEN o_custkey = 7 THEN 'not_null(o_custkey)' END,
    CASE WHEN o_orderstatus = 'P' THEN 'not_null(o_orderstatus)' END) AS violations FROM orders""",
)
def not_null_rule(t: Tables):
    tagged = ops.tag_violations(gaps_in_orders(t), [ops.NotNull("o_custkey"), ops.NotNull("o_orderstatus")])
    return tagged.select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@check(
    "val_2_type_rule",
    """SELECT event_id, concat_ws(',', CASE WHEN TRY_CAST(event_type AS INTEGER) IS NULL THEN 'int(event_type)' END,
    CASE WHEN event_type IN ('view', 'click') THEN 'date(day)' END) AS violations FROM events""",
)
def type_rule(t: Tables):
    day = F.when(F.col("event_type").isin("view", "click"), F.lit("soon")).otherwise(F.col("ts").cast("string"))
    rules = [
        ops.Castable("event_type", "int"),
        ops.Castable("event_id", "double"),
        ops.Castable("day", "date"),
    ]
    tagged = ops.tag_violations(t.events.withColumn("day", day), rules)
    return tagged.select("event_id", F.array_join("violations", ",").alias("violations"))


def order_rules(t: Tables):
    rich = t.customer.where("c_acctbal > 0")
    return [
        ops.NotNull("o_orderstatus"),
        ops.Castable("o_orderstatus", "int"),
        ops.ForeignKey("o_custkey", rich, "c_custkey"),
    ]


RULES_SQL = """SELECT o_orderkey, nullif(o_custkey, 7) AS o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
  o_orderstatus = 'P' AS no_status, o_orderstatus <> 'P' AS bad_status,
  o_custkey <> 7 AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0) AS no_parent
FROM orders"""


@check(
    "val_3_fk_rule",
    f"""SELECT o_orderkey, CASE WHEN no_parent THEN 'foreign_key(o_custkey)' ELSE '' END AS violations
    FROM ({RULES_SQL})""",
)
def fk_rule(t: Tables):
    tagged = ops.tag_violations(gaps_in_orders(t), order_rules(t)[2:])
    return tagged.select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@check(
    "val_4_split",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, concat_ws(',', CASE WHEN no_status THEN 'not_null(o_orderstatus)' END,
    CASE WHEN no_parent THEN 'foreign_key(o_custkey)' END) AS violations FROM ({RULES_SQL})""",
)
def split(t: Tables):
    """Valid and invalid rows, landed in one pass and put together again."""
    rules = [order_rules(t)[0], order_rules(t)[2]]
    valid, invalid, _ = ops.land_split(gaps_in_orders(t), rules, scratch_path(t.spark, "gate"))
    broken = invalid.withColumn("violations", F.array_join("violations", ","))
    return valid.withColumn("violations", F.lit("")).unionByName(broken)


@check(
    "val_5_rule_report",
    f"""SELECT 'not_null(o_orderstatus)' AS rule, count(*) AS row_count FROM ({RULES_SQL}) WHERE no_status
    UNION ALL SELECT 'int(o_orderstatus)', count(*) FROM ({RULES_SQL}) WHERE bad_status
    UNION ALL SELECT 'foreign_key(o_custkey)', count(*) FROM ({RULES_SQL}) WHERE no_parent""",
)
def rule_report(t: Tables):
    _, invalid = ops.split_valid(gaps_in_orders(t), order_rules(t))
    return ops.validation_report(invalid)
