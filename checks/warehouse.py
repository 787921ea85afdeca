"""Dimensions, facts, staging, the warehouse build and the streamed upsert."""

import datetime
from functools import reduce

from pyspark.sql import functions as F

from asterism import plans, sinks
from asterism.operators import left_lookup
from asterism.plans.facts import funding_totals
from asterism.schemas import WAREHOUSE, column_names
from asterism.session import materialize, scratch_path
from asterism.sources import read_csv_raw, scan_tables
from asterism.sources.files import TIMESTAMP_FORMAT
from asterism.streaming import upsert_stream

from . import analog
from .analog import key
from .registry import Tables, check

CALENDAR_SQL = """
WITH span AS (SELECT min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS z FROM lineitem),
days AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date_actual,
  day(d) || CASE WHEN day(d) IN (1, 21, 31) THEN 'st' WHEN day(d) IN (2, 22) THEN 'nd' WHEN day(d) IN (3, 23) THEN 'rd'
    ELSE 'th' END AS day_suffix,
  dayname(d) AS day_name, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CAST((day(d) + 6) // 7 AS INTEGER) AS week_of_month, CAST(week(d) AS INTEGER) AS week_of_year,
  strftime(d, '%G-W%V') AS week_of_year_iso, CAST(month(d) AS INTEGER) AS month_actual, monthname(d) AS month_name,
  strftime(d, '%b') AS month_name_abbreviated, CAST(quarter(d) AS INTEGER) AS quarter_actual,
  ['First', 'Second', 'Third', 'Fourth'][quarter(d)] AS quarter_name, CAST(year(d) AS INTEGER) AS year_actual,
  CAST(date_trunc('week', d) AS DATE) AS first_day_of_week, CAST(date_trunc('week', d) AS DATE) + 6 AS last_day_of_week,
  CAST(date_trunc('month', d) AS DATE) AS first_day_of_month, last_day(d) AS last_day_of_month,
  CAST(date_trunc('quarter', d) AS DATE) AS first_day_of_quarter,
  CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE) - 1 AS last_day_of_quarter,
  make_date(year(d), 1, 1) AS first_day_of_year, make_date(year(d), 12, 31) AS last_day_of_year,
  strftime(d, '%m%Y') AS mmyyyy, strftime(d, '%m%d%Y') AS mmddyyyy,
  CASE WHEN isodow(d) >= 6 THEN 'weekend' ELSE 'weekday' END AS weekend_indr FROM days"""


def calendar_of(t: Tables):
    """The calendar of the days that the line items span."""
    day = F.to_date("l_shipdate")
    first, last = t.lineitem.agg(F.min(day), F.max(day)).first()
    return plans.calendar(t.spark, first, last)


@check("dim_1_dim_company", analog.COMPANY_SQL)
def dim_company(t: Tables):
    return plans.dim_company(analog.company(t))


@check("dim_2_dim_date", CALENDAR_SQL)
def dim_date(t: Tables):
    """The calendar as CSV, read back as text and typed."""
    path = scratch_path(t.spark, "dim-date-csv")
    sinks.write_csv(calendar_of(t), path, sep=",")
    return plans.dim_date(read_csv_raw(t.spark, path))


@check("dim_2b_calendar", CALENDAR_SQL)
def calendar(t: Tables):
    return calendar_of(t)


@check("dim_3_dim_funding_round", analog.ROUND_SQL)
def dim_funding_round(t: Tables):
    return plans.dim_funding_round(analog.funding_rounds(t))


@check("dim_4_dim_investor", analog.INVESTOR_SQL)
def dim_investor(t: Tables):
    return plans.dim_investor(analog.investments(t))


PEOPLE_SQL = """SELECT CAST(c_custkey + 1 AS VARCHAR) AS people_nk, c_name AS first_name, c_mktsegment AS last_name,
    CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS VARCHAR) END AS birthplace FROM customer"""


@check("dim_5_dim_people", PEOPLE_SQL)
def dim_people(t: Tables):
    return plans.dim_people(analog.people(t))


RELATIONSHIP_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS relationship_nk,
CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(c_custkey + 1 AS VARCHAR) END AS people_nk,
'c:' || o_custkey AS related_company_nk, CAST(o_orderdate AS DATE) AS start_date,
CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS end_date,
CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_past,
o_orderdate AS created_at, o_orderdate AS updated_at FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""


@check("dim_6_dim_relationship", RELATIONSHIP_SQL)
def dim_relationship(t: Tables):
    return plans.dim_relationship(analog.relationships(t), analog.people(t))


@check("fct_1_fact_company_growth", f"WITH {analog.LINES_SQL} SELECT * FROM ({analog.GROWTH_SQL})")
def fact_company_growth(t: Tables):
    rows = plans.company_growth_rows(
        analog.acquisition(t), analog.funding_rounds(t), analog.ipos(t), plans.calendar(t.spark)
    )
    return plans.conformed(rows, "fact_company_growth")


@check(
    "fct_1_fact_company_growth_all",
    f"""WITH {analog.LINES_SQL}, growth AS ({analog.GROWTH_SQL}),
    funding AS (SELECT 'c:' || o_custkey AS company_nk, CAST(sum(CASE WHEN o_orderstatus <> 'P'
      THEN CAST(o_totalprice AS DECIMAL(15,2)) END) AS DECIMAL(15,2)) AS total FROM orders GROUP BY 1),
    ipo AS (SELECT 'c:' || o_custkey AS company_nk, CAST(o_totalprice AS DECIMAL(15,2)) AS valuation,
      CAST(o_totalprice * 2 AS DECIMAL(15,2)) AS raised FROM orders WHERE o_orderpriority = '1-URGENT' QUALIFY
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) = 1)
    SELECT * FROM growth UNION ALL SELECT funding.company_nk, NULL, 0, total, valuation, raised
    FROM funding LEFT JOIN ipo ON funding.company_nk = ipo.company_nk
    WHERE funding.company_nk NOT IN (SELECT company_nk FROM growth)""",
)
def fact_company_growth_all(t: Tables):
    """Also companies that were never acquired."""
    rows = plans.company_growth_rows(
        analog.acquisition(t), analog.funding_rounds(t), analog.ipos(t), plans.calendar(t.spark), spine="all"
    )
    return plans.conformed(rows, "fact_company_growth")


@check("fct_2_fact_investments", f"WITH {analog.LINES_SQL} SELECT * FROM ({analog.INVESTMENTS_SQL})")
def fact_investments(t: Tables):
    company, rounds, investments = analog.company(t), analog.funding_rounds(t), analog.investments(t)
    rows = plans.fact_investments(
        investments,
        rounds,
        plans.calendar(t.spark),
        plans.dim_company(company),
        plans.dim_investor(investments),
        plans.dim_funding_round(rounds),
    )
    return plans.conformed(rows, "fact_investments")


def dated_orders(t: Tables):
    """Orders whose status text has a line break to be cleaned."""
    return t.orders.withColumn("note", F.concat("o_orderstatus", F.lit("\n"), "o_orderpriority"))


@check(
    "stg_1_stage_table",
    """SELECT * EXCLUDE (o_totalprice), CASE WHEN CAST(o_orderdate AS DATE) = DATE '1998-06-15' THEN o_totalprice + 1
    ELSE o_totalprice END AS o_totalprice, o_orderstatus || ' ' || o_orderpriority AS note FROM orders""",
)
def stage_table(t: Tables):
    """All orders, then the changed ones of a day as an increment, twice."""
    landing, path = scratch_path(t.spark, "landing"), scratch_path(t.spark, "staging")
    orders = dated_orders(t)
    plans.stage_table(orders, landing, path, ["o_orderkey"], "1998-01-01", incremental=False)
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for _ in range(2):
        staged = plans.stage_table(changed, landing, path, ["o_orderkey"], "1998-06-16", ts_col="o_orderdate")
    return staged


@check(
    "stg_2_stage_json",
    "SELECT conv_id, turn, role, replace(text, chr(10), ' ') AS text FROM conversations",
)
def stage_json(t: Tables):
    """Records with text two levels down; keys are unique per conversation and turn."""
    record = F.struct("conv_id", "turn", F.struct("role", "text").alias("message"))
    rows = t.conversations.select(record.alias("record"))
    payload = scratch_path(t.spark, "payload")
    rows.select(F.concat(F.lit("["), F.to_json("record", {"timestampNTZFormat": TIMESTAMP_FORMAT}), F.lit("]"))).write.text(
        payload
    )
    schema = rows.select("record.*").schema
    staged = plans.stage_json(
        t.spark, payload, schema, scratch_path(t.spark, "landing"), scratch_path(t.spark, "staging"), ["conv_id", "turn"], "2024-02-01"
    )
    return staged.select("conv_id", "turn", "message.role", "message.text")


@check(
    "stg_2_invalid",
    """SELECT CASE WHEN turn = 0 THEN 'not_null(turn)' ELSE 'well_formed' END AS rule, count(*) AS row_count FROM conversations
    WHERE turn = 0 OR conv_id % 5 = 0 GROUP BY 1""",
)
def staged_invalid(t: Tables):
    """Payloads without a key and payloads that break off are rejected, not staged under a null key."""
    turn = F.when(F.col("turn") != 0, F.col("turn")).alias("turn")
    record = F.to_json(F.struct("conv_id", turn, "text"))
    broken = (F.col("conv_id") % 5 == 0) & (F.col("turn") != 0)
    payload, landing = scratch_path(t.spark, "payload"), scratch_path(t.spark, "landing")
    t.conversations.select(F.when(broken, F.substring(record, 1, 9)).otherwise(record)).write.text(payload)
    schema = t.conversations.select("conv_id", "turn", "text").schema
    plans.stage_json(t.spark, payload, schema, landing, scratch_path(t.spark, "staging"), ["conv_id", "turn"], "2024-02-01")
    rejected = sinks.read_increment(t.spark, f"{landing}_invalid", "2024-02-01")
    first = rejected.select(F.element_at("violations", 1).alias("rule"))
    return first.groupBy("rule").agg(F.count(F.lit(1)).alias("row_count"))


@check(
    "stg_3_stage_csv",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
    CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier""",
)
def stage_csv(t: Tables):
    file = scratch_path(t.spark, "supplier-csv")
    sinks.write_csv(t.supplier, file, sep=",")
    landing, path = scratch_path(t.spark, "landing"), scratch_path(t.spark, "staging")
    return plans.stage_csv(t.spark, file, landing, path, ["s_suppkey"], "2024-02-01")


LOADED_SQL = {
    "dim_company": analog.COMPANY_SQL,
    "dim_investor": analog.INVESTOR_SQL,
    "dim_funding_round": analog.ROUND_SQL,
    "dim_people": PEOPLE_SQL,
    "dim_relationship": f"{RELATIONSHIP_SQL} WHERE o_orderstatus <> 'P'",
    "dim_date": CALENDAR_SQL.replace("min(CAST(l_shipdate AS DATE))", "DATE '1998-01-01'")
    .replace("max(CAST(l_shipdate AS DATE))", "DATE '2077-12-31'")
    .replace("FROM lineitem", ""),
    "fact_company_growth": f"""SELECT row_number() OVER (ORDER BY company_nk, date_id NULLS FIRST) AS company_growth_id, *
      FROM ({analog.GROWTH_SQL})""",
    "fact_investments": analog.INVESTMENTS_SQL,
}


def as_text_sql(table: str, sql: str, names) -> str:
    """The rows of a table as one text each."""
    columns = ", ".join(f"coalesce(CAST({name} AS VARCHAR), '~')" for name in names)
    return f"SELECT '{table}' AS table_name, concat_ws('|', {columns}) AS row_text FROM ({sql})"


def as_text(df, table: str, names):
    columns = [F.coalesce(F.col(name).cast("string"), F.lit("~")) for name in names]
    return df.select(F.lit(table).alias("table_name"), F.concat_ws("|", *columns).alias("row_text"))


@check(
    "whs_1_build_warehouse",
    f"WITH {analog.LINES_SQL} "
    + " UNION ALL ".join(as_text_sql(table, LOADED_SQL[table], column_names(WAREHOUSE[table])) for table in WAREHOUSE),
)
def build_warehouse(t: Tables):
    """Every column of all tables after two builds; the second finds everything there and keeps all keys."""
    root = scratch_path(t.spark, "warehouse")
    staging = analog.staging(t)
    for _ in range(2):
        tables = plans.build_warehouse(t.spark, staging, root)
    parts = [as_text(tables[name], name, column_names(WAREHOUSE[name])) for name in WAREHOUSE]
    return reduce(lambda a, b: a.unionByName(b), parts)


@check(
    "whs_1_invalid",
    """SELECT 'dim_relationship' AS table_name, 'boolean(is_past)' AS rule, count(*) AS row_count FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'dim_company', 'not_null(company_nk)', 1 FROM (SELECT count(*) FROM part)""",
)
def rejected_rows(t: Tables):
    """What two builds reject: flags that cannot be read, and a company without a key. It does not pile up."""
    root = scratch_path(t.spark, "warehouse")
    staging = analog.staging(t)
    nameless = staging["company"].limit(1).withColumns({"object_id": F.lit(None).cast("string"), "office_id": F.lit(0).cast("long")})
    staging["company"] = staging["company"].unionByName(nameless)
    chosen = {name: staging[name] for name in ("company", "relationships", "people")}
    for _ in range(2):
        plans.build_warehouse(t.spark, chosen, root)
    rows = t.spark.read.parquet(f"{root}/invalid").select("table_name", F.explode("violations").alias("rule"))
    return rows.groupBy("table_name", "rule").agg(F.count(F.lit(1)).alias("row_count"))


UNTIL = datetime.date(1998, 6, 15)


@check(
    "whs_1_incremental",
    f"""WITH {analog.LINES_SQL}, kept AS (SELECT * FROM lines WHERE CAST(l_shipdate AS DATE) <= DATE '{UNTIL}')
    SELECT 'fact_company_growth' AS table_name, company_nk AS key, date_id, acquisition_count AS n, total_funding_usd AS amount
    FROM ({analog.GROWTH_SQL.replace("FROM lines", "FROM kept")})
    UNION ALL SELECT 'fact_investments', investment_nk, date_id, NULL, investment_amount_usd
    FROM ({analog.INVESTMENTS_SQL.replace("FROM lines", "FROM kept")})""",
)
def build_by_day(t: Tables):
    """All but a day, then that day as an increment; the facts are those of a whole build."""
    root = scratch_path(t.spark, "warehouse")
    staging = analog.staging(t)
    day = F.to_date("created_at")
    for source in ("investments", "acquisition"):
        staging[source] = staging[source].where(day <= F.lit(UNTIL))
    before = {name: df.where(day < F.lit(UNTIL)) if name in ("investments", "acquisition") else df for name, df in staging.items()}
    plans.build_warehouse(t.spark, before, root)
    tables = plans.build_warehouse(t.spark, staging, root, run_date=UNTIL + datetime.timedelta(days=1))
    growth = tables["fact_company_growth"].select(
        F.lit("fact_company_growth").alias("table_name"), F.col("company_nk").alias("key"), "date_id",
        F.col("acquisition_count").alias("n"), F.col("total_funding_usd").alias("amount"),
    )
    investments = tables["fact_investments"].select(
        F.lit("fact_investments").alias("table_name"), F.col("investment_nk").alias("key"), "date_id",
        F.lit(None).cast("bigint").alias("n"), F.col("investment_amount_usd").alias("amount"),
    )
    return growth.unionByName(investments)


@check(
    "whs_1_late_dimension",
    f"""WITH {analog.LINES_SQL} SELECT 'fact_investments' AS table_name, CAST(line_id AS VARCHAR) AS key, 'c:' || p_partkey AS found
    FROM lines LEFT JOIN part ON l_partkey = p_partkey
    UNION ALL SELECT 'dim_relationship', relationship_nk, people_nk FROM ({RELATIONSHIP_SQL} WHERE o_orderstatus <> 'P')""",
)
def late_dimension(t: Tables):
    """A third of the companies and persons come a day after all that names them; then a day without anything."""
    root = scratch_path(t.spark, "warehouse")
    whole = {name: df for name, df in analog.staging(t).items() if name in ("investments", "funding_rounds", "company", "people", "relationships")}
    stamp = F.lit(datetime.datetime(2030, 1, 2, 12)).cast("timestamp_ntz")
    late = {"company": F.crc32(F.col("object_id").cast("binary")) % 3 == 0, "people": F.crc32(F.col("object_id").cast("binary")) % 3 == 0}
    first = {name: df.where(~late[name]) if name in late else df for name, df in whole.items()}
    second = {name: df.withColumn("created_at", F.when(late[name], stamp)) if name in late else df for name, df in whole.items()}
    plans.build_warehouse(t.spark, first, root)
    for day in ("2030-01-03", "2030-01-04"):
        tables = plans.build_warehouse(t.spark, second, root, run_date=day)
    companies = tables["dim_company"].select("company_id", "company_nk")
    found = left_lookup(tables["fact_investments"], companies, "company_id")
    parts = [
        found.select(F.lit("fact_investments").alias("table_name"), F.col("investment_nk").alias("key"), F.col("company_nk").alias("found")),
        tables["dim_relationship"].select(F.lit("dim_relationship"), "relationship_nk", "people_nk"),
    ]
    return parts[0].union(parts[1])


@check(
    "whs_1_quarantine",
    f"""WITH {analog.LINES_SQL}, judged AS (SELECT CAST(line_id AS VARCHAR) AS key, p_partkey IS NOT NULL AS known,
      l_partkey % 5 = 0 AS never, l_partkey % 5 = 1 AS late, o_orderkey IS NOT NULL AS round_known FROM lines
      LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey)
    SELECT run, key, CASE WHEN round_known AND known AND NOT never AND (run >= 2 OR NOT late) THEN 'loaded'
      ELSE concat_ws(',', CASE WHEN NOT (known AND NOT never AND (run >= 2 OR NOT late)) THEN 'not_null(company_id)' END,
        CASE WHEN NOT round_known THEN 'not_null(funding_round_id)' END) END AS state
    FROM judged, (SELECT unnest([1, 2, 3]) AS run)""",
)
def quarantine(t: Tables):
    """Investments in companies that come a day late, or never, over three days: each is loaded or kept with what it breaks."""
    root = scratch_path(t.spark, "warehouse")
    staging = {name: df for name, df in analog.staging(t).items() if name in ("investments", "funding_rounds", "company")}
    company, part = staging["company"], F.substring("object_id", 3, 20).cast("long") % 5
    stamp = F.lit(datetime.datetime(2030, 1, 1, 12)).cast("timestamp_ntz")
    days = [
        (None, company.where(part > 1)),
        ("2030-01-02", company.where(part != 0).withColumn("created_at", F.when(part == 1, stamp))),
        ("2030-01-03", company.where(part != 0)),
    ]
    parts = []
    for run, (day, known) in enumerate(days, 1):
        tables = plans.build_warehouse(t.spark, staging | {"company": known}, root, foreign_keys=True, run_date=day)
        kept = plans.rejected_rows(t.spark, root, "fact_investments")
        states = tables["fact_investments"].select(F.col("investment_nk").alias("key"), F.lit("loaded").alias("state"))
        states = states.union(kept.select("key", F.array_join("violations", ",")))
        parts.append(materialize(states.select(F.lit(run).alias("run"), "key", "state"), "states"))
    return reduce(lambda a, b: a.union(b), parts)


@check(
    "fct_1_large_amounts",
    """SELECT 'c:' || o_custkey AS company_nk, CAST(sum(CAST(o_orderkey AS DECIMAL(38,2)) * 10000000000000) AS DECIMAL(38,2))
      AS total_funding_usd FROM orders GROUP BY 1""",
)
def large_amounts(t: Tables):
    """Rounds of 14 digits and more, as text: no amount is lost on the way to a total."""
    amount = F.concat(F.col("o_orderkey").cast("string"), F.lit("0000000000000.00"))
    return funding_totals(t.orders.select(key("c:", "o_custkey").alias("object_id"), amount.alias("raised_amount_usd")))


@check(
    "str_1_incremental_file_upsert",
    """SELECT event_id, ts, user_id, event_type, CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-20'
    THEN value + 1000 ELSE value END AS value, props FROM events""",
)
def incremental_file_upsert(t: Tables):
    """Three drops of files; the second changes rows of the first and brings new ones."""
    folder = scratch_path(t.spark, "events")
    day = F.to_date("ts")
    drops = [
        t.events.where(day <= F.lit(datetime.date(2024, 1, 14))),
        t.events.where(day.between(datetime.date(2024, 1, 8), datetime.date(2024, 1, 20))).withColumn(
            "value", F.col("value") + 1000
        ),
        t.events.where(day > F.lit(datetime.date(2024, 1, 20))),
    ]
    for drop in drops:
        drop.write.mode("append").parquet(f"{folder}/landing")
        upsert_stream(
            t.spark, f"{folder}/landing", t.events.schema, f"{folder}/table", ["event_id"], ["ts", "value"],
            f"{folder}/checkpoint", buckets=16,
        ).awaitTermination()
    return sinks.read_buckets(t.spark, f"{folder}/table")


@check(
    "str_1_out_of_order",
    "SELECT files, event_id, ts, value FROM events, (SELECT unnest(['1', '1000']) AS files)",
)
def out_of_order_files(t: Tables):
    """Newer rows land before older ones; the table is the same for a few and for many files in a batch."""
    parts = []
    for files in (1, 1000):
        folder = scratch_path(t.spark, "events")
        stale = t.events.withColumns({"ts": F.col("ts") - F.expr("INTERVAL 1 DAY"), "value": F.lit(-1.0)})
        for drop in (t.events, stale):
            drop.write.mode("append").parquet(f"{folder}/landing")
        n = 1000 if files > 1 else len(t.spark.read.parquet(f"{folder}/landing").inputFiles()) // 2
        upsert_stream(
            t.spark, f"{folder}/landing", t.events.schema, f"{folder}/table", ["event_id"], ["ts"], f"{folder}/checkpoint",
            "event_id div 1000", n,
        ).awaitTermination()
        parts.append(sinks.read_table(t.spark, f"{folder}/table").select(F.lit(str(files)).alias("files"), "event_id", "ts", "value"))
    return parts[0].unionByName(parts[1])


@check(
    "str_1_equal_order",
    """SELECT files, order_key, max(line) AS line FROM (SELECT l_orderkey AS order_key,
      l_linenumber * 1000000 + CAST(l_quantity AS BIGINT) AS line FROM lineitem), (SELECT unnest([1, 2, 1000]) AS files)
    GROUP BY 1, 2""",
)
def equal_order(t: Tables):
    """Rows of a key that the first order column leaves equal, in all file orders and batch sizes: one table.

    The lines of an order land in several files, as often as there are batch sizes, the second time the other way round.
    """
    line = (F.col("l_linenumber") * 1_000_000 + F.col("l_quantity").cast("long")).alias("line")
    rows = t.lineitem.select(F.col("l_orderkey").alias("order_key"), line, F.lit(0).alias("at"))
    parts = []
    for files, by in ((1, F.col("line")), (2, -F.col("line")), (1000, F.col("line"))):
        folder = scratch_path(t.spark, "lines")
        rows.repartitionByRange(4, by).write.parquet(f"{folder}/landing")
        upsert_stream(
            t.spark, f"{folder}/landing", rows.schema, f"{folder}/table", ["order_key"], ["at", "line"], f"{folder}/checkpoint",
            files_per_batch=files, buckets=16,
        ).awaitTermination()
        parts.append(sinks.read_buckets(t.spark, f"{folder}/table").select(F.lit(files).alias("files"), "order_key", "line"))
    return reduce(lambda a, b: a.union(b), parts)
