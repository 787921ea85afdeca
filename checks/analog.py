"""Staging tables of the star schema, made of the test tables, in Spark and in SQL.

company: part. investor: supplier. funding round: order. investment and acquisition:
line item (one per key). public offering: order of a customer. person: customer.
relationship: order.
"""

from pyspark.sql import functions as F

from asterism.operators import with_dense_id
from asterism.schemas import STAGING, struct

from .registry import Tables

LINE_REST = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def lines(t: Tables):
    """All line items, each under a number of its own; an order has several with one line number."""
    # The price comes last in the order and is used nowhere: of rows that are equal but for it, any may come first.
    names = [name for name in ["l_orderkey", "l_linenumber", *LINE_REST] if name != "l_extendedprice"]
    return t.once("lines", lambda: with_dense_id(t.lineitem.select(names), names, "line_id", unique=False), written=True)


def _conform(df, name: str):
    """``df`` with all columns and types of a staging table; columns it lacks are null."""
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in struct(STAGING[name]).fields
        ]
    )


def key(prefix: str, name: str):
    return F.concat(F.lit(prefix), F.col(name).cast("string"))


def company(t: Tables):
    """Two offices for every part of a size over 25; the second is to be ignored."""
    first = t.part.select(
        F.col("p_partkey").alias("office_id"),
        key("c:", "p_partkey").alias("object_id"),
        F.col("p_brand").alias("region"),
        F.col("p_type").alias("city"),
        F.substring("p_name", 1, 3).alias("country_code"),
        (F.col("p_retailprice") / 100).alias("latitude"),
        (-F.col("p_retailprice") / 100).alias("longitude"),
        "p_size",
    )
    second = first.where("p_size > 25").withColumns(
        {"office_id": F.col("office_id") + 100_000_000, "region": F.lit("second office")}
    )
    return _conform(first.unionByName(second), "company")


def funding_rounds(t: Tables):
    return _conform(
        t.orders.select(
            F.col("o_orderkey").alias("funding_round_id"),
            key("c:", "o_custkey").alias("object_id"),
            F.to_date("o_orderdate").alias("funded_at"),
            F.col("o_orderpriority").alias("funding_round_type"),
            F.col("o_orderstatus").alias("funding_round_code"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("raised_amount_usd"),
            (F.col("o_orderstatus") == "F").alias("is_first_round"),
            (F.col("o_orderstatus") == "O").alias("is_last_round"),
            F.col("o_orderdate").alias("created_at"),
        ),
        "funding_rounds",
    )


def investments(t: Tables):
    return _conform(
        lines(t).select(
            F.col("line_id").alias("investment_id"),
            F.col("l_orderkey").alias("funding_round_id"),
            key("c:", "l_partkey").alias("funded_object_id"),
            key("f:", "l_suppkey").alias("investor_object_id"),
            F.col("l_shipdate").alias("created_at"),
        ),
        "investments",
    )


def acquisition(t: Tables):
    """Acquired companies are customers' numbers, so that funding and offerings are found."""
    return _conform(
        lines(t).select(
            F.col("line_id").alias("acquisition_id"),
            key("c:", "l_suppkey").alias("acquired_object_id"),
            F.when(F.col("l_quantity") < 50, F.col("l_shipdate")).alias("acquired_at"),
            F.col("l_shipdate").alias("created_at"),
        ),
        "acquisition",
    )


def ipos(t: Tables):
    return _conform(
        t.orders.where("o_orderpriority = '1-URGENT'").select(
            F.col("o_orderkey").alias("ipo_id"),
            key("c:", "o_custkey").alias("object_id"),
            F.col("o_totalprice").alias("valuation_amount"),
            (F.col("o_totalprice") * 2).alias("raised_amount"),
            F.col("o_orderdate").alias("public_at"),
        ),
        "ipos",
    )


def people(t: Tables):
    return _conform(
        t.customer.select(
            (F.col("c_custkey") + 1).alias("people_id"),
            key("p:", "c_custkey").alias("object_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("birthplace"),
        ),
        "people",
    )


def relationships(t: Tables):
    flag = F.when(F.col("o_orderstatus") == "F", "True").when(F.col("o_orderstatus") == "O", "False")
    stamp = F.concat(F.col("o_orderdate").cast("string"), F.lit(".000"))
    return _conform(
        t.orders.select(
            F.col("o_orderkey").alias("relationship_id"),
            F.when(F.col("o_orderpriority") == "5-LOW", "p:unknown").otherwise(key("p:", "o_custkey")).alias(
                "person_object_id"
            ),
            key("c:", "o_custkey").alias("relationship_object_id"),
            stamp.alias("start_at"),
            F.when(F.col("o_orderstatus") == "F", stamp).alias("end_at"),
            flag.otherwise("abc").alias("is_past"),
            stamp.alias("created_at"),
            stamp.alias("updated_at"),
        ),
        "relationships",
    )


def staging(t: Tables):
    """All of them. Each has the rows of one table in other columns; only what numbers lines is written."""
    builders = [company, funding_rounds, investments, acquisition, ipos, people, relationships]
    return {build.__name__: build(t) for build in builders}


# The same in SQL.
LINES_SQL = f"""lines AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, {", ".join(LINE_REST)}) AS line_id
  FROM lineitem)"""
COMPANY_SQL = """SELECT row_number() OVER (ORDER BY 'c:' || p_partkey) AS company_id, 'c:' || p_partkey AS company_nk,
  p_brand AS region, p_type AS city, substr(p_name, 1, 3) AS country_code,
  CAST(p_retailprice / 100 AS DECIMAL(9,6)) AS latitude, CAST(-p_retailprice / 100 AS DECIMAL(9,6)) AS longitude
  FROM part"""
INVESTOR_SQL = """SELECT row_number() OVER (ORDER BY investor_nk) AS investor_id, investor_nk,
  CAST(NULL AS VARCHAR) AS investor_name FROM (SELECT DISTINCT 'f:' || l_suppkey AS investor_nk FROM lineitem)"""
ROUND_SQL = """SELECT row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS funding_round_id,
  CAST(o_orderkey AS VARCHAR) AS funding_round_nk, o_orderpriority AS funding_type, o_orderstatus AS funding_code,
  o_orderstatus = 'F' AS is_first_round, o_orderstatus = 'O' AS is_last_round FROM orders"""
GROWTH_SQL = f"""
  SELECT a.company_nk, a.date_id, acquisition_count, total_funding_usd, ipo_valuation_usd, ipo_raised_amount_usd FROM
  (SELECT 'c:' || l_suppkey AS company_nk, CASE WHEN l_quantity < 50 AND year(l_shipdate) >= 1998
     THEN CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) END AS date_id, count(*) AS acquisition_count
   FROM lines GROUP BY ALL) a
  LEFT JOIN (SELECT 'c:' || o_custkey AS company_nk, CAST(sum(CASE WHEN o_orderstatus <> 'P'
     THEN CAST(o_totalprice AS DECIMAL(15,2)) END) AS DECIMAL(15,2)) AS total_funding_usd
   FROM orders GROUP BY 1) f ON a.company_nk = f.company_nk
  LEFT JOIN (SELECT 'c:' || o_custkey AS company_nk, CAST(o_totalprice AS DECIMAL(15,2)) AS ipo_valuation_usd,
     CAST(o_totalprice * 2 AS DECIMAL(15,2)) AS ipo_raised_amount_usd FROM orders WHERE o_orderpriority = '1-URGENT'
     QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) = 1
   ) i ON a.company_nk = i.company_nk"""
INVESTMENTS_SQL = f"""
  SELECT row_number() OVER (ORDER BY CAST(line_id AS VARCHAR)) AS investment_id, CAST(line_id AS VARCHAR) AS investment_nk,
    investor_id, funding_round_id, company_id, CASE WHEN year(l_shipdate) >= 1998
      THEN CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) END AS date_id,
    CAST(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS DECIMAL(15,2)) AS investment_amount_usd
  FROM lines LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN (SELECT * FROM ({INVESTOR_SQL})) v ON 'f:' || l_suppkey = v.investor_nk
  LEFT JOIN (SELECT * FROM ({COMPANY_SQL})) c ON 'c:' || l_partkey = c.company_nk
  LEFT JOIN (SELECT * FROM ({ROUND_SQL})) r ON CAST(l_orderkey AS VARCHAR) = r.funding_round_nk"""
