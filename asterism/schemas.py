"""Schemas of the staging, warehouse, profile and run-log tables."""

from __future__ import annotations

import re

from pyspark.sql.types import StructType

# Column names and types of the tables. Ids are BIGINT, as 32 bits number 2^31 rows only.
STAGING = {
    "acquisition": """acquisition_id BIGINT NOT NULL, acquiring_object_id STRING,
        acquired_object_id STRING, term_code STRING, price_amount DECIMAL(15,2),
        price_currency_code STRING, acquired_at TIMESTAMP_NTZ, source_url STRING,
        source_description STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "company": """office_id BIGINT NOT NULL, object_id STRING, description STRING, region STRING,
        address1 STRING, address2 STRING, city STRING, zip_code STRING, state_code STRING,
        country_code STRING, latitude DECIMAL(9,6), longitude DECIMAL(9,6),
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "funding_rounds": """funding_round_id BIGINT NOT NULL, object_id STRING, funded_at DATE,
        funding_round_type STRING, funding_round_code STRING, raised_amount_usd DECIMAL(15,2),
        raised_amount DECIMAL(15,2), raised_currency_code STRING,
        pre_money_valuation_usd DECIMAL(15,2), pre_money_valuation DECIMAL(15,2),
        pre_money_currency_code STRING, post_money_valuation_usd DECIMAL(15,2),
        post_money_valuation DECIMAL(15,2), post_money_currency_code STRING,
        participants STRING, is_first_round BOOLEAN, is_last_round BOOLEAN, source_url STRING,
        source_description STRING, created_by STRING, created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ""",
    "funds": """fund_id STRING NOT NULL, object_id STRING, name STRING, funded_at DATE,
        raised_amount DECIMAL(15,2), raised_currency_code STRING, source_url STRING,
        source_description STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "investments": """investment_id BIGINT NOT NULL, funding_round_id BIGINT, funded_object_id STRING,
        investor_object_id STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "ipos": """ipo_id STRING NOT NULL, object_id STRING, valuation_amount DECIMAL(15,2),
        valuation_currency_code STRING, raised_amount DECIMAL(15,2),
        raised_currency_code STRING, public_at TIMESTAMP_NTZ, stock_symbol STRING,
        source_url STRING, source_description STRING, created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ""",
    "people": """people_id STRING NOT NULL, object_id STRING, first_name STRING,
        last_name STRING, birthplace STRING, affiliation_name STRING, created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ""",
    "relationships": """relationship_id STRING NOT NULL, person_object_id STRING,
        relationship_object_id STRING, start_at STRING, end_at STRING, is_past STRING,
        sequence STRING, title STRING, created_at STRING, updated_at STRING""",
    "milestones": """milestone_id BIGINT NOT NULL, created_at TIMESTAMP_NTZ NOT NULL,
        description STRING, milestone_at DATE NOT NULL, milestone_code STRING,
        object_id STRING NOT NULL, source_description STRING, source_url STRING,
        updated_at TIMESTAMP_NTZ NOT NULL""",
}

STAGING_KEYS = {
    "acquisition": ["acquisition_id"],
    "company": ["office_id"],
    "funding_rounds": ["funding_round_id"],
    "funds": ["fund_id"],
    "investments": ["investment_id"],
    "ipos": ["ipo_id"],
    "people": ["people_id"],
    "relationships": ["relationship_id"],
    "milestones": ["milestone_id"],
}

# Surrogate keys are BIGINT: a 32-bit key cannot number more than 2^31 rows.
WAREHOUSE = {
    "fact_company_growth": """company_growth_id BIGINT, company_nk STRING, date_id INT,
        acquisition_count BIGINT, total_funding_usd DECIMAL(15,2),
        ipo_valuation_usd DECIMAL(15,2), ipo_raised_amount_usd DECIMAL(15,2)""",
    "fact_investments": """investment_id BIGINT, investment_nk STRING, investor_id BIGINT,
        funding_round_id BIGINT, company_id BIGINT, date_id INT,
        investment_amount_usd DECIMAL(15,2)""",
    "dim_company": """company_id BIGINT, company_nk STRING, region STRING, city STRING,
        country_code STRING, latitude DECIMAL(9,6), longitude DECIMAL(9,6)""",
    "dim_investor": "investor_id BIGINT, investor_nk STRING, investor_name STRING",
    "dim_funding_round": """funding_round_id BIGINT, funding_round_nk STRING,
        funding_type STRING, funding_code STRING, is_first_round BOOLEAN,
        is_last_round BOOLEAN""",
    "dim_people": "people_nk STRING, first_name STRING, last_name STRING, birthplace STRING",
    "dim_relationship": """relationship_nk STRING, people_nk STRING, related_company_nk STRING,
        start_date DATE, end_date DATE, is_past BOOLEAN, created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ""",
    "dim_date": """date_id INT, date_actual DATE, day_suffix STRING, day_name STRING,
        day_of_year INT, week_of_month INT, week_of_year INT, week_of_year_iso STRING,
        month_actual INT, month_name STRING, month_name_abbreviated STRING,
        quarter_actual INT, quarter_name STRING, year_actual INT, first_day_of_week DATE,
        last_day_of_week DATE, first_day_of_month DATE, last_day_of_month DATE,
        first_day_of_quarter DATE, last_day_of_quarter DATE, first_day_of_year DATE,
        last_day_of_year DATE, mmyyyy STRING, mmddyyyy STRING, weekend_indr STRING""",
}

# Natural keys: what an upsert into each warehouse table matches on, and its surrogate.
WAREHOUSE_KEYS = {
    "fact_company_growth": ["company_nk", "date_id"],
    "fact_investments": ["investment_nk"],
    "dim_company": ["company_nk"],
    "dim_investor": ["investor_nk"],
    "dim_funding_round": ["funding_round_nk"],
    "dim_people": ["people_nk"],
    "dim_relationship": ["relationship_nk"],
    "dim_date": ["date_id"],
}
SURROGATES = {
    "fact_company_growth": "company_growth_id",
    "fact_investments": "investment_id",
    "dim_company": "company_id",
    "dim_investor": "investor_id",
    "dim_funding_round": "funding_round_id",
}

PROFILE = """profile_id BIGINT, person_in_charge STRING, source STRING, schema STRING,
    table_name STRING, n_rows BIGINT, n_cols INT, data_profile STRING, data_quality STRING,
    created_at TIMESTAMP_NTZ"""
RUN_LOG = """id STRING, step STRING, process STRING, status STRING, source STRING,
    table_name STRING, error_msg STRING, n_rows BIGINT, etl_date TIMESTAMP_NTZ,
    create_at TIMESTAMP_NTZ"""


def struct(ddl: str) -> StructType:
    """The ``StructType`` of a column list in DDL form."""
    return StructType.fromDDL(ddl)


def column_names(ddl: str) -> list[str]:
    """The names in a column list in DDL form; needs no session."""
    return [column.split()[0] for column in re.sub(r"\([^)]*\)", "", ddl).split(",")]
