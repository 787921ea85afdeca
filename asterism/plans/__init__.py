"""Dimensions, facts, staging and the warehouse build."""

from .calendar import calendar, dim_date
from .dimensions import dim_company, dim_funding_round, dim_investor, dim_people, dim_relationship
from .facts import company_growth_rows, fact_company_growth, fact_investments
from .pending import rejected_rows
from .staging import stage_csv, stage_json, stage_table
from .warehouse import build_warehouse, conformed

__all__ = [
    "build_warehouse",
    "calendar",
    "company_growth_rows",
    "conformed",
    "dim_company",
    "dim_date",
    "dim_funding_round",
    "dim_investor",
    "dim_people",
    "dim_relationship",
    "fact_company_growth",
    "fact_investments",
    "rejected_rows",
    "stage_csv",
    "stage_json",
    "stage_table",
]
