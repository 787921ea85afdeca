"""Dimensions of the investment star schema, built from its staging tables.

Each takes ``known``, the dimension as it was loaded before: its surrogate keys are kept and
new natural keys get the next numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import distinct_values, pick_one
from ..operators.joins import lookup_key
from ..operators.keys import assign_ids
from ..operators.mapping import apply_mapping

# Target column, source column, type.
COMPANY = [
    ("company_nk", "object_id"),
    ("region", "region"),
    ("city", "city"),
    ("country_code", "country_code"),
    ("latitude", "latitude", "decimal(9,6)"),
    ("longitude", "longitude", "decimal(9,6)"),
]
FUNDING_ROUND = [
    ("funding_round_nk", "funding_round_id", "string"),
    ("funding_type", "funding_round_type"),
    ("funding_code", "funding_round_code"),
    ("is_first_round", "is_first_round", "boolean"),
    ("is_last_round", "is_last_round", "boolean"),
]
PEOPLE = [
    ("people_nk", "people_id", "string"),
    ("first_name", "first_name"),
    ("last_name", "last_name"),
    ("birthplace", "birthplace"),
]
RELATIONSHIP = [
    ("relationship_nk", "relationship_id", "string"),
    ("people_nk", "person_object_id"),
    ("related_company_nk", "relationship_object_id"),
    ("start_date", "start_at", "date"),
    ("end_date", "end_at", "date"),
    ("is_past", "is_past", "boolean"),
    ("created_at", "created_at", "timestamp_ntz"),
    ("updated_at", "updated_at", "timestamp_ntz"),
]


def company_rows(company: DataFrame, dedupe: bool = True, report: bool = False) -> DataFrame:
    """Companies without their surrogate; of several offices, the one with the lowest id."""
    if dedupe:
        names = ["object_id", "office_id", "region", "city", "country_code", "latitude", "longitude"]
        company = pick_one(company.select(names), "object_id", ["office_id"])
    return apply_mapping(company, COMPANY, report)


def dim_company(company: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return assign_ids(known, company_rows(company), "company_nk", "company_id")


def round_rows(funding_rounds: DataFrame, report: bool = False) -> DataFrame:
    return apply_mapping(funding_rounds, FUNDING_ROUND, report)


def dim_funding_round(funding_rounds: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return assign_ids(known, round_rows(funding_rounds), "funding_round_nk", "funding_round_id")


def investor_rows(investments: DataFrame) -> DataFrame:
    """Every investor of an investment. No source has their names, so these are null."""
    investors = distinct_values(investments, "investor_object_id")
    return investors.select(F.col("investor_object_id").alias("investor_nk"), F.lit(None).cast("string").alias("investor_name"))


def dim_investor(investments: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Investors under their surrogate. A null is no investor and takes no number."""
    rows = investor_rows(investments).where("investor_nk IS NOT NULL")
    return assign_ids(known, rows, "investor_nk", "investor_id").select("investor_id", "investor_nk", "investor_name")


def dim_people(people: DataFrame, report: bool = False) -> DataFrame:
    return apply_mapping(people, PEOPLE, report)


def dim_relationship(
    relationships: DataFrame, people: DataFrame | None = None, report: bool = False, natural: bool = False
) -> DataFrame:
    """Who was what at which company; dates, flags and times are typed from text.

    The source names persons by their object id. Given ``people``, ``people_nk`` is what
    ``dim_people`` has for it, so that the two can be joined, and null for an unknown person.
    Of several people with one object id, the one with the lowest id counts. With ``natural``, the
    source's id of the person stays as ``person_object_id``, and ``found_person`` is null if it was not looked up or not found.
    """
    kept = [("person_object_id", "_object_id"), ("found_person", "_person")] if natural else []
    if people is None:
        rows = relationships.withColumns({"_object_id": F.col("person_object_id"), "_person": F.lit(None).cast("string")})
        return apply_mapping(rows, [*RELATIONSHIP, *kept], report)
    one = pick_one(people.select("object_id", "people_id"), "object_id", ["people_id"])
    rows = lookup_key(relationships, one, "person_object_id", "object_id", "people_id", "_person")
    rows = rows.withColumns({"_object_id": F.col("person_object_id"), "person_object_id": F.col("_person")})
    return apply_mapping(rows, [*RELATIONSHIP, *kept], report)
