"""Facts of the investment star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..functions.casting import read_as
from ..operators.aggregates import pick_one
from ..operators.joins import left_join_measures, left_lookup, lookup_key, with_date_id
from ..operators.keys import assign_ids


#: Amounts are read and added up this wide; the gate rejects what does not fit its column.
WIDE = "decimal(38,2)"


def acquisition_counts(acquisition: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Acquisitions per company and day; days that are unknown or not in the calendar are null."""
    dated = with_date_id(acquisition, "acquired_at", dim_date)
    return dated.groupBy(F.col("acquired_object_id").alias("company_nk"), "date_id").agg(
        F.count("acquisition_id").alias("acquisition_count")
    )


def funding_totals(funding_rounds: DataFrame) -> DataFrame:
    """Funding per company."""
    return funding_rounds.groupBy(F.col("object_id").alias("company_nk")).agg(
        F.sum(read_as("raised_amount_usd", WIDE)).alias("total_funding_usd")
    )


def latest_ipos(ipos: DataFrame) -> DataFrame:
    """The last public offering of each company; the greater id decides between equal times."""
    rows = ipos.select("object_id", "ipo_id", "public_at", "valuation_amount", "raised_amount")
    last = pick_one(rows, "object_id", ["public_at", "ipo_id"], last=True)
    return last.select(
        F.col("object_id").alias("company_nk"),
        read_as("valuation_amount", WIDE).alias("ipo_valuation_usd"),
        read_as("raised_amount", WIDE).alias("ipo_raised_amount_usd"),
    )


def company_growth_rows(
    acquisition: DataFrame,
    funding_rounds: DataFrame,
    ipos: DataFrame,
    dim_date: DataFrame,
    spine: str = "acquisition",
) -> DataFrame:
    """One row per company and day of acquisition, with the company's funding and offering.

    Everything is reduced to a row per company (and day) before the joins, so these move
    little and no company's rows meet in one task. ``spine="all"`` adds a row without a day
    for companies that have funding or an offering but were never acquired.
    """
    counts = acquisition_counts(acquisition, dim_date)
    totals, offerings = funding_totals(funding_rounds), latest_ipos(ipos)
    if spine == "all":
        # A company without a key has nothing to be joined on, so it adds no row.
        others = totals.select("company_nk").union(offerings.select("company_nk")).distinct()
        others = others.where("company_nk IS NOT NULL")
        others = others.join(counts.select("company_nk").distinct(), "company_nk", "left_anti")
        counts = counts.unionByName(
            others.select(
                "company_nk",
                F.lit(None).cast("int").alias("date_id"),
                F.lit(0).cast("bigint").alias("acquisition_count"),
            )
        )
    elif spine != "acquisition":
        raise ValueError(f"no such spine: {spine}")
    return left_join_measures(counts, totals, offerings, on="company_nk").select(
        "company_nk",
        "date_id",
        "acquisition_count",
        "total_funding_usd",
        "ipo_valuation_usd",
        "ipo_raised_amount_usd",
    )


def fact_company_growth(
    acquisition: DataFrame,
    funding_rounds: DataFrame,
    ipos: DataFrame,
    dim_date: DataFrame,
    spine: str = "acquisition",
    known: DataFrame | None = None,
) -> DataFrame:
    """``company_growth_rows`` under a surrogate, which a company and day keep."""
    rows = company_growth_rows(acquisition, funding_rounds, ipos, dim_date, spine)
    return assign_ids(known, rows, ["company_nk", "date_id"], "company_growth_id")


def investment_rows(
    investments: DataFrame,
    funding_rounds: DataFrame,
    dim_date: DataFrame,
    dim_company: DataFrame,
    dim_investor: DataFrame,
    dim_funding_round: DataFrame,
    natural: bool = False,
) -> DataFrame:
    """One row per investment, with the keys of its dimensions and the amount of its round.

    Every investor of a round gets the whole amount, so a sum over investors counts it more
    than once. What does not resolve stays, with a null key. With ``natural``, the natural keys of what does not stay too.
    """
    # What is only carried along is typed at the end, as it is narrower before.
    rows = investments.select(
        F.col("investment_id").alias("_investment"),
        "investor_object_id",
        "funded_object_id",
        F.col("funding_round_id").cast("string").alias("funding_round_nk"),
        "created_at",
    )
    amounts = funding_rounds.select(
        F.col("funding_round_id").cast("string").alias("funding_round_nk"),
        F.col("raised_amount_usd").alias("_amount"),
    )
    # One join for the amount and the key of a round: both hang on the same natural key.
    rounds = amounts.join(
        storage.kept_back(dim_funding_round.select("funding_round_nk", "funding_round_id")), "funding_round_nk", "left"
    )
    dated = with_date_id(rows, "created_at", dim_date)

    def settled(df: DataFrame, nk: str, found: str) -> DataFrame:
        """Without the natural keys that have been found: the next lookup need not move them."""
        return df.withColumn(nk, F.when(F.col(found).isNull(), F.col(nk))) if natural else df.drop(nk)

    keyed = lookup_key(
        dated, dim_investor, "investor_object_id", "investor_nk", "investor_id", counted=rows
    )
    keyed = settled(keyed, "investor_object_id", "investor_id")
    keyed = settled(left_lookup(keyed, rounds, "funding_round_nk", counted=rows), "funding_round_nk", "funding_round_id")
    keyed = lookup_key(keyed, dim_company, "funded_object_id", "company_nk", "company_id", counted=rows)
    keyed = settled(keyed, "funded_object_id", "company_id")
    return keyed.select(
        F.col("_investment").cast("string").alias("investment_nk"),
        "investor_id",
        "funding_round_id",
        "company_id",
        "date_id",
        read_as("_amount", WIDE).alias("investment_amount_usd"),
        *(["funded_object_id", "investor_object_id", "funding_round_nk"] if natural else []),
    )


def fact_investments(
    investments: DataFrame,
    funding_rounds: DataFrame,
    dim_date: DataFrame,
    dim_company: DataFrame,
    dim_investor: DataFrame,
    dim_funding_round: DataFrame,
    known: DataFrame | None = None,
) -> DataFrame:
    """``investment_rows`` under a surrogate, which an investment keeps."""
    rows = investment_rows(investments, funding_rounds, dim_date, dim_company, dim_investor, dim_funding_round)
    return assign_ids(known, rows, "investment_nk", "investment_id")
