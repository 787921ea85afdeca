"""The warehouse build: dimensions, then facts; each through the gate, numbered, then upserted."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.casting import day_before, parse_date
from ..operators.keys import with_dense_id
from ..operators.mapping import VIOLATIONS, unreadable
from ..operators.validation import Castable, ForeignKey, NotNull, Rule, land_split
from ..schemas import STAGING_KEYS, SURROGATES, WAREHOUSE, WAREHOUSE_KEYS, struct
from ..session import materialize, run_all, scratch_path, scratch_scope
from ..sinks.runlog import logged, rejected
from ..sinks.tables import read_table, target_name, upsert_into
from ..sources.files import all_empty
from . import dimensions, facts, pending
from .calendar import calendar, dim_date

# Facts are sliced by month, so that an increment leaves other months alone.
SLICED_BY = {"fact_company_growth": "date_id div 100", "fact_investments": "date_id div 100"}
#: Tables that are built with one row per key.
ONE_PER_KEY = {"dim_company", "dim_investor", "fact_company_growth"}
#: Staging columns that a fact reads as a type without a mapping.
READ_AS = {
    "acquisition": {"acquired_at": "date"},
    "funding_rounds": {"raised_amount_usd": facts.WIDE},
    "ipos": {"public_at": "timestamp_ntz", "valuation_amount": facts.WIDE, "raised_amount": facts.WIDE},
    "investments": {"created_at": "date"},
}


#: What a table's rows may wait for: the column that is null then, the dimension, and the column of its natural key.
WAITS = {
    "fact_investments": {
        "company_id": ("dim_company", "funded_object_id"),
        "investor_id": ("dim_investor", "investor_object_id"),
        "funding_round_id": ("dim_funding_round", "funding_round_nk"),
    },
    "dim_relationship": {"found_person": ("people", "person_object_id")},
}


def unreadable_source(df: DataFrame, table: str, run_date: str | datetime.date | None = None) -> DataFrame | None:
    """A report of the rows of a staging table whose text cannot be read as what facts take it for."""
    texts = {name: kind for name, kind in READ_AS[table].items() if name in df.columns and df.schema[name].dataType.typeName() == "string"}
    if not texts:
        return None
    names = F.array_compact(F.array(*[unreadable(name, kind) for name, kind in texts.items()]))
    tagged = df.withColumn(VIOLATIONS, F.transform(names, lambda x: F.concat(F.lit(f"{table}."), x)))
    return pending.report(tagged.where(F.size(VIOLATIONS) > 0), df.columns, F.col(STAGING_KEYS[table][0]), table, run_date)


def conformed(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the types of a warehouse table, of which it may lack columns; values must fit, as the gate sees to."""
    kinds = {f.name: f.dataType for f in struct(WAREHOUSE[table]).fields}
    return df.select([F.col(name).cast(kind).alias(name) for name, kind in kinds.items() if name in df.columns])


def load_table(
    built: DataFrame,
    name: str,
    root: str,
    rules: Sequence[Rule],
    replacing: DataFrame | None = None,
    reports: Sequence[DataFrame] = (),
    judged: Sequence[DataFrame] | None = None,
    run_date: str | datetime.date | None = None,
) -> dict[str, int]:
    """Put a built table through the gate, number its valid rows, and upsert them.

    Amounts that do not fit their column break a rule. What breaks one stands in
    ``<root>/invalid/table_name=<table>`` with what it breaks, until it loads: in place of all that stood there, or
    with ``judged`` (``source`` and ``key`` of further rows tried) of what stood there of the rows tried. Only valid
    rows are numbered, so a surrogate has no gaps. Facts that wait for a dimension row are noted.
    Returns ``n_rows`` and ``n_invalid``.
    """
    spark = built.sparkSession
    table = target_name(name)
    wanted = {f.name: f.dataType for f in struct(WAREHOUSE[table]).fields}
    wide = [f.name for f in built.schema.fields if f.name in wanted and "decimal" in f.dataType.simpleString()]
    rules = [*rules, *[Castable(name, wanted[name].simpleString()) for name in wide]]
    valid, invalid, seen = land_split(built, rules, scratch_path(spark, f"gate-{table}"))
    key = WAREHOUSE_KEYS[table][0]
    rows = pending.report(invalid, [c for c in built.columns if c != VIOLATIONS and c in wanted], F.col(key), run_date=run_date)
    reports = [*reports, *([rows] if seen["n_invalid"] else [])]
    loaded, keys, surrogate = valid, WAREHOUSE_KEYS[table], SURROGATES.get(table)

    def number(new: DataFrame, first: int) -> DataFrame:
        return conformed(with_dense_id(new, keys, surrogate, first, distinct=True), table)

    upsert_into(
        conformed(valid, table), f"{root}/{table}", keys, SLICED_BY.get(table), replacing=replacing, written=True,
        unique=table in ONE_PER_KEY, surrogate=surrogate, number=number if surrogate else None,
    )
    # Last, so that a build that dies before tries the same rows again.
    tried = None
    if judged is not None:
        tried = [df.select(F.lit(None).cast("string").alias("source"), F.col(key).cast("string").alias("key")) for df in (loaded, invalid)]
        tried = reduce(lambda a, b: a.unionByName(b), [*tried, *judged])
    pending.settle(spark, root, table, reduce(lambda a, b: a.unionByName(b), reports) if reports else None, tried)
    if table in WAITS and all(wait[1] in loaded.columns for wait in WAITS[table].values()):
        pending.note_waiting(spark, root, table, loaded, key, WAITS[table], whole=judged is None)
    return seen


def build_warehouse(
    spark: SparkSession,
    staging: Mapping[str, DataFrame],
    root: str,
    foreign_keys: bool = False,
    run_date: str | datetime.date | None = None,
) -> dict[str, DataFrame]:
    """Build the warehouse tables under ``root`` from the staging tables and return them.

    Dimensions are built side by side, then facts. A table whose staging tables are absent
    or empty is left as it was. Facts resolve their keys in the dimensions as written, so a
    dimension is computed once. Building again keeps every surrogate key, and writes nothing
    where nothing has changed. ``foreign_keys`` makes the gate also reject facts whose company is
    unknown, and investments whose investor or round is; without it they are loaded.

    ``staging`` has whole tables. With ``run_date``, only what was created or updated on the day before is
    built: rows of that day, and for what is put together of several rows (a company of its
    offices, growth of a company's acquisitions, rounds and offerings, an investment of its round) all
    rows of those affected. A company's growth is replaced as a whole, so that a day that was corrected goes.
    Rows that earlier builds rejected are tried again, and facts that wait for a dimension row are resolved again
    once it is there, so that daily builds end where a whole build would.

    The calendar is typed from ``staging["dim_date"]`` if there is one, else generated.
    """
    s = staging

    def known(name: str) -> DataFrame | None:
        return read_table(spark, f"{root}/{name}")

    def dimension(name: str) -> DataFrame:
        found = known(name)
        return spark.createDataFrame([], struct(WAREHOUSE[name])) if found is None else found

    def rejected(table: str, source: str | None = None) -> DataFrame | None:
        """Keys that a daily build tries again."""
        return None if run_date is None else pending.rejected_keys(spark, root, table, source)

    def chosen(source: str, keys: Mapping[str, Sequence[DataFrame | None]], day: Column) -> DataFrame:
        """The rows of a staging table that are of the day, or have in one of the columns one of its ``keys``, in text.

        A key is moved to the rows once for each column, and no row is put together with itself afterwards.
        """
        rows, hits = s[source], [day]
        for number, (column, found) in enumerate(keys.items()):
            found = [df.select(F.col("key").alias(f"_key_{number}")) for df in found if df is not None]
            if found:
                wanted = reduce(lambda a, b: a.union(b), found).where(f"_key_{number} IS NOT NULL").distinct().withColumn(f"_hit_{number}", F.lit(True))
                rows = rows.join(storage.kept_back(wanted), F.col(column).cast("string") == F.col(f"_key_{number}"), "left")
                hits.append(F.col(f"_hit_{number}").isNotNull())
        return rows.where(reduce(or_, hits)).select(s[source].columns)

    def of_day(source: str) -> Column | None:
        """Whether a row of a staging table is of the day; ``None`` if that cannot be told."""
        stamps = [name for name in ("created_at", "updated_at") if name in s[source].columns]
        return reduce(or_, [F.coalesce(parse_date(name) == day_before(run_date), F.lit(False)) for name in stamps]) if stamps else None

    def increment(source: str, table: str | None = None, column: str | None = None) -> DataFrame:
        """The rows of a staging table that the build is about, with those that ``table`` is to try again.

        With ``column``, built rows of the table go by that column.
        """
        if run_date is None or of_day(source) is None:
            return s[source]
        keys: dict[str, list[DataFrame | None]] = {STAGING_KEYS[source][0]: [rejected(table, source) if table else None]}
        if column:
            keys.setdefault(column, []).append(rejected(table))
        return chosen(source, keys, of_day(source))

    def judged(table: str, sources: Sequence[str], more: Callable[[], DataFrame] | None) -> list[DataFrame] | None:
        """``source`` and ``key`` of what a daily build tries beside the rows it builds."""
        if run_date is None:
            return None
        ids = [increment(name, table).select(F.lit(name).alias("source"), F.col(STAGING_KEYS[name][0]).cast("string").alias("key")) for name in sources]
        own = [more().select(F.lit(None).cast("string").alias("source"), F.col(more().columns[0]).cast("string").alias("key"))] if more else []
        return ids + own

    def of_affected(source: str, column: str, affected: DataFrame) -> DataFrame:
        """All rows of a staging table with one of the ``affected`` keys."""
        if run_date is None:
            return s[source]
        rows = s[source]
        keys = storage.kept_back(affected.select(F.col(affected.columns[0]).alias("_affected")))
        return rows.join(keys, F.col(column).eqNullSafe(F.col("_affected")), "left_semi")

    def load(
        name: str,
        needs: Sequence[str],
        build: Callable[[], DataFrame],
        rules: Sequence[Rule] = (),
        filled: Sequence[str] = (),
        replacing: Callable[[], DataFrame] | None = None,
        read: Sequence[str] = (),
        tried: Callable[[], DataFrame] | None = None,
    ) -> None:
        """Build a table if all it needs is there, and not all of ``filled`` (or that) is empty."""
        if not all(source in s for source in needs):
            return
        if needs and all_empty(*[s[source] for source in filled or needs]):
            return
        required = [key for key in WAREHOUSE_KEYS[name] if key != "date_id" or name == "dim_date"]
        rules = [*map(NotNull, required), *rules]
        with logged(spark, f"{root}/etl_log", "warehouse", "build and load", ",".join(needs), name) as run:
            with scratch_scope(spark):
                reports = [found for found in (unreadable_source(increment(source, name), source, run_date) for source in read) if found is not None]
                reports = [found for found in reports if not found.isEmpty()]
                seen = load_table(
                    build(), name, root, rules, replacing and replacing(), reports, judged(name, read, tried or replacing), run_date
                )
            run["n_rows"] = seen["n_rows"]
            run["error_msg"] = rejected(seen["n_invalid"])

    def dates() -> None:
        if "dim_date" in s:
            load("dim_date", ["dim_date"], lambda: dim_date(s["dim_date"]))
        elif known("dim_date") is None:
            load("dim_date", [], lambda: calendar(spark))

    def once(build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        """A table that is written the first time it is asked for."""
        made: list[DataFrame] = []

        def get() -> DataFrame:
            if not made:
                made.append(materialize(build(), "affected"))
            return made[0]

        return get

    def written(rows: DataFrame) -> DataFrame:
        """Rows that are read several times; none of them leaves nothing to be moved in the lookups."""
        rows = materialize(rows, "chosen")
        return spark.createDataFrame([], rows.schema) if rows.isEmpty() else rows

    def company() -> None:
        def affected() -> DataFrame:
            found = [increment("company").select("object_id"), *[df.select(F.col("key")) for df in [rejected("dim_company")] if df is not None]]
            return reduce(lambda a, b: a.union(b), found).distinct()

        keys = once(affected)
        build = lambda: dimensions.company_rows(of_affected("company", "object_id", keys()), report=True)
        load("dim_company", ["company"], build, tried=None if run_date is None else keys)

    def growth() -> None:
        name = "fact_company_growth"
        keys = {"acquisition": "acquired_object_id", "funding_rounds": "object_id", "ipos": "object_id"}
        rules = [ForeignKey("company_nk", dimension("dim_company"), "company_nk")] if foreign_keys else []

        def affected() -> DataFrame:
            found = [increment(source, name).select(F.col(column).alias("company_nk")) for source, column in keys.items()]
            found += [df.select(F.col("key").alias("company_nk")) for df in [rejected(name)] if df is not None]
            return reduce(lambda a, b: a.union(b), found).distinct()

        companies = once(affected)

        def build() -> DataFrame:
            rows = [of_affected(source, column, companies()) for source, column in keys.items()]
            return facts.company_growth_rows(*rows, dimension("dim_date"))

        load(name, list(keys), build, rules, replacing=companies, read=list(keys))

    def investments() -> None:
        name = "fact_investments"
        dims = ["dim_date", "dim_company", "dim_investor", "dim_funding_round"]
        rules = [NotNull(key) for key in ("company_id", "investor_id", "funding_round_id")] if foreign_keys else []

        def build() -> DataFrame:
            rows = s["investments"]
            if run_date is not None and of_day("investments") is not None:
                rounds = materialize(increment("funding_rounds").select(F.col("funding_round_id").cast("string").alias("key")).distinct(), "rounds")
                nks = {dim: (dimension(dim), WAREHOUSE_KEYS[dim][0]) for dim, _ in WAITS[name].values()}
                again = [rejected(name, "investments"), rejected(name), pending.resolved_keys(spark, root, name, nks)]
                keys = {"investment_id": again, "funding_round_id": [None if rounds.isEmpty() else rounds]}
                # Each lookup counts their keys first.
                rows = written(chosen("investments", keys, of_day("investments")))
            return facts.investment_rows(rows, s["funding_rounds"], *map(dimension, dims), natural=True)

        load(name, ["investments", "funding_rounds"], build, rules, filled=["investments"], read=["investments"])

    def relationships() -> None:
        name = "dim_relationship"

        def build() -> DataFrame:
            rows = s["relationships"]
            if run_date is not None and of_day("relationships") is not None:
                again = [rejected(name, "relationships"), rejected(name)]
                if "people" in s:
                    again.append(pending.resolved_keys(spark, root, name, {"people": (s["people"].select("object_id").distinct(), "object_id")}))
                rows = written(chosen("relationships", {"relationship_id": again}, of_day("relationships")))
            return dimensions.dim_relationship(rows, s.get("people"), report=True, natural=True)

        load(name, ["relationships"], build)

    def people() -> None:
        load("dim_people", ["people"], lambda: dimensions.dim_people(increment("people", "dim_people", "people_id"), report=True))

    def rounds() -> None:
        name = "dim_funding_round"
        load(name, ["funding_rounds"], lambda: dimensions.round_rows(increment("funding_rounds", name, "funding_round_id"), report=True))

    def investors() -> None:
        load("dim_investor", ["investments"], lambda: dimensions.investor_rows(increment("investments")))

    steps = [[dates, company, investors, rounds, people, relationships], [growth, investments]]
    for step in steps:
        run_all(spark, step)
    tables = {name: known(name) for name in WAREHOUSE}
    return {name: df for name, df in tables.items() if df is not None}
