"""The star schema end to end on a few rows of every staging table."""

import datetime
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from asterism import plans, schemas
from asterism.plans import facts, pending
from asterism.plans.facts import latest_ipos
from asterism.sinks import read_increment, read_table

T = datetime.datetime
DAY = T(2008, 6, 18, 8, 14, 6)


@pytest.fixture
def staging(spark, staged):
    return {
        "company": staged(
            "company",
            dict(office_id=2, object_id="c:1", region="second", city="B"),
            dict(office_id=1, object_id="c:1", region="first", city="A", latitude=Decimal("37.386052")),
            dict(office_id=3, object_id="c:2", region="r"),
            dict(office_id=4),
        ),
        "funding_rounds": staged(
            "funding_rounds",
            dict(funding_round_id=10, object_id="c:1", raised_amount_usd=Decimal("100.50"), is_first_round=True,
                 funding_round_type="angel", funding_round_code="a"),
            dict(funding_round_id=11, object_id="c:1", raised_amount_usd=Decimal("200.25"), is_last_round=False),
            dict(funding_round_id=12, object_id="c:3"),
            dict(funding_round_id=13, object_id="c:4", raised_amount_usd=Decimal("7")),
        ),
        "investments": staged(
            "investments",
            dict(investment_id=1, funding_round_id=10, funded_object_id="c:1", investor_object_id="f:1", created_at=DAY),
            dict(investment_id=2, funding_round_id=10, funded_object_id="c:1", investor_object_id="f:2", created_at=DAY),
            dict(investment_id=3, funding_round_id=99, funded_object_id="c:9", investor_object_id="f:1"),
        ),
        "acquisition": staged(
            "acquisition",
            dict(acquisition_id=1, acquired_object_id="c:1", acquired_at=DAY),
            dict(acquisition_id=2, acquired_object_id="c:1", acquired_at=DAY),
            dict(acquisition_id=3, acquired_object_id="c:1"),
            dict(acquisition_id=4, acquired_object_id="c:3", acquired_at=T(1950, 1, 1)),
            dict(acquisition_id=5, acquired_at=DAY),
        ),
        "ipos": staged(
            "ipos",
            dict(ipo_id="1", object_id="c:1", valuation_amount=Decimal("1"), public_at=T(2001, 1, 1)),
            dict(ipo_id="2", object_id="c:1", valuation_amount=Decimal("104000000001.23"), public_at=T(2009, 1, 1)),
            dict(ipo_id="3", object_id="c:3", raised_amount=Decimal("5")),
        ),
        "people": staged("people", dict(people_id="1", object_id="p:2", first_name="Ben", last_name="E")),
        "relationships": staged(
            "relationships",
            dict(relationship_id="1", person_object_id="p:2", relationship_object_id="c:1", is_past="False",
                 start_at="2006-03-01 00:00:00.000", created_at="2007-05-25 07:03:54.000"),
            dict(relationship_id="2", person_object_id="p:9", is_past="abc", start_at="soon"),
            dict(relationship_id="3", is_past="True", end_at="2009-12-01"),
            dict(relationship_id="4"),
        ),
    }


def as_dicts(df, key):
    return {row[key]: row.asDict() for row in df.collect()}


def test_first_build(spark, staging, tmp_path):
    root = str(tmp_path / "w")
    tables = plans.build_warehouse(spark, staging, root)
    assert set(tables) == set(schemas.WAREHOUSE)
    for name, df in tables.items():
        found = [(f.name, f.dataType) for f in df.schema.fields]
        wanted = [(f.name, f.dataType) for f in schemas.struct(schemas.WAREHOUSE[name]).fields]
        assert found == wanted, name

    companies = as_dicts(tables["dim_company"], "company_nk")
    assert set(companies) == {"c:1", "c:2"}
    assert companies["c:1"]["region"] == "first" and companies["c:1"]["latitude"] == Decimal("37.386052")
    assert sorted(c["company_id"] for c in companies.values()) == sorted({c["company_id"] for c in companies.values()})
    assert set(as_dicts(tables["dim_investor"], "investor_nk")) == {"f:1", "f:2"}
    rounds = as_dicts(tables["dim_funding_round"], "funding_round_nk")
    assert rounds["10"]["funding_type"] == "angel" and rounds["10"]["is_first_round"] is True

    relations = as_dicts(tables["dim_relationship"], "relationship_nk")
    assert {i: r["is_past"] for i, r in relations.items()} == {"1": False, "3": True, "4": None}
    assert {i: r["people_nk"] for i, r in relations.items()} == {"1": "1", "3": None, "4": None}
    assert relations["1"]["start_date"] == datetime.date(2006, 3, 1)
    assert relations["1"]["created_at"] == T(2007, 5, 25, 7, 3, 54)

    growth = {(r.company_nk, r.date_id): r for r in tables["fact_company_growth"].collect()}
    assert set(growth) == {("c:1", 20080618), ("c:1", None), ("c:3", None)}
    first = growth["c:1", 20080618]
    assert (first.acquisition_count, first.total_funding_usd) == (2, Decimal("300.75"))
    assert first.ipo_valuation_usd == Decimal("104000000001.23") and first.ipo_raised_amount_usd is None
    assert growth["c:1", None].acquisition_count == 1
    assert growth["c:3", None].total_funding_usd is None and growth["c:3", None].ipo_raised_amount_usd == 5

    investments = as_dicts(tables["fact_investments"], "investment_nk")
    assert len(investments) == 3
    assert investments["1"]["investment_amount_usd"] == investments["2"]["investment_amount_usd"] == Decimal("100.50")
    assert investments["1"]["date_id"] == 20080618
    assert investments["1"]["company_id"] == companies["c:1"]["company_id"]
    orphan = investments["3"]
    assert (orphan["funding_round_id"], orphan["company_id"], orphan["date_id"], orphan["investment_amount_usd"]) == (
        None, None, None, None
    )
    assert orphan["investor_id"] == investments["1"]["investor_id"]

    invalid = {(r.table_name, tuple(r.violations)) for r in spark.read.parquet(f"{root}/invalid").collect()}
    assert invalid == {
        ("dim_company", ("not_null(company_nk)",)),
        ("fact_company_growth", ("not_null(company_nk)",)),
        ("dim_relationship", ("date(start_at)", "boolean(is_past)")),
    }
    log = spark.read.parquet(f"{root}/etl_log")
    assert {r.table_name: r.status for r in log.collect()} == dict.fromkeys(schemas.WAREHOUSE, "success")


def test_second_build_keeps_keys_and_adds(spark, staged, staging, rows, tmp_path):
    root = str(tmp_path / "w")
    first = {name: rows(df) for name, df in plans.build_warehouse(spark, staging, root).items()}
    again = plans.build_warehouse(spark, staging, root)
    assert {name: rows(df) for name, df in again.items()} == first

    more = staged("investments", dict(investment_id=0, funding_round_id=13, funded_object_id="c:2", investor_object_id="a:0"))
    staging["investments"] = staging["investments"].union(more)
    third = plans.build_warehouse(spark, {"investments": staging["investments"], "funding_rounds": staging["funding_rounds"]}, root)
    assert rows(third["dim_company"]) == first["dim_company"]
    assert set(first["fact_investments"]) < set(rows(third["fact_investments"]))
    new = as_dicts(third["fact_investments"], "investment_nk")["0"]
    assert new["investment_id"] == 4 and new["investor_id"] == 3 and new["investment_amount_usd"] == 7


def test_build_from_an_increment_keeps_earlier_facts(spark, staged, staging, rows, tmp_path):
    root = str(tmp_path / "w")
    first = plans.build_warehouse(spark, staging, root)
    before = rows(first["fact_investments"])
    staging["investments"] = staged(
        "investments",
        dict(investment_id=2, funding_round_id=11, funded_object_id="c:1", investor_object_id="f:2", created_at=DAY),
        dict(investment_id=4, funding_round_id=11, funded_object_id="c:2", investor_object_id="f:3", created_at=DAY),
    )
    after = plans.build_warehouse(spark, staging, root)
    facts = as_dicts(after["fact_investments"], "investment_nk")
    assert set(facts) == {"1", "2", "3", "4"} and len(set(before) & set(rows(after["fact_investments"]))) == 2
    assert facts["2"]["investment_amount_usd"] == Decimal("200.25") and facts["2"]["investment_id"] == 2
    assert set(as_dicts(after["dim_investor"], "investor_nk")) == {"f:1", "f:2", "f:3"}


def test_amounts_are_not_lost(spark, staged, staging, tmp_path):
    root = str(tmp_path / "w")
    staging["funding_rounds"] = spark.createDataFrame(
        [(10, "c:1", "99999999999999.00"), (11, "c:1", "5.00"), (12, "c:3", "9000000000000.00"), (13, "c:3", "9000000000000.00"), (14, "c:3", "much")],
        "funding_round_id long, object_id string, raised_amount_usd string",
    ).selectExpr("*", "null funding_round_type", "null funding_round_code", "null is_first_round", "null is_last_round")
    tables = plans.build_warehouse(spark, staging, root)
    growth = {r.company_nk: r.total_funding_usd for r in tables["fact_company_growth"].collect()}
    assert "c:1" not in growth
    invalid = [(r.table_name, *r.violations) for r in spark.read.parquet(f"{root}/invalid").collect()]
    assert ("fact_company_growth", "decimal(15,2)(total_funding_usd)") in invalid
    assert ("fact_company_growth", "funding_rounds.decimal(38,2)(raised_amount_usd)") in invalid
    assert ("fact_investments", "decimal(15,2)(investment_amount_usd)") in invalid


def test_surrogates_have_no_gaps_and_reports_do_not_pile_up(spark, staged, staging, rows, tmp_path):
    root = str(tmp_path / "w")
    staging["investments"] = staged("investments", dict(investment_id=1), dict(investment_id=2, investor_object_id="f:7"))
    for _ in range(2):
        tables = plans.build_warehouse(spark, staging, root)
    assert [(r.investor_id, r.investor_nk) for r in tables["dim_investor"].collect()] == [(1, "f:7")]
    invalid = [r.table_name for r in spark.read.parquet(f"{root}/invalid").collect()]
    assert sorted(invalid) == ["dim_company", "dim_investor", "dim_relationship", "fact_company_growth"]


def test_identical_build_writes_nothing(spark, staging, tmp_path):
    root = tmp_path / "w"
    plans.build_warehouse(spark, staging, str(root))
    before = {p for name in schemas.WAREHOUSE for p in (root / name).rglob("*") if p.is_file()}
    plans.build_warehouse(spark, staging, str(root))
    assert before and {p for name in schemas.WAREHOUSE for p in (root / name).rglob("*") if p.is_file()} == before


def test_daily_build_recomputes_affected_companies(spark, staged, staging, tmp_path):
    root, day, later = str(tmp_path / "w"), T(2008, 6, 20, 1), T(2008, 6, 21)
    plans.build_warehouse(spark, staging, root)
    staging["acquisition"] = staged(
        "acquisition",
        dict(acquisition_id=1, acquired_object_id="c:1", acquired_at=DAY),
        dict(acquisition_id=2, acquired_object_id="c:1", acquired_at=T(2008, 6, 19), updated_at=day),  # corrected
        dict(acquisition_id=6, acquired_object_id="c:1", acquired_at=DAY, created_at=day),
        dict(acquisition_id=7, acquired_object_id="c:3", acquired_at=DAY, created_at=later),
    )
    staging["funding_rounds"] = staging["funding_rounds"].unionByName(
        staged("funding_rounds", dict(funding_round_id=15, object_id="c:1", raised_amount_usd=Decimal("5"), created_at=day))
    )
    after = plans.build_warehouse(spark, staging, root, run_date="2008-06-21")
    growth = {(r.company_nk, r.date_id): (r.acquisition_count, r.total_funding_usd) for r in after["fact_company_growth"].collect()}
    total = Decimal("305.75")
    assert growth == {("c:1", 20080618): (2, total), ("c:1", 20080619): (1, total), ("c:3", None): (1, None)}


def test_dimension_rows_that_come_later(spark, staged, staging, rows, tmp_path):
    """Daily builds end where a whole build does, whatever order rows come in."""
    def day(n):
        return T(2009, 1, n, 5)

    def on(df, n):
        return df.withColumn("created_at", F.lit(day(n)).cast(df.schema["created_at"].dataType))

    days = [
        {"investments": staging["investments"], "relationships": staging["relationships"], "funding_rounds": staging["funding_rounds"].where("funding_round_id = 11")},
        {"company": staging["company"], "people": staging["people"]},
        {"funding_rounds": staging["funding_rounds"].where("funding_round_id = 10")},
        {"company": staged("company", dict(office_id=9, object_id="c:9"))},
    ]
    have, root = {}, str(tmp_path / "w")
    for n, new in enumerate(days, 1):
        for name, df in new.items():
            have[name] = on(df, n) if name not in have else have[name].unionByName(on(df, n))
        daily = plans.build_warehouse(spark, have, root, run_date=day(n + 1).date())
    whole = plans.build_warehouse(spark, have, str(tmp_path / "whole"))

    def facts(tables):
        found = tables["fact_investments"]
        for dim, id_, nk in (("dim_company", "company_id", "company_nk"), ("dim_investor", "investor_id", "investor_nk"), ("dim_funding_round", "funding_round_id", "funding_round_nk")):
            found = found.join(tables[dim].select(id_, nk), id_, "left")
        return rows(found, "investment_nk", "company_nk", "investor_nk", "funding_round_nk", "date_id", "investment_amount_usd")

    assert facts(daily) == facts(whole)
    assert [r[1] for r in facts(daily)] == ["c:1", "c:1", "c:9"]
    assert rows(daily["dim_relationship"], "relationship_nk", "people_nk") == rows(whole["dim_relationship"], "relationship_nk", "people_nk")
    # One investment still waits for its round, and one person is unknown.
    waiting = {tuple(r) for name in ("fact_investments", "dim_relationship") for r in read_table(spark, f"{root}/waiting/{name}").collect()}
    assert waiting == {("3", "dim_funding_round", "99")}


def test_rejected_rows_stay_until_they_load(spark, staged, staging, tmp_path):
    root = str(tmp_path / "w")
    have = {"investments": staging["investments"], "funding_rounds": staging["funding_rounds"], "company": staging["company"].where("object_id = 'c:2'")}

    def build(day):
        tables = plans.build_warehouse(spark, have, root, foreign_keys=True, run_date=day)
        kept = plans.rejected_rows(spark, root, "fact_investments")
        loaded = tables.get("fact_investments")
        return ({r.investment_nk for r in loaded.collect()} if loaded is not None else set(), {r.key: r for r in kept.collect()} if kept is not None else {})

    loaded, kept = build(None)
    assert (loaded, set(kept)) == (set(), {"1", "2", "3"})
    first = kept["3"].created_at
    # A day with another good row: what was rejected stays, as it was first rejected.
    have["investments"] = have["investments"].unionByName(staged(
        "investments", dict(investment_id=4, funding_round_id=10, funded_object_id="c:2", investor_object_id="f:1", created_at=T(2009, 1, 1))))
    loaded, kept = build("2009-01-02")
    assert (loaded, set(kept)) == ({"4"}, {"1", "2", "3"}) and kept["3"].created_at == first
    # The company comes: two load and go from the rejected rows, in the same build.
    have["company"] = have["company"].unionByName(staged("company", dict(office_id=1, object_id="c:1", created_at=T(2009, 1, 2))))
    for _ in range(2):
        loaded, kept = build("2009-01-03")
        assert (loaded, set(kept)) == ({"1", "2", "4"}, {"3"})
        assert kept["3"].violations == ["not_null(company_id)", "not_null(funding_round_id)"] and kept["3"].created_at == first


def test_rows_corrected_without_a_new_time_are_tried_again(spark, staged, staging, tmp_path):
    root = str(tmp_path / "w")
    have = {"relationships": staging["relationships"], "company": staging["company"], "people": staging["people"]}
    plans.build_warehouse(spark, have, root)
    assert {r.key for r in plans.rejected_rows(spark, root, "dim_relationship").collect()} == {"2"}
    assert [(r.key, r.violations) for r in plans.rejected_rows(spark, root, "dim_company").collect()] == [(None, ["not_null(company_nk)"])]
    have["relationships"] = have["relationships"].withColumns({
        "is_past": F.when(F.col("relationship_id") == "2", "True").otherwise(F.col("is_past")),
        "start_at": F.when(F.col("relationship_id") != "2", F.col("start_at")),
    })
    tables = plans.build_warehouse(spark, have, root, run_date="2030-01-01")
    assert {r.relationship_nk for r in tables["dim_relationship"].collect()} == {"1", "2", "3", "4"}
    assert plans.rejected_rows(spark, root, "dim_relationship") is None
    # A company without a key can't be named, so it stays until a whole build.
    assert plans.rejected_rows(spark, root, "dim_company").count() == 1


def test_people_with_one_object_id(spark, staged):
    people = staged("people", dict(people_id="2", object_id="p:1"), dict(people_id="1", object_id="p:1"))
    found = plans.dim_relationship(staged("relationships", dict(relationship_id="r", person_object_id="p:1")), people)
    assert [r.people_nk for r in found.collect()] == ["1"]


def test_empty_and_absent_tables_are_skipped(spark, staging, tmp_path):
    empty = {name: df.limit(0) for name, df in staging.items()}
    assert set(plans.build_warehouse(spark, empty, str(tmp_path / "w"))) == {"dim_date"}


def test_facts_without_a_dimension_have_null_keys(spark, staging, tmp_path):
    del staging["company"]
    tables = plans.build_warehouse(spark, staging, str(tmp_path / "w"))
    assert "dim_company" not in tables
    assert {r.company_id for r in tables["fact_investments"].collect()} == {None}


def test_foreign_keys_at_the_gate(spark, staging, tmp_path):
    root = str(tmp_path / "w")
    tables = plans.build_warehouse(spark, staging, root, foreign_keys=True)
    assert {r.investment_nk for r in tables["fact_investments"].collect()} == {"1", "2"}
    assert {r.company_nk for r in tables["fact_company_growth"].collect()} == {"c:1"}


def test_growth_of_all_companies(staging, spark):
    found = plans.company_growth_rows(
        staging["acquisition"], staging["funding_rounds"], staging["ipos"], plans.calendar(spark), spine="all"
    )
    only_funded = [r for r in found.collect() if r.company_nk == "c:4"]
    assert len(only_funded) == 1 and only_funded[0].acquisition_count == 0 and only_funded[0].total_funding_usd == 7
    with pytest.raises(ValueError):
        plans.company_growth_rows(
            staging["acquisition"], staging["funding_rounds"], staging["ipos"], plans.calendar(spark), spine="x"
        )


def test_one_offering_per_company(staging):
    assert latest_ipos(staging["ipos"]).count() == 2


def test_facts_do_not_fan_out(spark, staging):
    company = plans.dim_company(staging["company"])
    facts = plans.fact_investments(
        staging["investments"], staging["funding_rounds"], plans.calendar(spark), company,
        plans.dim_investor(staging["investments"]), plans.dim_funding_round(staging["funding_rounds"]),
    )
    assert facts.count() == staging["investments"].count()


def test_calendar(spark):
    days = plans.calendar(spark)
    assert days.count() == 29_220
    assert [(f.name, f.dataType) for f in days.schema] == [
        (f.name, f.dataType) for f in schemas.struct(schemas.WAREHOUSE["dim_date"])
    ]
    found = as_dicts(days.where("date_id IN (19980101, 19980103, 20000229, 20211111, 20210103)"), "date_id")
    first = found[19980101]
    assert (first["day_suffix"], first["day_name"], first["quarter_name"], first["weekend_indr"]) == (
        "1st", "Thursday", "First", "weekday"
    )
    assert (first["week_of_year_iso"], first["mmyyyy"], first["mmddyyyy"]) == ("1998-W01", "011998", "01011998")
    assert first["first_day_of_week"] == datetime.date(1997, 12, 29)
    assert first["last_day_of_quarter"] == datetime.date(1998, 3, 31)
    assert found[19980103]["weekend_indr"] == "weekend" and found[19980103]["day_suffix"] == "3rd"
    assert found[20211111]["day_suffix"] == "11th"
    assert found[20000229]["last_day_of_month"] == datetime.date(2000, 2, 29)
    assert (found[20210103]["week_of_year"], found[20210103]["week_of_year_iso"]) == (53, "2020-W53")
    assert plans.calendar(spark, datetime.date(1998, 1, 1), datetime.date(9999, 12, 31)).count() == 2_922_670


def test_calendar_from_text(spark, rows):
    days = plans.calendar(spark, datetime.date(2008, 1, 1), datetime.date(2008, 1, 31))
    text = days.select([days[name].cast("string").alias(name) for name in days.columns])
    assert rows(plans.dim_date(text)) == rows(days)


def test_staging_a_day(spark, staged, rows, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "funds")
    source = staged("funds", dict(fund_id="1", name="a\nb", created_at=DAY), dict(fund_id="2", name="c", created_at=T(2008, 6, 19)))
    full = plans.stage_table(source, landing, path, ["fund_id"], "2008-06-19", incremental=False)
    assert rows(full, "fund_id", "name") == [("1", "a b"), ("2", "c")]
    changed = staged("funds", dict(fund_id="1", name="new", created_at=DAY), dict(fund_id="2", name="no", created_at=T(2008, 6, 19)))
    for _ in range(2):
        found = plans.stage_table(changed, landing, path, ["fund_id"], "2008-06-19")
        assert rows(found, "fund_id", "name") == [("1", "new"), ("2", "c")]
    assert plans.stage_table(changed, landing, path, ["fund_id"], "1999-01-01") is None


def test_staging_rejects_and_logs(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n,y\n2\n3,z,w\n")
    landing, path, log = str(tmp_path / "landing"), str(tmp_path / "t"), str(tmp_path / "log")
    for _ in range(2):
        found = plans.stage_csv(spark, str(tmp_path / "a.csv"), landing, path, ["id"], "2024-02-02", log=log)
    assert [(r.id, r.name) for r in found.collect()] == [("1", "x")]
    invalid = spark.read.parquet(f"{landing}_invalid").collect()
    assert sorted(r.violations[0] for r in invalid) == ["not_null(id)", "well_formed", "well_formed"]
    assert {(r.status, r.n_rows, r.error_msg) for r in spark.read.parquet(log).collect()} == {("success", 4, "3 rows rejected")}


def test_staging_what_differs(spark, staged, rows, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "funds")
    source = staged("funds", dict(fund_id="1", name="a\nb", created_at=DAY), dict(fund_id="2", name="c"), dict(fund_id="3", name="gone"))
    plans.stage_table(source, landing, path, ["fund_id"], "2008-06-19", incremental=False)
    changed = staged("funds", dict(fund_id="1", name="a\nb", created_at=DAY), dict(fund_id="2", name="C"), dict(fund_id="4", name="late", created_at=T(2001, 1, 1)))
    found = plans.stage_table(changed, landing, path, ["fund_id"], "2008-06-20", by_snapshot=True)
    assert rows(found, "fund_id", "name") == [("1", "a b"), ("2", "C"), ("3", "gone"), ("4", "late")]
    assert rows(read_increment(spark, landing, "2008-06-20"), "fund_id") == [("2",), ("4",)]
    assert plans.stage_table(changed, landing, path, ["fund_id"], "2008-06-21", by_snapshot=True) is None


def test_a_day_without_anything_moves_no_row(spark, staging, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    chosen = {name: staging[name] for name in ("investments", "funding_rounds", "company")}
    plans.build_warehouse(spark, chosen, root)
    seen = []
    build = facts.investment_rows
    monkeypatch.setattr(facts, "investment_rows", lambda rows, *rest, **how: seen.append(rows) or build(rows, *rest, **how))
    tables = plans.build_warehouse(spark, chosen, root, run_date="2030-01-01")
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Relation" not in plan.replace("LocalRelation", "")
    assert tables["fact_investments"].count() == 3


def test_no_keys_to_try_again(spark, tmp_path):
    rejected = spark.createDataFrame([(None, "1", ["r"], "{}", None, None), (None, None, ["r"], "{}", None, None)], pending.REJECTED)
    pending.settle(spark, str(tmp_path), "t", rejected, None)
    assert [row[0] for row in pending.rejected_keys(spark, str(tmp_path), "t").collect()] == ["1"]
    assert pending.rejected_keys(spark, str(tmp_path), "t", "company") is None


def test_rows_that_were_not_tried_stay_rejected(spark, tmp_path):
    def state(*keys):
        return spark.createDataFrame([(None, key, ["r"], key, None, None) for key in keys], pending.REJECTED)

    root = str(tmp_path)
    pending.settle(spark, root, "t", state("1", "2", "3"), None)
    pending.settle(spark, root, "t", state("2"), state("1", "2").select("source", "key"))
    found = pending.rejected_rows(spark, root, "t")
    assert sorted(row["key"] for row in found.collect()) == ["2", "3"]


def test_lines_are_numbered_by_what_is_used(spark):
    from checks import analog
    from checks.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    found = analog.lines(t)
    assert "l_extendedprice" not in found.columns
    assert found.agg(F.max("line_id"), F.count_distinct("line_id")).first()[:] == (t.lineitem.count(),) * 2


def test_amounts_are_typed_after_the_lookups(spark, staging):
    empty = {name: spark.createDataFrame([], schemas.struct(schemas.WAREHOUSE[name])) for name in ("dim_date", "dim_company", "dim_investor", "dim_funding_round")}
    text = staging["funding_rounds"].withColumn("raised_amount_usd", F.lit("100000000000000000000.25"))
    found = facts.investment_rows(staging["investments"], text, *empty.values())
    assert found.schema["investment_amount_usd"].dataType.simpleString() == "decimal(38,2)"
    assert {row[0] for row in found.select("investment_amount_usd").collect()} == {Decimal("100000000000000000000.25"), None}
    plan = facts.investment_rows(staging["investments"], staging["funding_rounds"], *empty.values())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("decimal(38,2)") < plan.index("Join")
