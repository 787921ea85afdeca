import pytest
from pyspark.sql import functions as F

from asterism import operators as ops


@pytest.fixture
def data(spark):
    return spark.createDataFrame(
        [(1, "c:1", "2008-01-01"), (2, None, "x"), (3, "c:9", None), (4, "c:2", "2008"), (5, "c:1", "2008-01-01 10:00:00")],
        "id int, nk string, day string",
    )


@pytest.fixture
def rules(spark):
    companies = spark.createDataFrame([("c:1",), ("c:2",), ("c:2",)], "company_nk string")
    return [ops.NotNull("nk"), ops.Castable("day", "date"), ops.ForeignKey("nk", companies, "company_nk")]


def test_violations(data, rules):
    found = {row.id: row.violations for row in ops.tag_violations(data, rules).collect()}
    assert found == {
        1: [],
        2: ["not_null(nk)", "date(day)"],
        3: ["foreign_key(nk)"],
        4: ["date(day)"],
        5: [],
    }


def test_split_is_a_partition_of_the_input(data, rules, rows, tmp_path):
    for valid, invalid in (ops.split_valid(data, rules), ops.land_split(data, rules, str(tmp_path / "gate"))[:2]):
        assert valid.columns == data.columns and invalid.columns == [*data.columns, "violations"]
        assert rows(valid.union(invalid.drop("violations"))) == rows(data)
        assert rows(valid, "id") == [(1,), (5,)]


def test_landed_counts(data, rules, tmp_path):
    assert ops.land_split(data, rules, str(tmp_path / "gate"))[2] == {"n_rows": 5, "n_invalid": 3}


def test_report(data, rules, rows):
    _, invalid = ops.split_valid(data, rules)
    assert rows(ops.validation_report(invalid)) == [("date(day)", 2), ("foreign_key(nk)", 1), ("not_null(nk)", 1)]


def test_without_rules_all_rows_are_valid(data, rows):
    valid, invalid = ops.split_valid(data, [])
    assert rows(valid) == rows(data) and invalid.isEmpty()


def test_empty_landed_table(data, rules, tmp_path):
    valid, invalid, _ = ops.land_split(data.where(F.lit(False)), rules, str(tmp_path / "gate"))
    assert valid.isEmpty() and invalid.isEmpty() and valid.schema == data.schema
