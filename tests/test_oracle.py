"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry

from .compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.TEXT_QUERIES)))
def test_query(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(entry.queries()) - set(entry.TEXT_QUERIES) == set(entry.oracle_sql()) - set(entry.TEXT_ORACLES)
