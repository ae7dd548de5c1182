"""Every registered query against its check SQL, or for rows where it has none."""

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, CHECKS[name]) in (None, "EMPTY")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 5
