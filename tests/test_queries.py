"""Every catalogued query against its DuckDB text on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    if name in SQL:
        assert difference(got, duck.execute(SQL[name]).df()) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
