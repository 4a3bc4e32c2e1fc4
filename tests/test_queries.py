import pytest

import __spark_entry__ as contract
from compare import assert_same, connection
from bulkapply.plans import oracles
from bulkapply.plans import queries as registered
from conftest import CHECKED

QUERIES, SQL = registered.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connection(CHECKED)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    assert_same(QUERIES[name](spark, CHECKED), con, SQL[name])


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[0] == "l_orderkey"
    assert result.count() > 0
