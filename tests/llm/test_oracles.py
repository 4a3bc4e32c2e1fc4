"""Queries of this subpackage that SQL can express, against that SQL."""

import pytest

from bulkapply.llm import oracles, queries
from compare import assert_same, connection
from conftest import CHECKED

SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connection(CHECKED)


def test_names():
    assert set(SQL) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert_same(queries.queries()[name](spark, CHECKED), con, SQL[name])
