"""Every registered query next to its SQL; without SQL it must give rows."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, sql_connection

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return sql_connection(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, folder, name):
    assert compare(spark, con, folder, QUERIES[name], ORACLES.get(name)) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
