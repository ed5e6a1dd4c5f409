"""Every registered query gives the rows its SQL gives."""

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
QUERIES = {**contract.batch.QUERIES, **contract.live.QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    expected_columns, expected = sql_rows(con, SQL[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    assert contract.entry(spark).columns
