"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry.queries()
SQL = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    sql_columns, expected = sql_rows(con, SQL[name])
    assert columns == sql_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_id", "prediction"]
    assert df.count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
