"""Every registered query: against its SQL where there is one, else that it gives rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as spine
from tests.compare import connect, differences

SQL_DIR, ROWS_DIR = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
QUERIES, SQL = spine.queries(), spine.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SQL_DIR)


@pytest.mark.parametrize("key", sorted(SQL))
def test_same_as_sql(spark, con, key):
    assert differences(spark, con, SQL_DIR, QUERIES[key], SQL[key]) == []


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, key):
    assert QUERIES[key](spark, ROWS_DIR).count() > 0


def test_entry(spark):
    df = spine.entry(spark)
    assert df.count() > 0
    assert {"model_id", "id", "index", "value", "conf_lo", "conf_hi"} <= set(df.columns)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
