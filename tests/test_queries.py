"""Every query on the smallest tables, against its SQL where it has one."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from check import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    got = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        assert compare(got, con.execute(SQL[name]).df()) is None
    else:
        assert len(got.columns) > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
