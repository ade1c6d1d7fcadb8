"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) == []


#: Queries whose result is rightly small enough to be empty on some tables: none.
MAY_BE_EMPTY: set[str] = set()


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - MAY_BE_EMPTY))
def test_no_comparison_of_empty_tables(con, name):
    assert con.execute(f"SELECT count(*) FROM ({entry.oracle_sql()[name]})").fetchone()[0] > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_is_for_registered_queries_only():
    assert set(entry.SQL) <= set(entry.queries())
