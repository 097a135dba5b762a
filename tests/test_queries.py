"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
from rigwatch.plans import QUERIES, SQL
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = con.execute(SQL[name]).df()
    assert len(want) > 0
    assert differences(got, want) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
