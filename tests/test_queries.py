"""Every registered query against its SQL, over all rows."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.oracles import all_sql
from checks.queries import all_queries

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_each_query_has_sql():
    assert set(all_queries()) == set(all_sql()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(con, SQL[name], QUERIES[name](spark, sf_dir)) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
