"""Every registered query that has SQL gives the rows DuckDB gives."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
# queries of the llm subpackage have their tests beside it
SQL = {name: sql for name, sql in entry_points.oracle_sql().items() if name in entry_points.QUERIES}
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    _, _, problem = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert problem == ""


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
