"""Every registered query against its SQL in DuckDB, on the smallest data."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in SQL))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    assert compare(got, duck.sql(SQL[name]).to_arrow_table()) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
