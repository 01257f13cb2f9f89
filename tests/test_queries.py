"""Every registered query against its SQL in DuckDB, over whole tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference, duck_result, spark_result
from tests.conftest import SMALL
from threadsift.plans import catalog, oracle

QUERIES, SQL = catalog.QUERIES, oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = spark_result(QUERIES[name](spark, SMALL))
    assert difference(got, duck_result(duck, SQL[name])) is None


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["rank", "category", "n"] and df.count() == 5
