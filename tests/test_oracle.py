"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_but_a_few_has_sql():
    assert set(entry.QUERIES) == set(entry.SQL)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, con, name):
    fn, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert fn(spark, SF).count() > 0
    else:
        problem = compare(spark, con, name, fn, sql, SF)
        assert problem in (None, "no rows"), problem


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
