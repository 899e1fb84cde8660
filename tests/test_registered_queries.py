"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from check import connect, differences

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, folder, duck, name):
    assert differences(QUERIES[name](spark, folder).toPandas(), duck.sql(ORACLE[name]).df()) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
