"""Every query against its SQL on the given tables."""

import check_queries
import pytest

import __spark_entry__ as entry
from foliospark.plans import catalog, oracle

QUERIES, ORACLE = catalog.QUERIES, oracle.statements()


@pytest.fixture(scope="module")
def con(sf):
    return check_queries.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf, con):
    assert check_queries.compare(QUERIES[name](spark, sf), con, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
