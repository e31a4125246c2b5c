"""Every registered query against its SQL on the smallest tables."""

import pytest

from notegraph.plans import catalog, registry  # the registry fills the catalogue


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, sf, duck, same, name):
    same(catalog.QUERIES[name](spark, sf), duck.sql(catalog.SQL[name]))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() >= 0


def test_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(registry.queries()) <= set(e.queries())
    assert e.entry(spark).count() > 0
