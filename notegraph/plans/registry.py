"""Names of the note-corpus queries and their SQL."""

from __future__ import annotations

from notegraph.plans import catalog, catalog_jobs, catalog_more  # noqa: F401  the others add to the first


def flagship(spark, sf_dir):
    """Topic source sets with their digests: the collection job over the whole corpus."""
    return catalog.QUERIES["k4_collect_topics"](spark, sf_dir)


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return dict(catalog.SQL)
