"""Every catalogue and harvest query against its SQL."""

import pytest
from compare import connect, difference

from gavel.catalogue_queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), ORACLE[name], con) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    rows = {r["type"]: r["n"] for r in entry.entry(spark).collect()}
    assert rows.pop("TOTAL") == sum(rows.values())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_plans_stay_in_the_engine(spark, sf_dir):
    """The cascade, dates and links run no Python, and filters reach the scan."""
    for name in ("catalog_classify", "date_rules_path", "page_links", "harvest_documents"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan, name
    plan = QUERIES["year_prune"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
