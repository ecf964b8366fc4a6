"""Every registered query against its SQL check on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import compare, connect
from martlens.catalog import oracle
from martlens.catalog import queries as catalog

QUERIES, CHECKS = catalog.QUERIES, oracle.ORACLE


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(name, spark, sf_dir, duck):
    assert compare(QUERIES[name](spark, sf_dir), duck, CHECKS[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_query_without_sql_runs(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_check_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries()) and set(CHECKS) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "sub_channel", "model_name", "total_attributed_revenue", "conversions_attributed"]


def test_sketch_close_to_exact(spark, sf_dir):
    """The sketch keeps the weights exactly and the counts within a few percent."""
    key = ["survey_year", "country", "category", "metric", "response"]
    exact = QUERIES["survey_weighted"](spark, sf_dir)
    sketch = QUERIES["survey_weighted_approx"](spark, sf_dir).withColumnRenamed("respondent_count", "approx").withColumnRenamed(
        "weighted_population", "w")
    rows = exact.join(sketch, key).collect()
    assert len(rows) == exact.count()
    for r in rows:
        assert r.w == r.weighted_population
        assert abs(r.approx - r.respondent_count) <= max(1, 0.05 * r.respondent_count)
