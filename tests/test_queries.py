"""Every registered query against its SQL on the same tables, or at least for rows."""

import pytest

import __spark_entry__ as entry_points
from lakewarden.plans import QUERIES, SQL
from tests.conftest import SF
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], SQL[name], SF) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() > 0


def test_churn_scores_are_probabilities(spark):
    scores = QUERIES["churn_scores"](spark, SF).collect()
    assert len(scores) == 1500
    assert all(0 <= r.churn_probability <= 1 and r.predicted in (0, 1) for r in scores)


def test_cluster_layout_keeps_rows_and_narrows_files(spark):
    files = QUERIES["cluster_layout"](spark, SF).collect()
    total = QUERIES["revenue_summary_all"](spark, SF).count()
    assert sum(f.n_rows for f in files) == total and len(files) > 1
    assert sum(f.first_region != f.last_region for f in files) < len(files)
