"""The shape of plans: what is pushed, pruned and reduced before a shuffle."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from lakewarden.functions.sql import register_sql_functions
from lakewarden.operators import integrity, medallion, policy
from lakewarden.plans import QUERIES
from lakewarden.sources import entities as E
from lakewarden.sources.tables import load
from tests.conftest import SF


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_and_no_cross_joins(spark, name):
    if name == "churn_scores":
        pytest.skip("trains a model")
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", text)


@pytest.mark.parametrize("name", ["effective_access", "access_gaps", "version_diff", "impact_closure", "pii_flow_closure", "churn_scores"])
def test_staged_jobs_too(spark, monkeypatch, name):
    """The costly jobs run inside ``stage``; their plans count as well."""
    from lakewarden import session

    seen = []
    monkeypatch.setattr(session, "watchers", [lambda df, label: seen.append((label, plan(df)))])
    plan(QUERIES[name](spark, SF))
    assert seen
    bad = r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin"
    assert not [label for label, text in seen if re.search(bad, text)]


def test_net_grants_are_hashed_not_sorted(spark):
    assert "SortAggregate" not in plan(QUERIES["net_grants"](spark, SF))


def test_window_of_lineage_reaches_the_scan(spark):
    text = plan(QUERIES["pii_flow"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", text)


def test_references_read_the_child_once(spark):
    assert plan(QUERIES["fk_violations"](spark, SF)).count("orders.parquet") == 1


def test_row_filter_and_mask_reach_the_scan(spark):
    table = load(spark, SF, "region")
    registry = policy.PolicyRegistry().attach_filter("r", "r_name", policy.RowPolicy("admins", ("EUROPE",)))
    members = spark.createDataFrame([("admins", "root")], "grp string, principal string")
    assert "EqualTo(r_name,EUROPE)" in plan(policy.secure(table, "r", registry, "joe", members))
    assert "Filter" not in plan(policy.secure(table, "r", registry, "root", members))


def test_sql_row_filter_reaches_the_scan(spark):
    register_sql_functions(spark, is_admin=False, allowed="EUROPE")
    load(spark, SF, "region").createOrReplaceTempView("region_view")
    assert "EqualTo(r_name,EUROPE)" in plan(spark.sql("SELECT * FROM region_view WHERE filter_by_region(r_name)"))


def test_columns_are_pruned(spark):
    text = plan(QUERIES["transaction_totals"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_discount:double>" in text
    assert "part.parquet" not in plan(E.transactions(spark, SF, category=False))


def test_null_checks_reach_the_scan(spark):
    text = plan(medallion.clean_interactions(E.interactions(spark, SF)))
    assert "IsNotNull(event_id)" in text and "IsNotNull(user_id)" in text


def test_dedup_limits_each_key_before_the_shuffle(spark):
    text = plan(integrity.dedup_latest(load(spark, SF, "lineitem"), ["l_orderkey"], [F.col("l_shipdate")]))
    assert text.count("WindowGroupLimit (") >= 2


def test_line_items_are_shuffled_twice_for_revenue(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["revenue_summary"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"hashpartitioning\(l_\w+#\d+L, \d+\)", text.replace("\n", " "))) == 2


def test_version_filter_prunes_folders(spark, tmp_path):
    from lakewarden.operators import versions

    path = f"{tmp_path}/v"
    for v in range(3):
        versions.commit(spark.range(3), path, v)
    text = plan(versions.as_of(versions.read_versions(spark, path), 1))
    assert re.search(r"PartitionFilters: \[.*version#\d+ = 1", text)
