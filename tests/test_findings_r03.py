"""Findings of round 3: each of these failed before its change."""

import re

from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakewarden import session
from lakewarden.operators import access, churn, classify, lineage, versions
from lakewarden.operators.medallion import FEATURES
from lakewarden.plans import QUERIES, SQL
from lakewarden.sources.tables import load
from tests.conftest import SF
from tests.oracle import compare, connect
from tests.test_plans import plan


def _churn_model(spark):
    rows = [(i, 0, 0.0, 0, float(1 - 2 * (i % 2)), i % 2) for i in range(40)]
    features = spark.createDataFrame(rows, ["customer_id", *FEATURES, "churned"])
    return churn.train_churn(features), features


def test_churn_scores_after_an_observation(spark):
    spark.range(3).observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    model, features = _churn_model(spark)
    got = churn.score_churn(model, features).collect()
    assert len(got) == 40 and all(r.predicted == r.churned for r in got)


def test_churn_prediction_agrees_with_the_probability_shown(spark):
    model, _ = _churn_model(spark)
    near = spark.createDataFrame([(i, 0, 0.0, 0, x, 0) for i, x in enumerate((-1e-8, 1e-8, -0.1, 0.1))],
                                 ["customer_id", *FEATURES, "churned"])
    got = churn.score_churn(model, near).orderBy("customer_id").collect()
    assert [r.churn_probability for r in got[:2]] == [0.5, 0.5]
    assert [r.predicted for r in got] == [0, 0, 1, 0]


def test_containment_query_counts_every_value(spark, tmp_path):
    """More distinct names than a sketch holds; the odd ones of the names are not among the known."""
    for name in ("nation", "region"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    many = classify.SKETCH_VALUES * 3 + 1
    spark.read.parquet(f"{SF}/customer.parquet").limit(1).crossJoin(spark.range(many)).withColumn(
        "c_custkey", F.col("id")).withColumn("c_name", F.format_string("Customer#%09d", "id")).drop("id").coalesce(1).write.parquet(
        f"{tmp_path}/customer.parquet")
    con = connect(SF)
    con.execute(f"create or replace view customer as select * from '{tmp_path}/customer.parquet/*.parquet'")
    assert compare(spark, con, QUERIES["name_containment"], SQL["name_containment"], str(tmp_path)) == []


def test_column_steps_are_not_dealt_out_by_kind(spark, monkeypatch):
    """Three kinds must not become three tasks: the declared map is broadcast, and tasks grow with the steps."""
    monkeypatch.setattr(lineage, "PAIRS_PER_TASK", 4096)
    df = QUERIES["column_steps"](spark, SF)
    text = plan(df).replace("\n", " ")
    dealt = re.findall(r"hashpartitioning\((.*?), (\d+)\)", text)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    assert [re.sub(r"#\d+L?", "", columns) for columns, _ in dealt] == ["target, table"]
    assert int(dealt[0][1]) >= 2 * load(spark, SF, "lineitem").count() // 4096


def test_tree_diff_shuffles_only_rows_of_differing_ranges(spark, monkeypatch, rows):
    """Ranges meet the rows as bits where these are read, not in a join that shuffles both versions once more."""
    made = []
    monkeypatch.setattr(session, "watchers", [lambda df, label: made.append(label)])
    a = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    b = a.filter("k <> 5").withColumn("v", F.when(F.col("k") % 5000 == 11, -1).otherwise(F.col("v")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        diff = versions.tree_diff(a, b, ["k"])
        text = plan(diff)
        assert rows(diff) == rows(versions.version_diff(a, b, ["k"])) and diff.count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in text and made == ["leaves"]


def test_kept_trees_give_the_same_diff(spark, rows):
    a = spark.createDataFrame([(i, i % 3) for i in range(3000)], "k bigint, v bigint")
    b = a.filter("k <> 9").unionByName(a.filter("k in (4, 5)"))
    leaves = versions.leaves_for(3000)
    trees = versions.hash_tree(a, ["k"], leaves), versions.hash_tree(b, ["k"], leaves)
    want = [(4, "insert", 0, 1), (5, "insert", 0, 1), (9, "delete", 1, 0)]
    assert rows(versions.tree_diff(a, b, ["k"], trees, leaves)) == rows(versions.tree_diff(a, b, ["k"])) == want


def test_gaps_look_up_only_pairs_that_the_class_leaves_open(spark, monkeypatch, rows):
    counted = {}
    monkeypatch.setattr(session, "watchers", [lambda df, label: counted.update({label: df.count()}) if label == "asked" else None])
    objects = spark.createDataFrame([("c", "s", i) for i in range(50)] + [("c", "t", 99)], "catalog string, schema string, object bigint")
    grants = spark.createDataFrame(
        [("CATALOG", "c", None, None, "all", "USE CATALOG"), ("CATALOG", "c", None, None, "all", "USE SCHEMA"),
         ("SCHEMA", "c", "s", None, "all", "SELECT"), ("TABLE", "c", "t", 99, "p1", "SELECT")],
        "securable_type string, catalog string, schema string, object bigint, grantee string, privilege string")
    members = spark.createDataFrame([(f"p{i}", "all") for i in range(4)], "principal string, grp string")
    asked = members.select("principal").crossJoin(objects)
    got = rows(access.access_gaps(asked.unionByName(asked), grants, members, objects), "principal", "object", "missing")
    assert got == [(f"p{i}", 99, "SELECT") for i in (0, 2, 3)]
    assert counted == {"asked": 4}

def test_closure_writes_edges_once_where_it_lays_them_out(spark, monkeypatch, rows):
    made = []
    monkeypatch.setattr(session, "watchers", [lambda df, label: made.append(label)])
    monkeypatch.setattr(lineage, "ROW_BYTES", 1 << 30)
    edges = spark.createDataFrame([(f"a{i}", f"b{i % 5}") for i in range(20)], "src string, dst string")
    roots = edges.select(F.col("src").alias("node"))
    got = rows(lineage.closure(edges, roots))
    assert got == sorted([(f"a{i}", 0) for i in range(20)] + [(f"b{i}", 1) for i in range(5)], key=repr)
    assert made.count("laid edges") == 1 and "edges" not in made
