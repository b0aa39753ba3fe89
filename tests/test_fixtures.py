"""Edge rows with known answers."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakewarden.functions import sql
from lakewarden.functions.scalars import health_score, uuid_text
from lakewarden.operators import (
    access, classify, integrity, lineage, medallion, monitor, policy, shares, tags, versions,
)
from lakewarden.plans.metrics import MetricSpec
from lakewarden.session import shared_path
from lakewarden.sources import sinks, synth, tables


def test_health_score(spark, rows):
    keys = ["test-customer-001", "a", "00000000-0000-0000-0000-000000000001"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select(health_score("k"))
    assert sorted(r[0] for r in df.collect()) == sorted([89.1, 49.7, 26.3])


def test_uuid_text(spark):
    assert spark.range(1_000_000, 1_000_001).select(uuid_text("id")).first()[0] == (
        "00000000-0000-0000-0000-0000000f4240")


def test_synthetic_dates_cover_both_ends(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "i")
    made = synth.synth_customers(ids)
    lo, hi, n, keys = made.agg(F.min("created_date"), F.max("created_date"), F.count("*"),
                               F.count_distinct("customer_id")).first()
    assert (lo, hi, n, keys) == (date(2022, 1, 1), date(2024, 1, 1), 20_000, 20_000)
    t = synth.synth_transactions(ids, 20_000)
    assert t.join(made, "customer_id", "left_anti").count() == 0
    low, high = t.agg(F.min("amount"), F.max("amount")).first()
    assert 1.0 <= low and high <= 5000.0


MASKED = [("john@x", "jo****"), ("a", "a****"), ("", "****"), (None, None)]


def test_mask(spark):
    df = spark.createDataFrame([(v, w) for v, w in MASKED], "v string, want string")
    for r in policy.mask_columns(df, ["v"], False).collect():
        assert r.v == r.want
    assert [r.v for r in policy.mask_columns(df, ["v"], True).collect()] == [v for v, _ in MASKED]


def test_mask_twice_changes_short_values_only(spark):
    once = policy.mask_columns(spark.createDataFrame([("john@x",), ("a",)], "v string"), ["v"], False)
    assert [r.v for r in policy.mask_columns(once, ["v"], False).collect()] == ["jo****", "a*****"]


def test_row_filter_drops_null(spark, rows):
    df = spark.createDataFrame([("NORTH",), ("SOUTH",), (None,)], "region string")
    assert rows(policy.row_filter(df, "region", ["NORTH"], False)) == [("NORTH",)]
    assert policy.row_filter(df, "region", ["NORTH"], True).count() == 3


def _policy_case(spark):
    people = spark.createDataFrame(
        [(1, "ann@x", "NORTH"), (2, "bob@x", "SOUTH")], "customer_id int, email string, region string")
    members = spark.createDataFrame([("admins", "root")], "grp string, principal string")
    registry = policy.PolicyRegistry()
    registry.attach_mask("c", "email", policy.MaskPolicy("admins"))
    registry.attach_filter("c", "region", policy.RowPolicy("admins", ("NORTH",)))
    return people, members, registry


def test_secure_per_principal(spark, rows):
    people, members, registry = _policy_case(spark)
    assert rows(policy.secure(people, "c", registry, "root", members)) == rows(people)
    assert rows(policy.secure(people, "c", registry, "joe", members)) == [(1, "an****", "NORTH")]


def test_predicates_meet_masked_values(spark):
    people, members, registry = _policy_case(spark)
    seen = policy.secure(people, "c", registry, "joe", members)
    assert seen.filter("email = 'ann@x'").count() == 0
    assert seen.filter("email = 'an****'").count() == 1


def test_detached_policies_show_everything(spark, rows):
    people, members, registry = _policy_case(spark)
    registry.detach_mask("c", "email").detach_filter("c")
    assert rows(policy.secure(people, "c", registry, "joe", members)) == rows(people)


def test_table_built_from_secured_source_is_masked_for_all(spark, rows):
    people, members, registry = _policy_case(spark)
    baked = medallion.segment(policy.secure(people, "c", registry, "joe", members), "segment_a", 100)
    seen = policy.secure(baked, "segment", registry, "root", members)
    assert rows(seen) == [(1, "an****", "NORTH", "segment_a")]


def test_csv_nulls_are_dropped(spark):
    path = shared_path(spark, "csv")
    raw = spark.createDataFrame(
        [("c1", "a@x"), (None, "b@x"), ("c3", None)], "customer_id string, email string")
    for c in tables.CUSTOMERS_CSV.names[1:]:
        if c != "email":
            raw = raw.withColumn(c, F.lit("2022-01-01" if c == "created_date" else "x"))
    sinks.write_csv(raw.select(*tables.CUSTOMERS_CSV.names), path)
    for schema in (tables.CUSTOMERS_CSV, None):
        read = tables.read_bronze(spark, path, schema)
        assert dict(read.dtypes)["created_date"] == "date"
        assert [r.customer_id for r in medallion.clean_customers(read).collect()] == ["c1"]
        assert medallion.clean_customers(read, strict=False).count() == 2


def test_clean_transactions_variants(spark):
    t = spark.createDataFrame(
        [("t1", "c1", "10.5"), ("t2", "c1", "-1"), ("t3", None, "2"), ("t4", "c1", "oops")],
        "transaction_id string, customer_id string, amount string",
    ).withColumn("transaction_date", F.lit("2022-05-01"))
    assert [r.transaction_id for r in medallion.clean_transactions(t).collect()] == ["t1"]
    loose = medallion.clean_transactions(t, strict=False)
    assert [r.transaction_id for r in loose.collect()] == ["t1", "t2"]
    assert dict(loose.dtypes)["amount"] == "double" and dict(loose.dtypes)["transaction_date"] == "date"


def test_customer_without_activity(spark):
    c = spark.createDataFrame([("c1", "A", "B", "NORTH", date(2022, 1, 1))],
                              "customer_id string, first_name string, last_name string, region string, created_date date")
    t = spark.createDataFrame([], "customer_id string, amount double")
    i = spark.createDataFrame([], "customer_id string, sentiment_score double")
    r = medallion.customer_health(c, medallion.transaction_totals(t), i).first()
    assert (r.transaction_count, r.total_amount, r.interaction_count, r.avg_sentiment) == (0, 0.0, 0, 0.0)


def test_totals_by_parent_equal_plain_totals(spark, rows):
    lines = spark.createDataFrame([(1, 2.5), (1, 3.5), (2, 1.0), (3, 9.0), (9, 4.0)], "o int, amount double")
    orders = spark.createDataFrame([(1, 7), (2, 7), (3, None)], "o int, customer_id int")
    plain = medallion.transaction_totals(lines.join(orders, "o").filter("customer_id is not null"))
    assert rows(medallion.totals_by_parent(lines, orders, "o")) == rows(plain) == [(7, 3, 7.0)]


def _fk_case(spark):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "x")], "id int, k string")
    return child, spark.createDataFrame([("a",), ("b",)], "p string")


def test_fk(spark, rows):
    child, parent = _fk_case(spark)
    assert rows(integrity.fk_violations(child, parent, {"k": "p"}), "id") == [(2,), (4,)]
    assert rows(integrity.fk_valid_rows(child, parent, {"k": "p"}), "id") == [(1,)]
    assert rows(integrity.fk_orphan_keys(child, parent, {"k": "p"})) == [("x", 2)]


def test_fk_gate_is_all_or_nothing(spark):
    child, parent = _fk_case(spark)
    path = shared_path(spark, "gate")
    assert sinks.append_checked(child.filter("id in (1, 3)"), path, parent, {"k": "p"}) == 0
    assert sinks.append_checked(child, path, parent, {"k": "p"}) == 2
    assert spark.read.parquet(path).count() == 2


def test_quarantine_lists_every_reason(spark):
    df = spark.createDataFrame([(1, 5), (-1, 50), (1, None)], "a int, b int")
    rules = {"a_positive": F.col("a") > 0, "b_small": F.col("b") < 10}
    good, bad = integrity.expect(df, rules)
    assert good.count() == 1 and good.columns == ["a", "b"]
    assert sorted(map(tuple, (r.failed for r in bad.collect()))) == [("a_positive", "b_small"), ("b_small",)]
    assert good.unionByName(bad.drop("failed")).exceptAll(df).count() == 0
    assert {r.rule: (r.passed, r.failed) for r in integrity.expectation_stats(df, rules).collect()} == {
        "a_positive": (2, 1), "b_small": (1, 2)}


def test_verify_counts_blank_keys(spark):
    df = spark.createDataFrame([("a",), (" ",), (None,)], "k string")
    r = integrity.verify("t", df, ["k"], ["k"]).first()
    assert (r.row_count, r.columns_match, r.empty_keys) == (3, True, 2)
    assert not integrity.verify("t", df, ["other"], ["k"]).first().columns_match


def _versioned(spark, category):
    path = shared_path(spark, "versions")
    versions.commit(spark.createDataFrame(
        [(1, "purchase", "PROMO", 10.0), (2, "refund", "PROMO", 5.0)],
        "id int, transaction_type string, product_category string, amount double"), path, 0)
    cond = (F.col("transaction_type") == "purchase") & (F.col("product_category") == category)
    latest = versions.update_version(spark, path, 0, cond, {"amount": F.col("amount") * 1.05})
    return path, latest


def test_update_without_match_changes_nothing(spark, rows):
    path, latest = _versioned(spark, "electronics")
    all_versions = versions.read_versions(spark, path)
    a, b = versions.as_of(all_versions, 0), versions.as_of(all_versions, latest)
    assert rows(a) == rows(b)
    assert versions.version_diff(a, b, ["id"]).count() == 0
    assert a.filter("product_category = 'electronics'").agg(F.avg("amount")).first()[0] is None


def test_restore_is_a_new_version(spark, rows):
    path, latest = _versioned(spark, "PROMO")
    assert versions.restore(spark, path, 0, latest) == 2
    v = versions.read_versions(spark, path)
    assert sorted(r.version for r in v.select("version").distinct().collect()) == [0, 1, 2]
    assert rows(versions.as_of(v, 2)) == rows(versions.as_of(v, 0)) != rows(versions.as_of(v, 1))
    with pytest.raises(Exception, match="exist"):
        versions.commit(versions.as_of(v, 0), path, 1)


def test_version_diff_counts_duplicates(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, "z"), (5, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "Y"), (4, "w"), (5, None)], "k int, v string")
    assert rows(versions.version_diff(a, b, ["k"])) == [
        (1, "delete", 1, 0), (2, "update", 1, 1), (3, "delete", 1, 0), (4, "insert", 0, 1)]


SPEC = """
source: t
dimensions:
  - name: g
    expr: upper(g)
measures:
  - name: total
    expr: SUM(x)
  - name: mean_of_means
    expr: AVG(m)
  - name: weighted
    expr: SUM(x) / SUM(n)
"""


def test_metrics(spark, rows):
    df = spark.createDataFrame([("a", 10.0, 1, 10.0), ("A", 20.0, 4, 5.0), ("b", 6.0, 2, 3.0)],
                               "g string, x double, n int, m double")
    spec = MetricSpec.from_yaml(SPEC)
    assert rows(spec.query(df, [], ["total"])) == [(36.0,)]
    by_g = spec.query(df, ["g"], ["total", "mean_of_means", "weighted"], order_by=["g"])
    assert [tuple(r) for r in by_g.collect()] == [("A", 30.0, 7.5, 6.0), ("B", 6.0, 3.0, 3.0)]
    assert rows(spec.query(df, ["g"], ["total"], where="n > 1")) == [("A", 20.0), ("B", 6.0)]
    assert rows(spec.cube(df, ["g"], ["total"])) == [("A", 0, 30.0), ("B", 0, 6.0), (None, 1, 36.0)]


def test_grand_total_is_the_sum_over_any_dimensions(spark):
    from lakewarden.plans.q_medallion import METRICS, revenue
    from tests.conftest import SF

    table = revenue(spark, SF, only_purchases=False)
    total = METRICS.query(table, [], ["transaction_count"]).first()[0]
    for dims in (["region"], ["product_category", "month"]):
        parts = METRICS.query(table, dims, ["transaction_count"])
        assert parts.agg(F.sum("transaction_count")).first()[0] == total == 60_000


def test_clustered_layout_spreads_a_frequent_value(spark):
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    laid = sinks.cluster_layout(df, ["k"], shared_path(spark, "cluster"), rows_per_file=200)
    sizes = [r["count"] for r in laid.groupBy(F.col("_metadata.file_name")).count().collect()]
    assert sum(sizes) == 3_000 and len(sizes) > 10 and max(sizes) < 800
    assert laid.exceptAll(df).count() == 0


def test_classification(spark, rows):
    cols = spark.createDataFrame([("email",), ("Region",), ("amount",)], "column_name string")
    assert rows(classify.classify_names(cols)) == [
        ("Region", "quasi-identifier"), ("amount", "non-PII"), ("email", "PII")]
    df = spark.createDataFrame([("a@b.co", "Ann"), ("c@d.org", "x1"), (None, "Bob")], "e string, n string")
    assert rows(classify.classify_values(df, ["e", "n"], threshold=0.6), "column_name", "label") == [
        ("e", "EMAIL_ADDRESS"), ("n", "PERSON_NAME")]
    text = "x" * 50_000 + " mail jo@ex.com or (743) 555-3824 and (743) 555-3825"
    t = spark.createDataFrame([(1, text), (2, "none @ ( here"), (3, None)], "id int, text string")
    assert rows(classify.pii_findings(t, ["id"], "text")) == [(1, "EMAIL_ADDRESS", 1), (1, "PHONE_NUMBER", 2)]
    out = {r.id: r.text for r in classify.pii_redact(t, "text").collect()}
    assert out[1].endswith(" mail [EMAIL_ADDRESS] or [PHONE_NUMBER] and [PHONE_NUMBER]") and len(out[1]) > 50_000
    assert out[2] == "none @ ( here" and out[3] is None


def test_k_anonymity(spark):
    df = spark.createDataFrame([("a",)] * 4 + [("b",)], "q string")
    r = classify.k_anonymity(df, ["q"], 2).first()
    assert (r.min_k, r.n_groups, r.n_rows, r.rows_at_risk, r.share_at_risk) == (1, 2, 5, 1, 0.2)


def test_tags_last_action_wins(spark, rows):
    schema = ("catalog string, schema string, object int, column_name string, tag_name string, tag_value string, "
              "action string, changed_on int")
    log = spark.createDataFrame([
        ("c", "s", 1, "a", "pii", "true", "SET", 1), ("c", "s", 1, "a", "pii", "false", "SET", 2),
        ("c", "s", 1, "b", "pii", "true", "SET", 1), ("c", "s", 1, "b", "pii", None, "UNSET", 2),
    ], schema)
    now = tags.current_tags(log, ["changed_on"])
    assert rows(now, "column_name", "tag_value") == [("a", "false")]
    change = spark.createDataFrame([("c", "s", 1, "a", "pii", None, "UNSET", 3),
                                    ("c", "s", 1, "d", "pii", "hgh", "SET", 3)], schema)
    after = tags.apply_tags(now, change, ["changed_on"])
    assert rows(after, "column_name", "tag_value") == [("d", "hgh")]
    vocab = spark.createDataFrame([("pii", "true"), ("pii", "false")], "tag_name string, allowed_value string")
    assert rows(tags.tag_violations(after, vocab)) == [("pii", "hgh", 1)]


def test_tag_variants(spark, rows):
    df = spark.createDataFrame([("domain", "analytics"), ("domain", "Analytics"), ("domain", "sales")],
                               "tag_name string, tag_value string")
    assert rows(tags.tag_variants(df), "normal_form", "n_spellings", "n_columns") == [("analytics", 2, 2)]


def test_certification_defaults(spark, rows):
    # t is in two schemas
    key = "catalog string, schema string, object string"
    assets = spark.createDataFrame([("c", "s1", "t"), ("c", "s2", "t"), ("c", "s1", "u"), ("c", "s1", "v")], key)
    t = spark.createDataFrame([
        ("c", "s1", "t", "certification", "certified"), ("c", "s1", "t", "certification", "deprecated"),
        ("c", "s1", "u", "certification", "certified")], f"{key}, tag_name string, tag_value string")
    assert rows(tags.certification(assets, t), "schema", "object", "certification") == [
        ("s1", "t", "deprecated"), ("s1", "u", "certified"), ("s1", "v", "uncertified"), ("s2", "t", "uncertified")]


def test_domains_and_facets_use_the_whole_name(spark, rows):
    key = "catalog string, schema string, object string"
    assets = spark.createDataFrame([("c", "s1", "t", "t", "x"), ("c", "s2", "t", "t", "x")], f"{key}, name string, comment string")
    claims = spark.createDataFrame([("d1", "c", "s1", "t"), ("d2", "c", "s1", "t"), ("d1", "c", "s2", "t"), ("d1", "c", "s9", "gone")],
                                   f"domain string, {key}")
    assert rows(tags.domain_contents(claims, assets)) == [("d1", "c", "s1", 1, 1), ("d1", "c", "s2", 1, 0), ("d2", "c", "s1", 1, 1)]
    roles = spark.createDataFrame([("d1", "tess", "bea")], "domain string, technical_owner string, business_owner string")
    assert ("d1", "c", "s2", 1, 0, "tess", "bea") in rows(
        tags.domain_contents(claims, assets, roles), "domain", "catalog", "schema", "n_assets", "n_conflicts", "technical_owner", "business_owner")
    assert rows(tags.domain_conflicts(claims)) == [("c", "s1", "t", 2, "d1", "d2")]
    marks = spark.createDataFrame([("c", "s2", "t", "a", "pii", "true")], f"{key}, column_name string, tag_name string, tag_value string")
    own = spark.createDataFrame([("c", "s1", "t", "ann"), ("c", "s1", None, "bob")], f"{key}, owner string")
    faceted = tags.with_facets(assets, marks, claims, own)
    assert rows(tags.asset_search(faceted, "T", {"tags": "pii=true"}), "schema") == [("s2",)]
    assert rows(tags.asset_search(faceted, "t", {"domains": "d2", "owners": "ann"}), "schema") == [("s1",)]
    assert ("domains", "d1", 2) in rows(tags.facet_counts(faceted, ["schema", "tags", "domains", "owners"]))


def test_trailing_window_has_both_ends(spark, rows):
    df = spark.createDataFrame([(date(2024, 1, d),) for d in (2, 3, 10, 11)], "d date")
    kept = df.filter(lineage.trailing("d", date(2024, 1, 10))).collect()
    assert {r.d for r in kept} == {date(2024, 1, 3), date(2024, 1, 10)}
    used = spark.createDataFrame([
        ("a", "t", "TABLE", date(2024, 1, 5)), ("a", "t", "TABLE", date(2024, 6, 1)), ("b", "t", "TABLE", date(2024, 6, 1))],
        "source_table_full_name string, target_table_full_name string, entity_type string, event_date date")
    # An edge used in the window and later is found, one used only later is not.
    assert rows(lineage.upstream(used, "t", date(2024, 1, 10)), "source_table_full_name", "event_date") == [("a", date(2024, 1, 5))]
    assert rows(lineage.downstream(used, "b", date(2024, 1, 10))) == []


def test_text_patterns_cost_linear_time(spark):
    import time

    texts = ["a" * 100_000 + " @ ", "1.2-" * 25_000 + "@", "x@y.de, call +1 (743) 555-3824 " + "-" * 100_000 + "@"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").coalesce(1)
    start = time.time()
    found = {(r.id, r.label): r.matches for r in classify.pii_findings(df, ["id"], "text").collect()}
    assert found == {(2, "EMAIL_ADDRESS"): 1, (2, "PHONE_NUMBER"): 1}
    assert classify.pii_redact(df, "text").filter("id = 2").first().text.startswith("[EMAIL_ADDRESS], call [PHONE_NUMBER] ---")
    assert time.time() - start < 5


def test_draw_uuid_and_scale(spark):
    from lakewarden.functions.scalars import draw, exact_avg, exact_sum

    big = spark.range(2000).select((draw("id", "x") % (1 << 40)).alias("p"))
    assert big.filter(F.col("p") >= 1 << 32).count() > 1900  # parents beyond 2^32 are drawn
    ids = spark.createDataFrame([(1 << 48,), (0,), ((1 << 63) - 1,)], "id bigint").select(uuid_text("id").alias("u"))
    got = {r.u for r in ids.collect()}
    assert got == {"00000000-0000-0000-0001-000000000000", "00000000-0000-0000-0000-000000000000", "00000000-0000-0000-7fff-ffffffffffff"}
    small = spark.createDataFrame([(0.00004,), (0.00002,)], "v double")
    assert small.agg(exact_sum("v", None).alias("s")).first().s == pytest.approx(0.00006)
    assert small.agg(exact_avg("v").alias("s")).first().s == 0.0


def test_nested_groups_in_policies(spark, rows):
    people = spark.createDataFrame([("ann@x",)], "email string")
    direct = spark.createDataFrame([("inner", "ann")], "grp string, principal string")
    nested = spark.createDataFrame([("inner", "admins")], "src string, dst string")
    registry = policy.PolicyRegistry().attach_mask("c", "email", policy.MaskPolicy("admins"))
    members = access.expand_members(direct, nested)
    assert rows(policy.secure(people, "c", registry, "ann", members)) == [("ann@x",)]
    assert rows(policy.secure(people, "c", registry, "bob", members)) == [("an****",)]


def test_masks_from_the_tag_table(spark, rows):
    people = spark.createDataFrame([("ann@x", "Bonn")], "email string, city string")
    table = spark.createDataFrame([
        ("c", "s", "t", "email", "pii", "true"), ("c", "s", "t", "email", "sensitivity_level", "medium"), ("c", "s2", "t", "city", "pii", "true")],
        "catalog string, schema string, object string, column_name string, tag_name string, tag_value string")
    own = policy.tags_of_table(table, "c", "s", "t")
    assert own == {"email": {"pii": "true", "sensitivity_level": "medium"}}
    assert rows(policy.secure_by_tags(people, own, {"medium": 2}, False)) == [("an****", "Bonn")]


def test_cube_and_query_agree(spark):
    from lakewarden.plans.metrics import MetricSpec

    df = spark.createDataFrame([(date(2020, 3, 1), 1.0), (date(2020, 7, 1), 2.0)], "month date, v double")
    spec = MetricSpec("t", {"month": "date_trunc('YEAR', month)"}, {"last": "MAX(month)", "total": "SUM(v)"})
    flat = spec.query(df, ["month"], ["last", "total"]).first()
    cube = spec.cube(df, ["month"], ["last", "total"]).filter("grain = 0").first()
    assert (flat.month, flat["last"], flat.total) == (cube.month, cube["last"], cube.total) and flat["last"] == date(2020, 7, 1)


def test_edges_from_steps_and_merge(spark, rows):
    steps = spark.createDataFrame([("gold", ["silver", "totals"], ["score"]), ("gold", ["silver"], [])],
                                  "target string, sources array<string>, functions array<string>")
    edges = lineage.edges_from_steps(steps)
    assert rows(edges) == [("score", "gold", "FUNCTION"), ("silver", "gold", "TABLE"), ("totals", "gold", "TABLE")]
    ends = ["source_table_full_name", "target_table_full_name"]
    external = spark.createDataFrame([("crm", "silver"), ("silver", "gold")], f"{ends[0]} string, {ends[1]} string")
    merged = lineage.merge_edges(edges.select(*ends), external)
    assert ("silver", "gold", "automatic") in rows(merged) and ("crm", "silver", "external") in rows(merged)


def test_share_items(spark, rows):
    t = spark.createDataFrame([(1, "N", 0), (2, "S", 0), (3, "N", 1)], "id int, region string, version int")
    items = [shares.ShareItem("s", "t", "north", "region = 'N'", ("id",), version=1)]
    assert rows(shares.share_contents(items, {"t": t})) == [("s", "t", "north", "region = 'N'", 1, 1)]
    paths = shares.share_extract(items, {"t": t}, shared_path(spark, "share"))
    assert rows(spark.read.parquet(paths["north"])) == [(3,)]


def test_profile_of_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "x double, y string")
    p = {r.column_name: r for r in monitor.profile(df, "t", distinct="exact").collect()}
    assert (p["x"].nulls, p["x"].distinct_values, p["x"].mean, p["x"].min_number) == (0, 2, 2.0, 1.0)
    assert (p["y"].nulls, p["y"].null_rate, p["y"].distinct_values, p["y"].min_text) == (2, 1.0, 0, None)
    approx = {r.column_name: r for r in monitor.profile(df, "t").collect()}
    assert approx["x"].distinct_values == 2


def test_drift(spark):
    same = spark.createDataFrame([(float(i % 10), i < 100) for i in range(200)], "v double, base boolean")
    assert monitor.drift(same, "v", ~F.col("base"), [2.0, 5.0]).first().psi == 0.0
    moved = spark.createDataFrame([(1.0, True), (9.0, True), (9.0, False), (None, False)], "v double, base boolean")
    r = monitor.drift(moved, "v", ~F.col("base"), [5.0], epsilon=0.01).first()
    want = (0.5 - 0.01) * math.log(0.5 / 0.01) + (0.5 - 1.0) * math.log(0.5 / 1.0)
    assert r.psi == round(want, 6) and r.null_rate_delta == 0.5


def test_federated_options():
    o = tables.federated_options("jdbc:x", "t", partition_col="id", bounds=(0, 100), partitions=4, user="u")
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"], o["user"]) == (
        "id", "0", "100", "4", "u")
    with pytest.raises(ValueError):
        tables.federated_options("jdbc:x", "t", partition_col="id")


def test_sql_functions(spark, rows):
    sql.register_sql_functions(spark, is_admin=False, allowed="NORTH")
    assert spark.sql("SELECT score_customer_health('test-customer-001')").first()[0] == 89.1
    spark.createDataFrame([("ann@x", "NORTH"), (None, "NORTH"), ("bob@x", None)], "email string, region string"
                          ).createOrReplaceTempView("people")
    text = "SELECT mask_pii(email) FROM people WHERE filter_by_region(region)"
    assert rows(spark.sql(text)) == [("an****",), (None,)]
    sql.register_sql_functions(spark, is_admin=True, allowed="NORTH")
    assert spark.sql(text).count() == 3


def test_columns_table(spark, rows):
    got = tables.columns_table(spark, {"t": spark.createDataFrame([], "a int, b array<string>")})
    assert rows(got) == [("t", "a", "int", 1), ("t", "b", "array<string>", 2)]


def test_request_queue_and_audit(spark, rows):
    r = spark.createDataFrame([("o", "approved", date(2024, 1, 1), date(2024, 1, 4)), ("o", "pending", date(2024, 1, 1), None)],
                              "owner string, status string, asked_on date, decided_on date")
    assert rows(access.request_queue(r)) == [("o", "approved", 1, 3.0), ("o", "pending", 1, None)]


def test_version_at_a_time(spark, tmp_path):
    from datetime import datetime

    path = f"{tmp_path}/v"
    for v in range(3):
        versions.commit(spark.range(v + 1), path, v)
    log = spark.createDataFrame([(v, datetime(2024, 1, 1 + v, 12)) for v in range(3)], "version int, at timestamp")
    stored = versions.read_versions(spark, path)
    assert versions.as_of_time(stored, log, datetime(2024, 1, 2, 18)).count() == 2
    assert versions.as_of_time(stored, log, datetime(2024, 1, 1, 12)).count() == 1
    with pytest.raises(ValueError):
        versions.version_at(log, datetime(2023, 1, 1))


def test_tags_from_classification(spark, rows):
    key = "catalog string, schema string, object string, column_name string"
    columns = spark.createDataFrame([("c", "s", "t", "email"), ("c", "s", "t", "size")], key)
    changes = tags.tag_changes(classify.classify_names(columns), changed_on=date(2024, 1, 2))
    now = spark.createDataFrame([("c", "s", "t", "email", "pii", "false"), ("c", "s", "t", "size", "pii", "false")],
                                f"{key}, tag_name string, tag_value string")
    assert rows(tags.apply_tags(now, changes, ["changed_on", "seq"]), "column_name", "tag_value") == [("email", "true"), ("size", "false")]


def test_quarantine_is_written_in_one_pass(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    good, bad = integrity.quarantine_write(df, {"positive": F.col("v") > 0}, f"{tmp_path}/q")
    assert rows(good) == [(1, 5)] and rows(bad, "id", "failed") == [(2, ["positive"]), (3, ["positive"])]


def test_staged_tables_are_released(spark, tmp_path, monkeypatch):
    from lakewarden import session

    monkeypatch.setattr(session, "shared_path", lambda spark, label: f"{tmp_path}/app/{label}-1")
    assert session.stage(spark.range(3), "x").count() == 3 and (tmp_path / "app" / "x-1").exists()
    session.release(spark)
    assert not (tmp_path / "app").exists()


def test_scratch_folders_are_per_thread_and_passed_on(spark):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    from lakewarden import session

    both = Barrier(2)

    def work(name):
        with session.scratch(name):
            both.wait(30)
            made = session.stage_all({"a": spark.range(1), "b": spark.range(2)})
            return [f for df in made.values() for f in df.inputFiles()]

    with ThreadPoolExecutor(2) as pool:
        for name, files in zip("xy", pool.map(work, "xy")):
            assert len(files) >= 2 and all(f"/{name}/" in f for f in files)
    assert "/x/" not in session.shared_path(spark, "z")
