"""Search, key filters, hash trees, sketches, drift, curve layout, near misses, expectation actions, containment."""

import math
import random
import re
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from lakewarden import session
from lakewarden.operators import access, classify, integrity, lineage, monitor, search, tags, versions
from lakewarden.sources import sinks
from lakewarden.sources.tables import load
from tests.conftest import SF
from tests.test_plans import plan

# Closure


def reached(edges, root):
    seen, queue = {root: 0}, deque([root])
    while queue:
        n = queue.popleft()
        for a, b in edges:
            if a == n and b not in seen:
                seen[b] = seen[n] + 1
                queue.append(b)
    return seen


def test_closure_of_many_origins_with_cycles(spark):
    """More origins than bits of one number, on a graph with cycles, a hub and repeated edges."""
    rng = random.Random(3)
    names = [f"n{i}" for i in range(90)]
    edges = [(rng.choice(names), rng.choice(names)) for _ in range(130)] + [("hub", n) for n in names[:40]] + [("n1", "hub")] * 3
    origins = [(f"o{i}", rng.choice(names + ["hub", "nowhere"])) for i in range(150)] + [("two", "n1"), ("two", "n2")]
    e = spark.createDataFrame(edges + [(None, "n1"), ("n5", "n5")], "src string, dst string")
    r = spark.createDataFrame(origins + [("none", None)], "origin string, node string").repartition(3)
    got = {(x.origin, x.node): x.depth for x in lineage.closure(e, r).collect()}
    want = {}
    for o, root in origins:
        for n, d in reached(edges, root).items():
            want[o, n] = min(d, want.get((o, n), d))
    assert got == want
    near = {(x.origin, x.node): x.depth for x in lineage.closure(e, r, max_depth=1).collect()}
    assert near == {k: d for k, d in want.items() if d <= 1}


def test_closure_shuffles_edges_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(session, "watchers", [lambda df, label: seen.append((label, plan(df)))])
    e = spark.range(3000).select((F.col("id") % 50).cast("string").alias("src"), (F.col("id") % 70).cast("string").alias("dst"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lineage.closure(e, spark.createDataFrame([("1",)], "node string")).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(label == "laid edges" for label, _ in seen) == 1
    hops = [text for label, text in seen if label == "hop" and "SortMergeJoin" in text]
    # The frontier and the reached nodes are shuffled, the edges come from their buckets.
    assert hops and all("Bucketed: true" in text and len(re.findall(r"hashpartitioning\(src", text)) == 0 for text in hops)
    seen.clear()
    lineage.closure(e, spark.createDataFrame([("1",)], "node string")).count()
    assert not [label for label, text in seen if label == "laid edges" or (label == "hop" and "SortMergeJoin" in text)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lakewarden_edges")]


# Access by bitmaps


def test_counts_where_every_principal_has_groups_of_its_own(spark):
    rng = random.Random(1)
    members = {(f"p{i}", g) for i in range(25) for g in {f"own{i}", f"g{rng.randrange(6)}", f"g{rng.randrange(6)}"}}
    objects = [(f"c{i % 2}", f"s{i % 4}", i) for i in range(60)]
    grants = {("TABLE", *rng.choice(objects), rng.choice([f"own{rng.randrange(25)}", f"g{rng.randrange(6)}"]), "SELECT") for _ in range(300)}
    grants |= {("CATALOG", c, None, None, f"g{i}", p) for c in ("c0", "c1") for i in range(6) for p in ("USE CATALOG", "USE SCHEMA") if i + len(p) != 13}
    held = {}
    for p, g in members:
        for _, c, _, o, who, right in grants:
            if who == g:
                held.setdefault(p, set()).add((right, c, o))
    want = Counter(c for p in held for r, c, o in held[p] if r == "SELECT" and ("USE CATALOG", c, None) in held[p] and ("USE SCHEMA", c, None) in held[p])
    got = access.effective_access(
        spark.createDataFrame(sorted(grants, key=str), "securable_type string, catalog string, schema string, object long, grantee string, privilege string"),
        spark.createDataFrame(sorted(members), "principal string, grp string"),
        spark.createDataFrame(objects, "catalog string, schema string, object long"))
    assert {r.catalog: r.readable_pairs for r in got.collect()} == want


# Subject map


def test_filter_keeps_all_asked_keys_and_few_others(spark):
    asked = spark.createDataFrame([(i,) for i in range(0, 5000, 5)] + [(None,), (-7,)], "subject_id long")
    found = lineage.key_filter(asked, "subject_id", 1 << 17)
    rows = spark.createDataFrame([(i % 6000,) for i in range(12000)] + [(-7,), (None,)], "subject_id long")
    kept = [r[0] for r in lineage.might_hold(rows, "subject_id", found, 1 << 17).collect()]
    must = [i % 6000 for i in range(12000) if i % 6000 < 5000 and i % 6000 % 5 == 0] + [-7]
    assert not Counter(must) - Counter(kept) and len(kept) < len(must) * 1.2


@pytest.mark.parametrize("above", [0, 10 ** 6])
def test_subject_map_counts_asked_rows_alone(spark, rows, above):
    orders = load(spark, SF, "orders")
    ids = spark.createDataFrame([(1,), (2,), (2,), (10 ** 9,), (None,)], "subject_id long")
    got = lineage.subject_map({"orders": (orders, "o_custkey")}, ids, filter_above=above)
    assert rows(got) == rows(orders.filter("o_custkey in (1, 2)").groupBy("o_custkey").count().select(
        F.col("o_custkey").alias("subject_id"), F.lit("orders").alias("table_name"), F.col("count").alias("n_rows")))
    text = plan(got)
    assert text.rindex("HashAggregate (", 0, text.index("LeftSemi")) < text.index("LeftSemi")  # the tree is printed from the top


def test_files_without_a_key_are_not_opened(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(10_000).select((F.col("id") * 3).alias("k"), F.lit(1).alias("v")).repartition(40, F.col("k") % 40).write.parquet(path)
    table = spark.read.parquet(path)
    index = lineage.file_index(table, "k")
    index.write.parquet(f"{tmp_path}/index")
    index = spark.read.parquet(f"{tmp_path}/index")
    asked = spark.createDataFrame([(3 * 77,), (1,), (10 ** 7,)], "k long")
    names = lineage.files_holding(index, asked, "k")
    holding = {r[0] for r in table.filter(F.col("k") == 231).select("_metadata.file_path").collect()}
    assert holding <= set(names) and len(names) <= 3
    assert spark.read.schema(table.schema).parquet(*names).join(asked, "k").count() == 1
    assert lineage.files_holding(index, asked.limit(0), "k") == []


# Search


def test_ranking_equals_plain_scores(spark):
    rng = random.Random(2)
    words = ["red", "blue", "Table", "of", "orders"]
    assets = [(i, rng.choice(words), " ".join(rng.choices(words, k=rng.randrange(6)))) for i in range(60)] + [(60, "zeta", None), (61, "", "")]
    marks = [(rng.randrange(60), "level", rng.choice(["high", "low"])) for _ in range(40)] + [(999, "level", "high")]
    docs = {i: re.findall("[a-z0-9]+", f"{n} {c or ''}".lower()) for i, n, c in assets}
    for i, n, v in marks:
        if i in docs:
            docs[i] += [n, v]
    asked, mean = ["high", "red", "zeta"], sum(map(len, docs.values())) / len(docs)
    want = {}
    for t in asked:
        having = [i for i in docs if t in docs[i]]
        idf = math.log(1 + (len(docs) - len(having) + 0.5) / (len(having) + 0.5))
        for i in having:
            tf = docs[i].count(t)
            want[i] = want.get(i, 0) + idf * tf * (search.K1 + 1) / (tf + search.K1 * (1 - search.B + search.B * len(docs[i]) / mean))
    index = search.build_index(spark.createDataFrame(assets, "object long, name string, comment string"),
                               spark.createDataFrame(marks, "object long, tag_name string, tag_value string"),
                               ["object"], ["name", "comment"], ["tag_name", "tag_value"])
    got = [(r.object, r.score) for r in search.ranked(index, "HIGH, red zeta high!", 10).collect()]
    assert got == sorted(((i, round(s, 6)) for i, s in want.items()), key=lambda x: (-x[1], x[0]))[:10]
    assert search.ranked(index, "absent", 5).count() == 0 and search.ranked(index, "?!", 5).count() == 0
    assert "In(term, [high,red])" in plan(search.ranked(index, "red high", 3))


# Hash trees


def test_equal_ranges_are_not_compared(spark, rows):
    a = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("v"), F.lit(None).cast("string").alias("w"))
    changed = a.withColumn("v", F.when(F.col("k").isin(5, 600), F.lit(-1.0)).otherwise(F.col("v")))
    b = changed.filter("k <> 9000").unionByName(a.filter("k = 12")).unionByName(a.limit(1).withColumn("k", F.lit(10 ** 6).cast("bigint")))
    leaves = 1 << 12
    differ = versions.changed_leaves(versions.hash_tree(a, ["k"], leaves), versions.hash_tree(b, ["k"], leaves))
    assert 1 <= differ.count() <= 5
    assert versions.changed_leaves(versions.hash_tree(a, ["k"], leaves), versions.hash_tree(a.repartition(5), ["k"], leaves)).count() == 0
    got = rows(versions.tree_diff(a, b, ["k"]))
    assert got == rows(versions.version_diff(a, b, ["k"])) and len(got) == 5


def test_moved_nulls_and_duplicates_are_differences(spark, rows):
    a = spark.createDataFrame([(1, None, "x"), (2, "y", "y"), (2, "y", "y"), (3, None, None), (None, "n", None)], "k long, a string, b string")
    b = spark.createDataFrame([(1, "x", None), (2, "y", "y"), (3, None, None), (None, None, "n")], "k long, a string, b string")
    assert rows(versions.tree_diff(a, b, ["k"])) == rows(versions.version_diff(a, b, ["k"])) != []
    assert versions.tree_diff(a.limit(0), b.limit(0), ["k"]).count() == 0


# Sketches and drift


def test_days_merge_to_quantiles_within_bounds(spark, monkeypatch):
    events = load(spark, SF, "events").withColumn("day", F.col("ts").cast("date"))
    days = session.stage(monitor.daily_profile(events, "events", "day", ["value", "event_type"]), "days")
    for where in ("day < date '2024-01-09'", "day >= date '2024-01-20'", "true"):
        merged = monitor.merge_profiles(days.filter(where))
        assert "events.parquet" not in plan(merged)  # the days are used again, the table is not read
        got = {r.column_name: r for r in merged.collect()}
        values = sorted(r[0] for r in events.filter(where).select("value").collect())
        assert got["value"].n_rows == len(values) and got["value"].low == values[0] and got["value"].high == values[-1]
        for p, q in ((0.25, got["value"].lower_quartile), (0.5, got["value"].median), (0.75, got["value"].upper_quartile)):
            assert abs(sum(v <= q for v in values) / len(values) - p) < 0.03
        assert abs(got["value"].distinct_values / len(set(values)) - 1) < 0.06
        assert got["event_type"].median is None and got["event_type"].quantiles is None
    edges = monitor.quantile_edges(monitor.merge_profiles(days), "value", 4)
    assert len(edges) == 3 and edges == sorted(edges) and monitor.quantile_edges(merged, "event_type") == []
    later = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    assert monitor.drift(events, "value", later, edges).first().psi < 0.05


def test_ks_equals_plain_distance(spark):
    rng = random.Random(4)
    data = [(float(rng.randrange(30)), False) for _ in range(200)] + [(float(rng.randrange(5, 40)), True) for _ in range(90)]
    odd = [(None, True), (float("nan"), False), (-0.0, True), (0.0, False)]
    clean = [(v, w) for v, w in data + odd if v is not None and v == v]
    base, late = ([v for v, w in clean if w == side] for side in (False, True))
    want = max(abs(sum(x <= v for x in base) / len(base) - sum(x <= v for x in late) / len(late)) for v in base + late)
    df = spark.createDataFrame(data + odd, "v double, late boolean").repartition(6)
    got = monitor.ks_drift(df, "v", F.col("late")).first()
    assert (got.base_rows, got.current_rows) == (len(base), len(late)) and got.ks == pytest.approx(want, abs=1e-8)
    none = monitor.ks_drift(df.filter("not late"), "v", F.col("late")).first()
    assert (none.current_rows, none.ks) == (0, None) and monitor.ks_drift(df.limit(0), "v", F.col("late")).first().ks is None


# Layout


def test_curve_narrows_files_on_every_column(spark, tmp_path):
    df = spark.range(4096).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"), F.lit(None).cast("int").alias("n"))

    def widths(laid):
        f = laid.groupBy(F.col("_metadata.file_name").alias("f")).agg(
            (F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")).agg(F.avg("a"), F.avg("b"), F.count("*")).first()
        return tuple(f)

    curve = sinks.curve_layout(df, ["a", "b"], f"{tmp_path}/c", 256)
    lexical = sinks.cluster_layout(df, ["a", "b"], f"{tmp_path}/l", 256)
    assert curve.count() == 4096 and curve.exceptAll(df).count() == 0
    (ca, cb, n), (_, lb, _) = widths(curve), widths(lexical)
    assert n >= 10 and ca < 40 and cb < 40 and lb > 55
    assert sinks.curve_layout(df.limit(0), ["a", "n"], f"{tmp_path}/e").count() == 0
    assert sinks.curve_layout(df, ["n"], f"{tmp_path}/n", 1000).count() == 4096


# Near misses


def test_near_misses_equal_all_pairs(spark, rows):
    rng = random.Random(6)
    allowed = [("t", w) for w in ("high", "medium", "low", "a", "")] + [("u", "high")]
    values = {"hgh", "hihg", "hi", "loww", "", "x", "lo", "high", "medum", "mdum", "low ", "z" * 5000, "ab", "abcd"}
    values |= {"".join(rng.choices("highlow", k=rng.randrange(1, 7))) for _ in range(60)}
    marks = [(t, v) for v in sorted(values) for t in ("t", "u", "other")] + [("t", "hgh"), ("t", None)]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    count = Counter(marks)
    want = sorted(((t, v, n, w, edits(v, w)) for (t, v), n in count.items() if v is not None and len(v) < 100 and (t, v) not in allowed
                   for g, w in allowed if g == t and edits(v, w) <= 2), key=repr)
    got = tags.near_misses(spark.createDataFrame(marks, "tag_name string, tag_value string"),
                           spark.createDataFrame(allowed, "tag_name string, allowed_value string"))
    assert rows(got, "tag_name", "tag_value", "n_columns", "suggestion", "edits") == want


# Expectations


def test_actions_drop_quarantine_and_fail(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, -5), (3, None), (-4, 5), (-5, -5)], "k long, v long")
    rules = {"v": (F.col("v") > 0, integrity.QUARANTINE), "k": (F.col("k") > 0, integrity.DROP)}
    path = f"{tmp_path}/out"
    assert integrity.write_expected(df, rules, path) == {"v": 3, "k": 2}
    good, bad = integrity.read_expected(spark, path, "k long, v long")
    assert rows(good) == [(1, 5)]
    assert sorted((r.k, r.v, tuple(r.failed)) for r in bad.collect()) == [(-5, -5, ("v", "k")), (2, -5, ("v",)), (3, None, ("v",))]
    with pytest.raises(FileExistsError):
        integrity.write_expected(df, rules, path)
    with pytest.raises(integrity.ExpectationFailed) as e:
        integrity.write_expected(df, {**rules, "small": (F.col("v") < 5, integrity.FAIL)}, f"{tmp_path}/other")
    assert e.value.broken == {"small": 3} and [p.name for p in tmp_path.iterdir()] == ["out"]
    with pytest.raises(ValueError):
        integrity.write_expected(df, {"k": (F.col("k") > 0, "warn")}, f"{tmp_path}/x")


# Containment


def test_containment_is_near_the_exact_share(spark):
    df = spark.range(8000).select(F.concat(F.lit(" Name"), F.col("id")).alias("a"), (F.col("id") % 3).cast("string").alias("b"),
                                  F.lit(None).cast("string").alias("c"))
    known = spark.range(0, 8000, 4).select(F.concat(F.lit("name"), F.col("id"), F.lit(" ")).alias("n"))
    got = {r.column_name: r for r in classify.containment(df, ["a", "b", "c"], known, "n", k=1000).collect()}
    assert set(got) == {"a", "b"} and got["a"].bound > 0 and abs(got["a"].share - 0.25) <= got["a"].bound
    assert (got["b"].share, got["b"].bound) == (0.0, 0.0)
    exact = {r.column_name: r for r in classify.containment(df, ["a"], known, "n", k=8000).collect()}
    assert (exact["a"].share, exact["a"].bound) == (0.25, 0.0)


def test_column_map_of_declared_steps(spark, rows):
    sources = {"C": ["id", "name"], "t": ["id", "amount", "info"]}

    def mapped(**columns):
        return lineage.column_map(spark, lineage.StepSpec("gold", sources, columns))

    assert mapped(total="sum(AMOUNT) over (partition by c.id)") == [("C", "id", "total"), ("t", "amount", "total")]
    assert mapped(one="1", deep="t.info.city", list="exists(array(name), id -> id = 'x')") == [
        ("C", "name", "list"), ("t", "info", "deep")]
    assert mapped(**{"c.*": "c.*", "n": "count(t.*)"}) == [
        ("C", "id", "id"), ("C", "name", "name"), ("t", "amount", "n"), ("t", "id", "n"), ("t", "info", "n")]
    assert len(mapped(**{"*": "*"})) == 5
    for wrong in ("id", "nowhere", "x.amount", "(select max(amount) from t)"):
        with pytest.raises(ValueError):
            mapped(v=wrong)


def test_declared_columns_feed_the_closure(spark, rows):
    steps = spark.createDataFrame(
        [("clean", "silver", [("b", "bronze")]), ("clean", "silver", [("b", "bronze")]), ("score", "gold", [("s", "silver")]),
         ("other", "x", [("b", "bronze")]), ("clean", "none", None), (None, "y", [("b", "bronze")])],
        "kind string, target string, sources array<struct<alias:string,table:string>>")
    specs = [lineage.StepSpec("clean", {"b": ["mail", "age"]}, {"contact": "lower(mail)", "age": "age"}),
             lineage.StepSpec("score", {"s": ["contact", "age"]}, {"reach": "contact is not null"})]
    edges = lineage.column_edges_from_steps(steps, specs)
    assert rows(edges) == [("bronze", "age", "silver", "age"), ("bronze", "mail", "silver", "contact"),
                           ("silver", "contact", "gold", "reach")]
    roots = spark.createDataFrame([("bronze.mail",)], "node string")
    assert rows(lineage.closure(lineage.column_arcs(edges), roots)) == [
        ("bronze.mail", 0), ("gold.reach", 2), ("silver.contact", 1)]
    assert rows(lineage.column_edges_from_steps(steps.limit(0), specs)) == []
