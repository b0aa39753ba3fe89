"""Closure and access against plain Python on small random inputs, hot keys included."""

import random
from collections import deque

import pytest

from lakewarden.operators import access, integrity, lineage, tags, versions
from pyspark.sql import functions as F


def _depths(edges, root):
    seen, queue = {root: 0}, deque([root])
    while queue:
        n = queue.popleft()
        for a, b in edges:
            if a == n and b not in seen:
                seen[b] = seen[n] + 1
                queue.append(b)
    return seen


def _closure(spark, edges, roots, **kwargs):
    e = spark.createDataFrame(edges, "src string, dst string")
    r = spark.createDataFrame([(x,) for x in roots], "node string")
    return {x.node: x.depth for x in lineage.closure(e, r, **kwargs).collect()}


def test_closure_on_cycles_diamonds_and_self_edges(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "a"), ("d", "d"), ("x", "y"), (None, "b")]
    assert _closure(spark, edges, ["a"]) == {"a": 0, "b": 1, "c": 1, "d": 2}
    assert _closure(spark, edges, ["a"], max_depth=1) == {"a": 0, "b": 1, "c": 1}
    assert _closure(spark, edges, ["nowhere"]) == {"nowhere": 0}
    assert _closure(spark, edges, ["b", "x"]) == {"b": 0, "x": 0, "d": 1, "y": 1, "a": 2, "c": 3}


def test_closure_random_with_hub(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for _ in range(60)]
    edges += [("hub", f"n{i}") for i in range(30)] + [("n3", "hub")]
    assert _closure(spark, edges, ["n3"]) == _depths(edges, "n3")


def test_closure_keeps_origins_apart(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a")]
    e = spark.createDataFrame(edges, "src string, dst string")
    r = spark.createDataFrame([("a", "a"), ("b", "b")], "origin string, node string")
    got = {(x.origin, x.node): x.depth for x in lineage.closure(e, r).collect()}
    assert got == {(o, n): d for o in "ab" for n, d in _depths(edges, o).items()}


def test_impact_upstream(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c")], "source_table_full_name string, target_table_full_name string")
    r = spark.createDataFrame([("c",)], "node string")
    assert {x.node: x.depth for x in lineage.impact(e, r, "up").collect()} == {"c": 0, "b": 1, "a": 2}


def test_tags_propagate_through_renames(spark):
    arcs = spark.createDataFrame([("t.email", "u.contact"), ("u.contact", "v.x"), ("t.id", "u.id")],
                                 "src string, dst string")
    tagged = spark.createDataFrame([("t.email",)], "node string")
    assert {(x.node, x.depth) for x in tags.propagate_tags(tagged, arcs).collect()} == {
        ("t.email", 0), ("u.contact", 1), ("v.x", 2)}


def _world(seed):
    rng = random.Random(seed)
    people = [f"p{i}" for i in range(12)]
    groups = ["all", "g1", "g2", "g3"]
    members = [("all", p) for p in people[:9]]  # the last three are in no group that holds everybody
    members += [(rng.choice(groups[1:3]), p) for p in people[:8]]
    nested = [("g1", "g3")]
    objects = [(f"c{i % 2}", f"s{i % 6}", i) for i in range(24)]
    grants = []
    for _ in range(70):
        who = rng.choice(people + groups * 2)
        c, s, o = rng.choice(objects)
        kind = rng.random()
        if kind < 0.25:
            grants.append(("CATALOG", c, None, None, who, "USE CATALOG"))
        elif kind < 0.45:
            grants.append(("SCHEMA", c, s, None, who, "USE SCHEMA"))
        elif kind < 0.5:
            grants.append(("CATALOG", c, None, None, who, "USE SCHEMA"))
        elif kind < 0.9:
            grants.append(("TABLE", c, s, o, who, "SELECT"))
        elif kind < 0.97:
            grants.append(("SCHEMA", c, s, None, who, "SELECT"))
        else:
            grants.append(("CATALOG", c, None, None, who, "SELECT"))
    # One group holds a third of all grants.
    grants += [("TABLE", *rng.choice(objects), "all", "SELECT") for _ in range(35)]
    owners = [(*objects[0], "p1"), (*objects[5], "p11"), ("c0", "s2", None, "p10"), ("c1", None, None, "p9"), ("c0", "s0", None, "p0")]
    return people, members, nested, objects, grants, owners


def _may(person, obj, privilege, world):
    _, members, nested, _, grants, owners = world
    holders = {person} | {g for g, p in members if p == person}
    holders |= {up for low, up in nested if low in holders}
    c, s, o = obj
    if privilege == "SELECT" and (c, s, o, person) in owners:
        return True
    if (c, None, None, person) in owners or (privilege != "USE CATALOG" and (c, s, None, person) in owners):
        return True
    return any(
        who in holders and what == privilege and gc == c and gs in (None, s) and go in (None, o)
        for _, gc, gs, go, who, what in grants)


def _frames(spark, world):
    people, members, nested, objects, grants, owners = world
    memberships = access.expand_members(
        spark.createDataFrame(members, "grp string, principal string"),
        spark.createDataFrame(nested, "src string, dst string"))
    return (
        spark.createDataFrame(grants, "securable_type string, catalog string, schema string, object int, "
                                      "grantee string, privilege string"),
        memberships,
        spark.createDataFrame(objects, "catalog string, schema string, object int"),
        spark.createDataFrame(owners, "catalog string, schema string, object int, owner string"),
    )


PRIVILEGES = ["USE CATALOG", "USE SCHEMA", "SELECT"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_effective_access_and_gaps(spark, seed):
    world = _world(seed)
    frames = _frames(spark, world)
    missing = {
        (p, o): ",".join(k for k in PRIVILEGES if not _may(p, o, k, world)) for p in world[0] for o in world[3]}
    want = {}
    for (_, o), lacks in missing.items():
        if not lacks:
            want[o[0]] = want.get(o[0], 0) + 1
    assert {r.catalog: r.readable_pairs for r in access.effective_access(*frames).collect()} == want
    required = spark.createDataFrame(
        [(p, *o) for p in world[0] for o in world[3]] * 2, "principal string, catalog string, schema string, object int")
    got = {(r.principal, (r.catalog, r.schema, r.object)): r.missing
           for r in access.access_gaps(required, *frames).collect()}
    assert got == {k: v for k, v in missing.items() if v}


def test_execute_on_functions(spark, rows):
    world = _world(4)
    people, members, nested, objects, grants, owners = world
    as_functions = [("FUNCTION" if kind == "TABLE" else kind, c, s, o, who, "EXECUTE" if what == "SELECT" else what)
                    for kind, c, s, o, who, what in grants]
    frames = _frames(spark, (people, members, nested, objects, as_functions, owners))
    reads = rows(access.effective_access(*_frames(spark, world)))
    assert reads and rows(access.effective_access(*frames, privilege="EXECUTE")) == reads
    required = spark.createDataFrame([("p0", *objects[3])], "principal string, catalog string, schema string, object int")
    lacks = [k.replace("SELECT", "EXECUTE") for k in PRIVILEGES if not _may("p0", objects[3], k, world)]
    got = access.access_gaps(required, *frames, privilege="EXECUTE").collect()
    assert [r.missing for r in got] == ([",".join(lacks)] if lacks else [])


def test_net_grants(spark, rows):
    log = spark.createDataFrame([
        ("TABLE", "c", "s", 1, "g", "SELECT", "GRANT", 1, 1), ("TABLE", "c", "s", 1, "g", "SELECT", "REVOKE", 2, 2),
        ("TABLE", "c", "s", 1, "h", "SELECT", "REVOKE", 1, 3), ("TABLE", "c", "s", 1, "h", "SELECT", "GRANT", 1, 4),
        ("CATALOG", "c", None, None, "g", "USE CATALOG", "GRANT", 1, 5),
    ], "securable_type string, catalog string, schema string, object int, grantee string, privilege string, "
       "action string, changed_on int, seq int")
    assert rows(access.net_grants(log), "grantee", "privilege") == [("g", "USE CATALOG"), ("h", "SELECT")]


def test_access_wants_net_grants(spark):
    grants, memberships, objects, owners = _frames(spark, _world(5))
    log = grants.withColumn("action", F.lit("REVOKE"))
    for call in (lambda: access.effective_access(log, memberships, objects), lambda: access.access_audit(log, ["s1"])):
        with pytest.raises(ValueError):
            call()


def test_gaps_do_not_make_all_pairs_of_classes(spark, monkeypatch):
    """Everybody is in one big group and one of their own; only what is asked for is looked up."""
    n, sizes = 60, {}
    members = spark.createDataFrame([("all", f"p{i}") for i in range(n)] + [(f"g{i}", f"p{i}") for i in range(n)], "grp string, principal string")
    objects = spark.createDataFrame([("c", "s", i) for i in range(n)], "catalog string, schema string, object int")
    grants = spark.createDataFrame(
        [("TABLE", "c", "s", i, g, "SELECT") for i in range(n) for g in ("all", f"g{i}")] + [("CATALOG", "c", None, None, "all", "USE CATALOG")],
        "securable_type string, catalog string, schema string, object int, grantee string, privilege string")
    real = access.stage

    def counting(df, label):
        out = real(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(access, "stage", counting)
    monkeypatch.setattr(access, "stage_all", lambda dfs: {k: counting(v, k) for k, v in dfs.items()})
    asked = spark.createDataFrame([("p0", "c", "s", 1), ("p1", "c", "s", 1)], "principal string, catalog string, schema string, object int")
    assert {r.missing for r in access.access_gaps(asked, grants, members, objects).collect()} == {"USE SCHEMA"}
    assert max(sizes.values()) <= 2 * n + 1


def test_hot_key_results(spark):
    """A third of all rows under one key."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    last = integrity.dedup_latest(df, ["k"], [F.col("v").desc()])
    assert last.count() == 20_001 and last.filter("k = 0").first().v == 29_997
    parents = spark.range(1, 30_000).withColumnRenamed("id", "p")
    orphans = integrity.fk_violations(df, parents, {"k": "p"})
    assert orphans.count() == 10_000
    changed = df.withColumn("v", F.when(F.col("k") == 0, F.col("v") + 1).otherwise(F.col("v")))
    diff = versions.version_diff(df, changed, ["k"]).collect()
    assert [(r.k, r.change, r.rows_removed, r.rows_added) for r in diff] == [(0, "update", 10_000, 10_000)]
