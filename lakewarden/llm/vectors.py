"""Exact near-duplicate vectors by a dual traversal of cover trees.

Each label's vectors are dealt to cells around centres from a bounded sample, the upper level of the tree. A vector
visits another cell only if the cell's covering radius and the plane between the centres leave room for a
partner. Within a cell a tree of nested nets with halving radii is built, and pairs of nodes are walked down
together: a pair is dropped if the covering radii keep its members apart, taken as a whole if they keep all of
them within the threshold, and otherwise split. Whole pairs add to counts and join classes without being listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import pick
from lakewarden.llm.components import components
from lakewarden.session import stage

SIMILARITY = 0.98
CELL_ROWS = 2048
# The upper level never has more centres than this, so it can be sent to every task.
MOST_CENTRES = 16_384
LEAF_ROWS = 24
# Bounds closer to the threshold than this are settled by the cosine itself.
SLACK = 1e-7
# Rows that meet all centres at once, and room for the rounding of distances between centres kept in single precision.
ROUTED_ROWS = 256
GAP_SLACK = 1e-5


def gaps(c: np.ndarray) -> np.ndarray:
    """Distances between centres, in single precision, made for ``ROUTED_ROWS`` of them at a time."""
    out = np.empty((len(c), len(c)), np.float32)
    for at in range(0, len(c), ROUTED_ROWS):
        out[at:at + ROUTED_ROWS] = np.sqrt(np.maximum(0.0, 2 - 2 * c[at:at + ROUTED_ROWS] @ c.T))
    return out


@dataclass
class Node:
    """A net point with its covering radius; ``members`` are rows, ``children`` the net of half the radius."""

    centre: int
    radius: float
    members: np.ndarray
    children: list["Node"] | None = None


def build_tree(x: np.ndarray, members: np.ndarray, centre: int | None = None) -> Node:
    """The cover tree of some rows of unit vectors; every child holds the rows nearest to be within its radius."""
    centre = int(members[0]) if centre is None else centre
    away = np.sqrt(np.maximum(0.0, 2 - 2 * x[members] @ x[centre]))
    node = Node(centre, float(away.max()), members)
    if len(members) <= LEAF_ROWS or node.radius < SLACK:
        return node
    half, rest = node.radius / 2, members
    node.children, point = [], centre
    while len(rest):
        near = x[rest] @ x[point] >= 1 - half * half / 2
        near |= rest == point
        node.children.append(build_tree(x, rest[near], point))
        rest = rest[~near]
        if len(rest):
            point = int(rest[0])
    return node


class PairWalk:
    """Links between the members of node pairs: counts per row, and the class of each row."""

    def __init__(self, x: np.ndarray, weight: np.ndarray, similarity: float):
        self.x, self.weight, self.similarity = x, weight, similarity
        self.reach = float(np.sqrt(max(0.0, 2 - 2 * similarity)))
        self.links = np.zeros(len(x), np.int64)
        self.label = np.arange(len(x))

    def merge(self, rows: np.ndarray) -> None:
        """These rows are in one class, whose label is its smallest row."""
        labels = np.unique(self.label[rows])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]

    def _hits(self, a: np.ndarray, b: np.ndarray, hit: np.ndarray, mirrored: bool) -> None:
        """Links between rows ``a`` and ``b`` where ``hit``; ``mirrored`` if the matrix has each pair twice."""
        self.links[a] += hit @ self.weight[b]
        if not mirrored:
            self.links[b] += self.weight[a] @ hit
        for i in np.flatnonzero(hit.any(axis=1)):
            self.merge(np.append(b[hit[i]], a[i]))

    def _rows(self, a: np.ndarray, b: np.ndarray) -> None:
        """Members against members, by the cosine itself."""
        same = a is b
        for lo in range(0, len(a), 512):
            part = a[lo:lo + 512]
            hit = self.x[part] @ self.x[b].T >= self.similarity
            if same:
                hit[np.arange(len(part)), lo + np.arange(len(part))] = False
            if hit.any():
                self._hits(part, b, hit, same)

    def _whole(self, a: np.ndarray, b: np.ndarray) -> None:
        """All members of one node are linked with all of the other."""
        self.links[a] += self.weight[b].sum()
        self.links[b] += self.weight[a].sum()
        self.merge(np.concatenate([a, b]))

    def within(self, node: Node) -> None:
        todo = [node]
        while todo:
            node = todo.pop()
            if 2 * node.radius < self.reach - SLACK and len(node.members) > 1:
                self.links[node.members] += self.weight[node.members].sum() - self.weight[node.members]
                self.merge(node.members)
            elif node.children is None:
                self._rows(node.members, node.members)
            else:
                todo += [c for c in node.children if len(c.members) > 1]
                self._level(node.children, node.children, True)

    def between(self, a: Node, b: Node) -> None:
        self._level([a], [b], False)

    def _level(self, a: list[Node], b: list[Node], same: bool) -> None:
        """Pairs of two lists of nodes (of one list: each pair once), then the pairs below them."""
        todo = [(a, b, same)]
        while todo:
            a, b, same = todo.pop()
            ra, rb = np.array([n.radius for n in a]), np.array([n.radius for n in b])
            ca, cb = np.array([n.centre for n in a]), np.array([n.centre for n in b])
            one_a, one_b = (np.array([len(n.members) == 1 for n in nodes]) for nodes in (a, b))
            for lo in range(0, len(a), 512):
                cosine = self.x[ca[lo:lo + 512]] @ self.x[cb].T
                away = np.sqrt(np.maximum(0.0, 2 - 2 * cosine))
                open_ = away - ra[lo:lo + 512, None] - rb[None, :] <= self.reach + SLACK
                if same:
                    open_ &= np.arange(len(b))[None, :] > lo + np.arange(len(open_))[:, None]
                # Nodes of a single member are settled here, by the cosine itself.
                single = open_ & one_a[lo:lo + 512, None] & one_b[None, :]
                hit = single & (cosine >= self.similarity)
                if hit.any():
                    self._hits(ca[lo:lo + 512], cb, hit, False)
                for i, j in np.argwhere(open_ & ~single):
                    p, q = a[lo + i], b[j]
                    if away[i, j] + p.radius + q.radius < self.reach - SLACK:
                        self._whole(p.members, q.members)
                    elif p.children is None and q.children is None:
                        self._rows(p.members, q.members)
                    elif q.children is None or (p.children is not None and p.radius >= q.radius):
                        todo.append((p.children, [q], False))
                    else:
                        todo.append(([p], q.children, False))


_LINKS = "node long, links long, root long"


def _walk_task(similarity: float):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """One task of a cell: chunk ``i`` against chunk ``j``; visitors are not compared with each other."""
        group = group.sort_values("node", kind="stable").reset_index(drop=True)
        x = np.stack(group["vec"].to_numpy())
        chunk, home = group["chunk"].to_numpy(), group["home"].to_numpy()
        walk = PairWalk(x, group["n"].to_numpy(), similarity)
        i, j = key[2], key[3]
        trees = {}
        for c in {i, j}:
            for h in (True, False):
                rows = np.flatnonzero((chunk == c) & (home == h))
                if len(rows):
                    trees[c, h] = build_tree(x, rows)
        if i == j:
            if (i, True) in trees:
                walk.within(trees[i, True])
            pairs = [((i, True), (i, False))]
        else:
            pairs = [((i, True), (j, True)), ((i, True), (j, False)), ((i, False), (j, True))]
        for a, b in pairs:
            if a in trees and b in trees:
                walk.between(trees[a], trees[b])
        linked = np.flatnonzero(walk.links)
        ids = group["node"].to_numpy()
        return pd.DataFrame({"node": ids[linked], "links": walk.links[linked], "root": ids[walk.label[linked]]})

    return run


def _router(shared, visits: bool):
    """Home cells, or with ``visits`` the other cells that may hold a partner, with lower numbers than the home.

    Rows meet the centres ``ROUTED_ROWS`` at a time, so a task holds that many distances for each centre, and the
    distances between the centres of a part are made once per task and as single-precision bounds.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, reach = shared.value["centres"], shared.value["reach"]
        between: dict[str, np.ndarray] = {}

        def route(p: str, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool, np.ndarray]]:
            """(place in x, cell, home, distance) of homes, then of visits."""
            c, radius = centres[p]
            d2 = np.maximum(0.0, 2 - 2 * x @ c.T)
            near, every = d2.argmin(axis=1), np.arange(len(x))
            best = d2[every, near]
            yield every, near, True, np.sqrt(best)
            if not visits or len(c) == 1:
                return
            if p not in between:
                between[p] = gaps(c)
            gap = (d2 - best[:, None]) / np.maximum(2 * between[p][near], SLACK)
            go = (np.sqrt(d2) <= radius[None, :] + reach + SLACK) & (gap <= reach + GAP_SLACK)
            go &= np.arange(len(c))[None, :] < near[:, None]
            i, k = np.nonzero(go)
            yield i, k, False, np.sqrt(d2[i, k])

        for batch in batches:
            names = batch.schema.names
            rows, cells, home, away = [], [], [], []
            by_part: dict[str, list[int]] = {}
            for i, p in enumerate(batch.column(names.index("part")).to_pylist()):
                by_part.setdefault(p, []).append(i)
            vec = batch.column(names.index("vec"))
            for p, own in by_part.items():
                for at in range(0, len(own), ROUTED_ROWS):
                    some = np.array(own[at:at + ROUTED_ROWS])
                    if p not in centres:
                        found = [(np.arange(len(some)), np.zeros(len(some), int), True, np.full(len(some), 2.0))]
                    else:
                        found = route(p, np.array(vec.take(pa.array(some)).to_pylist()))
                    for i, k, at_home, d in found:
                        rows.append(some[i])
                        cells.append(k)
                        home.append(np.full(len(i), at_home))
                        away.append(d)
            place = pa.array(np.concatenate(rows) if rows else [], pa.int64())
            kept = [batch.column(i).take(place) for i in range(batch.num_columns)]
            added = [pa.array(np.concatenate(v) if v else [], t) for v, t in (
                (cells, pa.int64()), (home, pa.bool_()), (away, pa.float64()))]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=[*names, "cell", "home", "away"])

    return run


def link_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 similarity: float = SIMILARITY, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``df``.

    Only vectors of one label and one length are compared, by cosine in double precision. Vectors that are NULL,
    empty, zero or hold NULL or non-finite components, and those without a label, link with nothing and are
    their own component. Equal vectors are one node and count as links of each other. Rows without an id
    take part; a component's id is the smallest id in it. Repeated rows are vectors of their own. An empty
    table gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    picked = pick(df, vec_id=id_col, raw=vector_col, label=label_col)
    vec = F.col("raw").cast("array<double>")
    finite = F.size(vec) > 0
    finite &= F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    finite &= F.exists(vec, lambda v: v != 0) & F.col("label").isNotNull()
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    rows = stage(picked.select(F.monotonically_increasing_id().alias("rid"), "vec_id", F.when(finite, F.concat_ws(
        "/", F.col("label").cast("string"), F.size(vec).cast("string"))).alias("part"), F.when(finite, vec).alias("vec")), "vectors")
    usable = rows.filter("part is not null")
    nodes = stage(usable.groupBy("part", "vec").agg(F.min("rid").alias("node"), F.count(F.lit(1)).alias("n")).select(
        "part", F.col("vec").alias("raw"), "node", "n").withColumn("_top", F.array_max(F.transform("raw", lambda v: F.abs(v))))
        .withColumn("_s", F.transform("raw", lambda v: v / F.col("_top")))
        .withColumn("_norm", F.sqrt(F.aggregate("_s", F.lit(0.0), lambda a, v: a + v * v)))
        .select("part", "raw", "node", "n", F.transform("_s", lambda v: v / F.col("_norm")).alias("vec")), "nodes")
    total = nodes.count()
    light = nodes.select("part", "node", "n", "vec")

    # The upper level: a sample of bounded size by hash, so a part gets centres in proportion to its rows.
    wanted = min(MOST_CENTRES, total // cell_rows)
    sample = light.select("part", "vec", F.xxhash64("node").alias("_h")).orderBy("_h").limit(wanted).collect() if wanted else []
    by_part: dict[str, list] = {}
    for r in sample:
        by_part.setdefault(r["part"], []).append(r["vec"])
    reach = float(np.sqrt(max(0.0, 2 - 2 * similarity)))

    def thinned(vectors: list) -> np.ndarray:
        """Centres that are not within reach of one another."""
        x, kept = np.array(vectors), []
        for i in range(len(x)):
            if not kept or (x[kept] @ x[i]).max() < similarity:
                kept.append(i)
        return x[kept]

    nets = {p: thinned(v) for p, v in by_part.items()}
    schema = "part string, node long, n long, vec array<double>, cell long, home boolean, away double"
    shared = spark.sparkContext.broadcast({"reach": reach, "centres": {p: (c, np.full(len(c), 2.0)) for p, c in nets.items()}})
    routed = light.mapInArrow(_router(shared, False), schema)
    radii = {p: np.full(len(c), -1.0) for p, c in nets.items()}
    # At most one row per centre.
    for r in routed.filter(F.col("part").isin(list(nets))).groupBy("part", "cell").agg(F.max("away").alias("r")).collect() if nets else []:
        radii[r["part"]][r["cell"]] = r["r"]
    shared.destroy()
    shared = spark.sparkContext.broadcast({"reach": reach, "centres": {p: (c, radii[p]) for p, c in nets.items()}})
    visited = stage(light.mapInArrow(_router(shared, True), schema).drop("away"), "cells")
    shared.destroy()

    # A cell beyond the size is cut into chunks, and its tasks are the pairs of chunks.
    cut = stage(visited.groupBy("part", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * cell_rows)).cast("int").alias("chunks")), "cuts")
    chunked = visited.join(cut, ["part", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tasks = chunked.withColumn("_o", other).withColumn("_i", F.least("chunk", "_o")).withColumn("_j", F.greatest("chunk", "_o"))
    links = stage(tasks.select("part", "cell", "_i", "_j", "chunk", "home", "node", "n", "vec").groupBy(
        "part", "cell", "_i", "_j").applyInPandas(_walk_task(similarity), _LINKS), "links")
    counts = stage(links.groupBy("node").agg(F.sum("links").alias("links")), "counts")
    found = stage(components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))), "classes")

    facts = stage(nodes.select("part", "raw", "node", "n").join(counts, "node", "left").join(found, "node", "left").select(
        "part", "raw", "node", F.coalesce("component", "node").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "facts")
    placed = stage(usable.join(facts.withColumnRenamed("raw", "vec"), ["part", "vec"]).select(
        "rid", "vec_id", "component", "n_links"), "placed")
    smallest = stage(placed.groupBy("component").agg(F.min("vec_id").alias("component_id")), "smallest")
    linked = placed.join(smallest, "component").select("vec_id", "n_links", "component_id")
    alone = rows.filter("part is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
