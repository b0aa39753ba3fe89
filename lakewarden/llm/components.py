"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b), both bigint; the component is its smallest node. Read from a written table.

    A large star links each node's larger neighbours to its smallest one, a small star the smaller ones. The
    smallest neighbours are reduced per task before the shuffle and written, so that the join with a node of
    very many edges is split among tasks. Ends when the edges are stars around smallest nodes: each node has then either
    one smaller neighbour or larger ones only. Nodes for which that does not hold are marked as the smallest neighbours are
    written, so the driver asks one small table whether any is left.
    """
    now = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    smaller, larger = F.count_if(F.col("b") < F.col("a")), F.count_if(F.col("b") > F.col("a"))
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(
            F.least(F.min("b"), F.col("a")).alias("m"), ((smaller > 1) | ((smaller > 0) & (larger > 0))).alias("open")), "least")
        if least.filter("open").isEmpty():
            return least.select(F.col("a").alias("node"), F.col("m").alias("component"))
        large = stage(both.join(least.drop("open"), "a").filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "large")
        lowest = stage(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        now = stage(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "small")
