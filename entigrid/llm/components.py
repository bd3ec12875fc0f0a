"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a few aggregations and joins; no step gathers a component in one task, and each
result is written to the shared folder, so a lost executor costs one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from entigrid.llm.common import BROADCAST_ROWS, stored

EDGES_IN_FILE = 50_000


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    joined = both.join(F.broadcast(least) if few else least, both["a"] == least["u"]).filter("b > a AND b != m")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    others = down.join(F.broadcast(least) if few else least, down["a"] == least["u"]).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node each node of ``edges(a, b)`` is connected with.

    Nodes without an edge to another node have no row. Loops and repeated edges change nothing.
    """
    edges = stored(edges.filter("a != b").select("a", "b").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        # each step has at most twice as many rows as there are edges, which were counted
        few, parts = 2 * mark[0] <= BROADCAST_ROWS, 1 + mark[0] // EDGES_IN_FILE
        edges = _small_star(_large_star(edges, few), few).distinct()
        edges = stored(edges.coalesce(parts) if few else edges, "edges")
        if (now := _mark(edges)) == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
