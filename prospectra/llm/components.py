"""Connected components of an edge table by randomised contraction.

Each round every node takes the smallest hash among itself and its
neighbours as its parent, and edges move to the parents; loops and repeats
go. A round shrinks chains and stars alike by a constant factor in
expectation, so rounds grow with the logarithm of the longest chain. All
steps are grouped or joined by node; nothing but a row count reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for each node of edges (a, b)."""
    live = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nodes = materialize(both(live).select(F.col("a").alias("node"), F.col("a").alias("at")).distinct(), "nodes")
    turn = 0
    while not live.isEmpty():
        rank = lambda c, seed=turn: F.struct(F.xxhash64(c, F.lit(seed)).alias("h"), F.col(c).alias("v"))
        near = both(live).groupBy("a").agg(F.min(rank("b")).alias("near"))
        parents = materialize(near.select(F.col("a").alias("child"), F.least(F.col("near"), rank("a")).v.alias("parent")), "parents")
        up = lambda e, c, p=parents: e.join(p.withColumnRenamed("child", c), c).drop(c).withColumnRenamed("parent", c)
        moved_edges = up(up(live, "a"), "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        moved_nodes = nodes.join(parents.withColumnRenamed("child", "at"), "at", "left").select("node", F.coalesce("parent", "at").alias("at"))
        done = (live, nodes, parents)
        live, nodes = materialize(moved_edges.distinct(), "edges"), materialize(moved_nodes, "nodes")
        release(*done)
        turn += 1
    least = nodes.groupBy("at").agg(F.min("node").alias("component"))
    return nodes.join(least, "at").select("node", "component")
