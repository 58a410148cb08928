"""Connected components of an edge table by alternating large and small stars.

Each round is two grouped minima and two equi-joins, so its shuffles follow the
number of edges. A hub's edges are never gathered in one task: minima combine on
the map side, and the joins are plain shuffle joins, whose skewed partitions
adaptive execution splits.
"""

from pyspark.sql import DataFrame, functions as F

from heddle.plans.durable import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = both.groupBy("src").agg(F.min("dst").alias("low"))
    low = low.select("src", F.least("src", "low").alias("low"))
    return both.join(low, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("src").agg(F.min("dst").alias("low"))
    moved = edges.join(low, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(low.select("src", F.col("low").alias("dst"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges(src, dst)`` of longs, undirected → ``(node, component)``.

    The component is the smallest node reachable. Nodes without an edge to
    another node are not returned, nor are edges with a null end; self-loops and
    repeated edges change nothing. Each round's edges are a durable table.
    """
    current = scratch.keep(
        edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges"
    )
    seen = None
    while True:
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst") % 1_000_000_007).alias("h")).first()
        if state == seen or not state.n:
            return current.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
                current.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            )
        seen = state
        following = scratch.keep(_small_star(_large_star(current)), "edges")
        scratch.drop(current)
        current = following
