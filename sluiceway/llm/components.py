"""Connected components of a graph that is a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("least")).select("src", F.least("src", "least").alias("least"))
    return both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    least = edges.groupBy("src").agg(F.min("dst").alias("least"))
    moved = edges.join(least, "src").where("dst <> least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    return moved.unionByName(least.withColumnRenamed("least", "dst"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (src, dst: long) to (node, component), component being the least node that is reachable.

    Large-star and small-star rounds until nothing changes, a number that grows with the logarithm of the
    longest chain. Nodes without an edge to another node are left out; null ends are no edges. Each round
    is written to the work folder, so a lost executor costs one round at most.
    """
    edges = edges.select("src", "dst").where("src <> dst")
    edges = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    edges = saved(edges, "edges")
    state = _state(edges)
    while True:
        edges = saved(_small_star(_large_star(edges)).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
                edges.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            )
