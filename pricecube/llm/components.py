"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node tells its larger neighbours the smallest one it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.where("v > u").join(_smallest(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node tells its smaller neighbours, and itself, the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = _smallest(down)
    told = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return told.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of (u, v) edges; the component is its
    smallest node.  Alternates large and small stars, which take a number of
    rounds that grows with the square of the logarithm of the nodes at most, and
    never gathers a node's neighbours in one place."""
    edges = written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    state = None
    while True:
        edges = written(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
