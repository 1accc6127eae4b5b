"""Connected components by alternating large-star and small-star.

Each star is a minimum per node (summed up before its shuffle) and a join of the
edges with it, which adaptive execution splits where a node has very many edges.
No neighbour list is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm import common


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest one, or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").filter("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node` and `component`, its smallest reachable node, for all linked nodes.

    Links are undirected, may repeat and may join a node with itself; those with
    a NULL end are ignored.
    """
    edges = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges, seen = common.settle(edges.distinct()), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        edges = common.settle(_small_star(_large_star(edges)))
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
