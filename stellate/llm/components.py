"""Connected components of an undirected graph given as distinct (u, v) rows.

Alternating large-star and small-star steps: each is one aggregation for the
smallest neighbour and one join, so a node with many neighbours is never
gathered; every step is written to the shared checkpoint folder.  Ends when a
round changes no edge: each node then points at the smallest of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the neighbours of each node (larger ones, or smaller ones and itself) at its smallest neighbour."""
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; ``root`` is the smallest node reachable."""
    edges = materialize(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        edges = materialize(_star(_star(edges, True), False), "star")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
