"""Distributed connected components by alternating star contractions.

Large-star hangs the larger neighbours of every node on its smallest
neighbour; small-star hangs a node and its smaller neighbours on the smallest
of them. Both keep connectivity, and they end in stars around the smallest
node of each component after O(log^2 n) rounds. Every round is a grouped
minimum (partial aggregation, so a hub is one row per task) and a join with
the staged minima, which adaptive execution splits at hot keys. Edges never
reach the driver; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import hinted, stage


def _star(pairs: DataFrame, low: DataFrame, name: str) -> DataFrame:
    """Join (u, v) pairs with the staged minimum m of each u."""
    return pairs.join(hinted(stage(low, name)), "u")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its
    smallest node. Self loops and repeated edges are fine, null ends are
    ignored, an empty table gives an empty result."""
    kind = dict(edges.dtypes)[src]
    edge = edges.select(F.col(src).alias("a"), F.col(dst).cast(kind).alias("b")).filter("a is not null and b is not null")
    current = stage(edge.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    loops = current.filter("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    current = current.filter("u > v")
    state = None
    for _ in range(max_rounds):
        # large-star: neighbours larger than u go to the smallest of u and its neighbours
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _star(both, low, "cc-low").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "cc-large")
        # small-star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(large, low, "cc-low").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        current = stage(small.filter("u > v").distinct(), "cc-small")
        now = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"no convergence in {max_rounds} rounds")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").unionByName(loops).distinct()
    return stars.unionByName(roots.join(stars.select("node"), "node", "left_anti"))
