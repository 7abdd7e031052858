"""Connected components of an edge table, by large-star and small-star rounds.

Each round links nodes to the smallest neighbour they know; the number of rounds grows with the
logarithm of the longest path. Minima are pre-aggregated before each shuffle; the joins back to the
edges are plain equi-joins that adaptive execution can split at a node with many edges. Each round
is written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v. Large: neighbours above u go to u's minimum; small: u and those below it do."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        below = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = below.union(least.select("u", F.col("m").alias("v")))
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node reachable. Nodes must not be null."""
    found = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    found = stored(found, "edges")
    before = None
    while True:
        state = found.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before or state[0] == 0:
            break
        before = state
        found = stored(_star(_star(found, True), False), "edges")
    return found.select(F.col("u").alias("node"), F.col("v").alias("component")).union(found.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
