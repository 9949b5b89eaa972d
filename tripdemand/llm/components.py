"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.stored import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of the edges; component is the smallest node reached.

    Each round links every node's larger neighbours to its smallest neighbour, then its
    smaller neighbours to the smallest, until nothing changes (a number of rounds that grows
    with the logarithm of the nodes). Rounds are aggregates and joins over the edges; the
    smallest neighbour is found by a map-side minimum, so a node with very many edges
    is no single task's work. Null nodes and loops are dropped, repeated edges count once.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = stored(pairs)
    before = None
    while True:
        # both directions: every neighbour of u, and the smallest of them and u
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hops = large.join(small, "u").select("u", "v", "m")
        pairs = stored(hops.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
