"""Connected components of a graph that is as large as the data.

Alternating stars (Kiveris et al., 2014): a large star points every larger neighbour of a
node to the smallest node around it, a small star points the node and its smaller
neighbours there. Both are a grouped minimum and a join; no node's neighbours ever meet in
one row, and a table is written after every round. Edges leave in pairs (node, smallest).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.tables import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round over edges (u, v) with u > v."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = around.join(least, "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    moved = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved).filter("u > v").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Number and sum of hashes of the edges: equal when a round changed nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and root, its component's smallest node, for every node of an edge but the roots.

    ``edges`` has columns a and b; loops and nulls are ignored.
    """
    clean = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = store(clean.distinct())
    before = _mark(now)
    while before[0]:
        now = store(_star(_star(now, True), False))
        after = _mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
