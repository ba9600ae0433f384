"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its least node.

    Each round links the greater neighbours of every node to its least neighbour, then the smaller
    ones; rounds end when the stars stand, after about log(longest path) rounds.  Least neighbours come
    from a grouped minimum and a join, so no node's neighbours are gathered in one place."""
    e = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        # stars: every node hangs on one centre, or is one
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
            e.select(F.col("v").alias("x"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
        ends = ends.groupBy("x").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
        if ends.filter("hangs + holds > 1").isEmpty():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small_low.select("u", F.col("m").alias("v"))).distinct()
        e = cut_lineage(small, "edges")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))
