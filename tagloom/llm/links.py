"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import discard, saved


def components(links: DataFrame) -> DataFrame:
    """``node, label``: for every node of a link its component's smallest node.

    Each round hangs every node's neighbours on the smallest of them: larger neighbours first, then
    smaller ones, so paths shrink geometrically and no node ever gathers its neighbours in one row.
    Loops are ignored, and repeated links count once; no links give an empty table.
    """
    edges = saved(
        links.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).filter("a <> b").distinct(),
        "edges",
    )
    while not _stars(edges):
        # Large star: the larger neighbours of a node, with the smallest of its neighbours and itself.
        both = edges.union(edges.select("b", "a"))
        least = anew(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "a")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: the smaller neighbours of a node, and itself, with the smallest of them.
        smallest = anew(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        pair = F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("pair")
        small = large.join(smallest, "a").select(pair).select(F.col("pair.b").alias("a"), F.col("pair.m").alias("b"))
        after = saved(small.filter("a <> b").distinct(), "edges")
        discard(edges)
        edges = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select("b", "b").distinct())


def anew(sums: DataFrame, key: str) -> DataFrame:
    """``sums`` by the long ``key``, dealt out anew for a join by it: AQE splits a hot key only between two exchanges."""
    return sums.withColumn(key, F.col(key).bitwiseXOR(F.lit(0)))


def _stars(edges: DataFrame) -> bool:
    """Whether each larger node ``a`` has one ``b``, which is no larger node itself: nothing is left to join then."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root")).filter("up > 1 or up + root > 1").count() == 0
