"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.durable import durable


def components(links: DataFrame, one: str = "a", two: str = "b") -> DataFrame:
    """``node, component`` of every node that a link names; the component is its least node.

    Each round links all larger neighbours of a node to the least one, then all smaller ones, until every node
    hangs on its component's least. Rounds are aggregations and joins: a node with very many links is
    pre-aggregated, and rounds grow with the logarithm of the longest path. Each round is written to the
    shared folder. Links of a node to itself, repeated and null links are ignored.
    """
    edges = links.select(F.greatest(one, two).alias("u"), F.least(one, two).alias("v")).where("u <> v").distinct()
    edges = durable(edges, "links")
    sums = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # u > v now; the smaller neighbours of u and u itself go to the least of them.
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(
            F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        )
        edges = durable(small.where("u <> v").distinct(), "links")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == sums:
            break
        sums = state
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.unionByName(roots)
