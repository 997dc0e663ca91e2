"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlink.plans.durable import durable


def connected_components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of longs, (node, component): the smallest node reachable, for every node of an edge.

    Each step replaces edges by ones to smaller nodes of the same component, until all point to its smallest. The number
    of steps grows with the logarithm of the longest path. Edges are deduplicated before every shuffle of pairs; a node
    with many neighbours is joined with one row, its smallest neighbour, so that a skewed join can be split.
    """
    edges = durable(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    while True:
        # Large star: every neighbour of u that is larger than u gets the smallest of u's neighbours and u.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = durable(large.filter("a <> b").distinct())
        # Small star: u and its smaller neighbours get the smallest of them.
        least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = edges.join(least, F.col("a") == F.col("u")).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = durable(small.filter("a <> b").distinct())
        state = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).head()
        if state == last:
            break
        last = state
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
