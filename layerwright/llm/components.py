"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.session import materialize


def connected(edges: DataFrame) -> DataFrame:
    """``node, component`` from ``a, b``: the smallest node that each node of an edge is connected with.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every step hangs neighbours on the smallest of
    them, as a minimum per node and a join, so that no node's neighbours meet in one task; a chain of n nodes takes about log n rounds. Each round
    is a written table. Ends when a round changes nothing.
    """
    pairs = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = pairs.union(pairs.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Large star: each neighbour larger than the node hangs on the smallest of node and neighbours.
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.filter("a <> b").distinct(), "large-star")
        # Small star: each neighbour smaller than the node, and the node, hang on the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        pairs = materialize(small.filter("a <> b").distinct(), "small-star")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
