"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.sources.scratch import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); a component is named by its smallest node.

    Each round hangs every node under the smallest neighbour known and then replaces an edge to a
    node by one to that node's parent, so distances to the root shrink by half or better. Nothing
    is gathered on the driver but a count, and each round's edges are a written table.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    current = stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        # Large star: neighbours above a node go under its smallest neighbour.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Stored first, so that the join below can split the rows of a root that much hangs on.
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        least = stored(least, "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = stored(large, "edges")
        # Small star: a node and its lower neighbours go under the smallest of them.
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")), "least")
        joined = large.join(low, "a")
        small = joined.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        after = stored(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "edges")
        counts = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        new = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        discard(least, large, low)
        if counts == new:
            discard(after)
            break
        discard(current)
        current = after
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return roots.unionByName(current.select(F.col("a").alias("node"), F.col("b").alias("component")))
