"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (long columns a, b).

    ``component`` is the smallest node reachable. Each round, every node ties
    its larger neighbours and then its smaller ones to the least node around
    it; a star's hub is replaced by minima that are combined before the
    shuffle, and rounds grow with the logarithm of the longest path. Edges
    stay in Spark: the driver only sees whether a round changed anything.
    """
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: larger neighbours go to the least node around u
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        # small star: u and its smaller neighbours go to the least of these
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(down.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        after = stage(small, "edges")
        # done when every edge is a tie to a root that is no other edge's lower end
        changed = after.exceptAll(e).limit(1).count() + e.exceptAll(after).limit(1).count()
        e = after
        if not changed:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
