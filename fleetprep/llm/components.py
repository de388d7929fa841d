"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetprep.cluster import stage


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node that can be reached) for every node in links (a, b).

    Alternating stars: each node hangs its larger, then its smaller neighbours on its smallest one, until all hang on their root. All
    steps are joins and minima with map-side combine; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = stage(edges), None
    while True:
        # edges hold each link once, the larger node first; equal counts and sums of hashes: nothing has changed
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct())
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(own)
