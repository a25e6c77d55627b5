"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_counted, materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node with an edge to another; ``edges`` has longs ``a`` and ``b``.

    Each round is written to the shared folder, so lineage stays short, and the
    round before is deleted; rounds grow with the logarithm of the longest chain.
    """
    now = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark, total = None, now.count()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
        large = join_counted(both, least, ["u"], total).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_counted(large, least, ["u"], total).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, now = now, materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(before)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark, total = seen, seen[0]
