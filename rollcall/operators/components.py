"""Connected components by alternating large-star and small-star contraction of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.storage import materialise


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node it reaches) for every node of edges (u, v) but the roots.

    Each step sends every neighbour of a node to the smallest one; node degrees never meet in one row, and
    each step is written to the shared folder. The number of steps grows with the logarithm of the longest path.
    """
    now = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = materialise(small.select("e.u", "e.v").where("u <> v").distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
