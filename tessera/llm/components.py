"""Connected components by alternating large and small stars, in joins that adaptive execution can split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, stored


def components(edges: DataFrame, name: str) -> DataFrame:
    """edges (u, v) -> node, root: the smallest node of its component, for every node but the roots themselves.

    Each round's edges are written to the shared folder. A star's centre may have any number of edges: minima are
    pre-aggregated, and the joins are between stored tables.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-least")
        large = stored(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), f"{name}-large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        old, now = now, stored(small.where("u <> v").distinct(), f"{name}-small")
        discard(old, least, large, low)
