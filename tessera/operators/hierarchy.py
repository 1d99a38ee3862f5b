"""Hierarchies of any depth: root, depth and largest ancestor of every node, by doubling steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ancestors(nodes: DataFrame, key: str, parent: str, size: str, folder: str) -> DataFrame:
    """key, root, depth, largest (the largest size of its ancestors) and cyclic of each node; one row out per row in.

    A node without a parent, or whose parent is no node, is a root: its own root, at depth 0, without a largest. Nodes of a
    circle, and those that lead into one, are cyclic and have no root, depth or largest. Keys are unique; a null key's row is
    left out. In each round a node's pointer goes on by what the node that it points to knows, so chains of a length d take
    log2(d) rounds, and a node that still points somewhere after log2(n) + 1 rounds leads into a circle. Rounds are written below
    `folder`, which all executors share; a node that many point to is joined from stored tables, which adaptive execution splits."""
    spark = nodes.sparkSession
    base = nodes.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(parent).alias("p"), F.col(size).alias("s"))
    up = base.select(F.col("k").alias("p"), F.col("s").alias("_ps"), F.lit(True).alias("_is"))
    start = base.join(up, "p", "left").select("k", F.when(F.col("_is"), F.col("p")).alias("up"), F.when(F.col("_is"), F.col("p")).otherwise(F.col("k")).alias("top"), F.when(F.col("_is"), 1).otherwise(0).cast("long").alias("steps"), F.when(F.col("_is"), F.col("_ps")).alias("big"))

    def stored(df: DataFrame, number: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/round={number}")
        return spark.read.schema(df.schema).parquet(f"{folder}/round={number}")

    now = stored(start, 0)
    rounds = max(now.count(), 1).bit_length() + 1
    for number in range(1, rounds + 1):
        if now.where("up IS NOT NULL").isEmpty():
            break
        ahead = now.select(F.col("k").alias("up"), F.col("up").alias("_up"), F.col("top").alias("_top"), F.col("steps").alias("_steps"), F.col("big").alias("_big"))
        moved = now.where("up IS NOT NULL").join(ahead, "up").select("k", F.col("_up").alias("up"), F.col("_top").alias("top"), F.least(F.col("steps") + F.col("_steps"), F.lit(1 << 40)).alias("steps"), F.greatest("big", "_big").alias("big"))
        now = stored(now.where("up IS NULL").unionByName(moved), number)
    ends = F.col("up").isNull()
    return now.select(F.col("k").alias(key), F.when(ends, F.col("top")).alias("root"), F.when(ends, F.col("steps")).alias("depth"), F.when(ends, F.col("big")).alias("largest"), (~ends).alias("cyclic"))
