"""Duplicate measurements: candidates, ranked survivors, first of an id, entities created in one batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: ranks of sources; others rank 0
SOURCE_RANK = {"table": 4, "supplementary": 3, "text": 2, "figure": 1}


def source_rank(c: str) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in SOURCE_RANK.items() for x in kv])[F.col(c)], F.lit(0))


def measurement_keys() -> list[Column]:
    """A measurement's duplicate key; derived ones leave out concentration and matrix."""
    derived = F.coalesce(F.col("value_type") == "derived_param", F.lit(False))
    return [
        derived,
        F.col("substance"),
        F.when(~derived, F.col("concentration")),
        F.when(~derived, F.col("base_matrix")),
        F.coalesce("attribute_normalized", "attribute"),
        F.col("experiment"),
    ]


def duplicate_pairs(df: DataFrame, keys: list[Column | str], order: str) -> DataFrame:
    """df's later rows of each key with first_<order>, that of the key's first row; NULL keys are equal."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(f"first_{order}", F.first(order).over(w)).where(F.col(order) != F.col(f"first_{order}"))


def survivors(df: DataFrame, keys: list[Column | str], order: str, rank: Column, mode: str = "pairwise") -> DataFrame:
    """What is left of duplicates.

    pairwise: each later row is held against the first by itself; it stays if it ranks higher, and the first goes if any
    does. Several may stay. best: one row a key, of the highest rank, the first of those.
    """
    if mode == "best":
        w = Window.partitionBy(*keys).orderBy(rank.desc(), F.col(order))
        return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
    w = Window.partitionBy(*keys).orderBy(order)
    all_ = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = df.withColumn("_r", rank).withColumns({"_k": F.row_number().over(w), "_first": F.first("_r").over(w), "_top": F.max("_r").over(all_)})
    stay = F.when(F.col("_k") == 1, F.col("_top") == F.col("_first")).otherwise(F.col("_r") > F.col("_first"))
    return ranked.where(stay).drop("_r", "_k", "_first", "_top")


def first_of_id(df: DataFrame, key: str, order: str, last: bool = False) -> DataFrame:
    """The first (or last) row of each id, by a partial aggregation rather than a window."""
    row = F.struct(*df.columns)
    return df.groupBy(F.col(key).alias("_key")).agg((F.max_by if last else F.min_by)(row, order).alias("_r")).select("_r.*")


def creators(names: DataFrame, name: str, number: str) -> DataFrame:
    """names with creator: of new names that share a registry number, the smallest creates; the others are its aliases.
    Names without a number create themselves."""
    least = names.where(F.col(number).isNotNull()).groupBy(number).agg(F.min(name).alias("_least"))
    return names.join(least, number, "left").select(*names.columns, F.coalesce("_least", name).alias("creator"))
