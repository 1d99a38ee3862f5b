"""Changes of tables that only append: each operator returns the table as it is after the change.

Keys are unique in the table; a batch may repeat them, and says by `order` which of its rows comes last.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _last(new: DataFrame, key: str, order: str | None, first: bool = False) -> DataFrame:
    if order is None:
        return new
    row = F.struct(*[c for c in new.columns if c != order])
    return new.groupBy(F.col(key).alias("_key")).agg((F.min_by if first else F.max_by)(row, order).alias("_r")).select("_r.*")


def upsert(old: DataFrame, new: DataFrame, key: str, order: str | None = None, keep_old_values: bool = False) -> DataFrame:
    """New keys go in; of known ones the given columns are overwritten, with NULL too unless keep_old_values."""
    last = _last(new, key, order)
    n = last.select(F.col(key), *[F.col(c).alias(f"_n_{c}") for c in last.columns if c != key], F.lit(True).alias("_new"))
    pick = lambda c: F.coalesce(f"_n_{c}", c) if keep_old_values else F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c))
    return old.join(n, key, "full").select(*[pick(c).alias(c) if c in last.columns and c != key else F.col(c) for c in old.columns])


def replace(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Whole rows by key; columns that new lacks become NULL."""
    last = _last(new, key, order)
    return old.join(last.select(key), key, "left_anti").unionByName(last, allowMissingColumns=True).select(*old.columns)


def insert_missing(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows of unknown keys go in, the first of each; known ones stay as they are."""
    first = _last(new, key, order, first=True)
    return old.unionByName(first.join(old.select(key), key, "left_anti"), allowMissingColumns=True).select(*old.columns)


def append(old: DataFrame, new: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    """Missing columns are NULL or their default; arrays, maps and structs become JSON where the table has text."""
    kinds = dict(old.dtypes)
    for c, kind in new.dtypes:
        if kinds.get(c) == "string" and kind.startswith(("array", "map", "struct")):
            new = new.withColumn(c, F.to_json(c))
    out = old.unionByName(new.select(*[c for c in new.columns if c in kinds]), allowMissingColumns=True)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def with_ids(old: DataFrame, new: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """new with ids that go on after old's largest, in a stable order.

    Numbering is global without one task for all rows: rows are range-sorted by their order, counted by partition, and
    partitions' sums (one small row each) give where each begins. The ranged rows are checkpointed where the cluster has
    a folder for it, so that a task that is tried again counts the same rows.
    """
    ranged = new.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_m": F.monotonically_increasing_id()})
    if new.sparkSession.sparkContext.getCheckpointDir():
        ranged = ranged.checkpoint()
    ranged = ranged.withColumn("_k", F.col("_m") - F.shiftleft(F.col("_part").cast("long"), 33))
    sums = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    begin = sums.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    top = old.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_top"))
    return ranged.join(F.broadcast(begin), "_part").crossJoin(F.broadcast(top)).withColumn(id_col, F.col("_top") + F.col("_before") + F.col("_k") + 1).drop("_part", "_m", "_k", "_before", "_top")


#: What may be set when a run ends.
RUN_RESULTS = {"status", "validation_report", "corrections_applied", "human_review_items", "token_usage", "total_cost_usd", "notes"}


def start_runs(runs: DataFrame, papers: DataFrame, models: dict[str, str] | None = None, prompts: dict[str, str] | None = None) -> DataFrame:
    """New rows of runs, one a paper, with ids that go on after the largest, in progress since now (UTC by the session)."""
    new = with_ids(runs, papers.select("paper_id").distinct(), "run_id", ["paper_id"])
    versions = {c: F.lit((prompts or {}).get(c.split("_")[0])).cast("string") for c in runs.columns if c.endswith("_prompt_version")}
    given = versions | {"run_timestamp": F.current_timestamp(), "model_versions": F.lit(json.dumps(models or {})), "status": F.lit("in_progress")}
    zero = {"corrections_applied": 0, "human_review_items": 0, "total_cost_usd": 0.0}
    new = new.withColumns({c: v for c, v in given.items() if c in runs.columns} | {c: F.lit(v) for c, v in zero.items() if c in runs.columns})
    return runs.limit(0).unionByName(new, allowMissingColumns=True).select(*runs.columns)


def finish_run(runs: DataFrame, run_id: int, **results: object) -> DataFrame:
    """runs with the results of one; dicts become JSON, and what is no result of a run is dropped without a word."""
    values = {k: json.dumps(v) if isinstance(v, dict) else v for k, v in results.items()}
    return update_allowed(runs, "run_id", run_id, values, RUN_RESULTS)


def update_allowed(old: DataFrame, key: str, key_value: object, values: dict[str, object], allowed: set[str]) -> DataFrame:
    """Sets allowed columns of one row; others are dropped without a word."""
    hit = F.col(key) == F.lit(key_value)
    return old.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in values.items() if c in allowed and c in old.columns})


def update_where(old: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(where, F.lit(False))
    return old.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(old: DataFrame, where: Column) -> DataFrame:
    """Rows for which the predicate is NULL stay."""
    return old.where(~F.coalesce(where, F.lit(False)))


def delete_keys(tables: dict[str, DataFrame], gone: DataFrame, key: str, keep: set[str] = frozenset()) -> dict[str, DataFrame]:
    """All tables that have the key without the given keys; those in `keep` stay."""
    return {n: t if n in keep or key not in t.columns else t.join(gone.select(key).distinct(), key, "left_anti") for n, t in tables.items()}


def violations(df: DataFrame, parent: DataFrame, column: str, parent_key: str) -> DataFrame:
    """Rows whose reference is set and has no parent."""
    return df.where(F.col(column).isNotNull()).join(parent.select(F.col(parent_key).alias(column)).distinct(), column, "left_anti")
