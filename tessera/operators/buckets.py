"""Stored tables whose rows lie in folders by their key's hash, so that a change rewrites the folders of its keys alone.

A table is a folder: `rows` holds Parquet by `_bucket`, `layout` one row with the key and the number of buckets, and `staged` the
buckets of the newest change as they are after it. A change is staged as a whole before it is moved to `rows`, and its number
tells whether it was staged before: one that is tried again after a failure moves what it staged, and works nothing out anew. The
next change first ends one that stopped halfway. Changes whose numbers are not above the newest's are not made again. One writer
at a time; readers see a change bucket by bucket.

Keys may be NULL (they have a bucket of their own), and may repeat where the change allows it: large buckets are written in
several files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import delete, exists, mark
from . import store

Change = Callable[[DataFrame, DataFrame], DataFrame]


def _bucket(key: Column | str, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _layout(spark: SparkSession, table: str) -> tuple[str, int]:
    row = spark.read.json(f"{table}/layout", schema="key string, buckets int").first()
    return row.key, row.buckets


def _write(rows: DataFrame, folder: str) -> None:
    """A bucket goes to one task, or to several if it is large."""
    writer = rows.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_bucket").parquet(folder)


def create(rows: DataFrame, table: str, key: str, buckets: int = 256) -> None:
    """Stores rows; the layout is written last, and a table without one is none, so that a failed attempt is made anew. A table
    that is there raises ValueError."""
    spark = rows.sparkSession
    if exists(spark, f"{table}/layout/_SUCCESS"):
        raise ValueError(f"there is a table at {table}")
    delete(spark, f"{table}/rows")
    # the schema stays when the last row goes
    rows.limit(0).withColumn("_bucket", _bucket(key, buckets)).write.mode("overwrite").parquet(f"{table}/schema")
    _write(rows.withColumn("_bucket", _bucket(key, buckets)), f"{table}/rows")
    spark.range(1).select(F.lit(key).alias("key"), F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").json(f"{table}/layout")


def _stored(spark: SparkSession, table: str) -> DataFrame:
    kinds = spark.read.parquet(f"{table}/schema").schema
    if not exists(spark, f"{table}/rows"):
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(f"{table}/rows")


def read(spark: SparkSession, table: str) -> DataFrame:
    return _stored(spark, table).drop("_bucket")


def read_keys(spark: SparkSession, table: str, keys: list) -> DataFrame:
    """The rows of a few keys; only the folders of their buckets are listed and read."""
    key, n = _layout(spark, table)
    rows = _stored(spark, table)
    kind = rows.schema[key].dataType
    at = spark.range(1).select(F.array(*[_bucket(F.lit(k).cast(kind), n) for k in keys])).first()[0] if keys else []
    return rows.where(F.col("_bucket").isin(*at) & F.col(key).isin(*keys)).drop("_bucket")


def _staged(spark: SparkSession, table: str) -> tuple[int | None, list[int]]:
    """The number of the change that is staged as a whole, if there is one, and its buckets."""
    if not exists(spark, f"{table}/staged/record/_SUCCESS"):
        return None, []
    rows = spark.read.json(f"{table}/staged/record", schema="number long, bucket int").collect()
    return rows[0].number, sorted(r.bucket for r in rows if r.bucket is not None)


def _move(spark: SparkSession, table: str, touched: list[int]) -> None:
    left = [b for b in touched if exists(spark, f"{table}/staged/rows/_bucket={b}")]
    if left:
        _write(spark.read.schema(spark.read.parquet(f"{table}/schema").schema).parquet(f"{table}/staged/rows"), f"{table}/rows")
    for b in set(touched) - set(left):
        delete(spark, f"{table}/rows/_bucket={b}")
    mark(spark, f"{table}/staged/moved")


def change(table: str, batch: DataFrame, make: Change, number: int) -> list[int]:
    """Makes the change `number`: the buckets of batch's keys become make(their rows, batch), and the others are not read. Gives the
    buckets that were written or emptied (there are no more than the table has). make may add no rows of keys that are not the
    batch's; a NULL key in batch touches the bucket of NULL keys."""
    spark = batch.sparkSession
    key, n = _layout(spark, table)
    newest, touched = _staged(spark, table)
    if newest is not None and not exists(spark, f"{table}/staged/moved"):
        _move(spark, table, touched)
    if newest is not None and number <= newest:
        return touched if number == newest else []
    touched = sorted(r[0] for r in batch.select(_bucket(key, n)).distinct().collect())
    old = _stored(spark, table).where(F.col("_bucket").isin(*touched)).drop("_bucket")
    delete(spark, f"{table}/staged")
    new = make(old, batch).select(*old.columns)
    new.withColumn("_bucket", _bucket(key, n)).hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{table}/staged/rows")
    # written last: a change without it was not staged as a whole
    record = spark.createDataFrame([(number, b) for b in [None, *touched]], "number long, bucket int")
    record.coalesce(1).write.mode("overwrite").json(f"{table}/staged/record")
    _move(spark, table, touched)
    return touched


def upsert(table: str, new: DataFrame, number: int, order: str | None = None, keep_old_values: bool = False) -> list[int]:
    """store.upsert on the buckets of new's keys."""
    key, _ = _layout(new.sparkSession, table)
    return change(table, new, lambda old, batch: store.upsert(old, batch, key, order, keep_old_values), number)


def insert_missing(table: str, new: DataFrame, number: int, order: str | None = None) -> list[int]:
    """store.insert_missing on the buckets of new's keys."""
    key, _ = _layout(new.sparkSession, table)
    return change(table, new, lambda old, batch: store.insert_missing(old, batch, key, order), number)


def delete_keys(table: str, gone: DataFrame, number: int) -> list[int]:
    """The table without the keys of gone; NULL keys stay."""
    key, _ = _layout(gone.sparkSession, table)
    keys = gone.select(key).where(F.col(key).isNotNull()).distinct()
    return change(table, keys, lambda old, batch: old.join(batch, key, "left_anti"), number)


def update_where(table: str, where: Column, values: dict[str, Column], number: int, spark: SparkSession) -> list[int]:
    """store.update_where; only the buckets that hold such rows are written. The key is no column to update (ValueError)."""
    key, _ = _layout(spark, table)
    if key in values:
        raise ValueError(f"{key} is the table's key")
    hit = read(spark, table).where(F.coalesce(where, F.lit(False))).select(key).distinct()
    return change(table, hit, lambda old, _batch: store.update_where(old, where, values), number)
