"""Files that keep coming: a stream of rows that are put into a stored table, or of typed measurements that are summed.

Tables only append, so each batch reads the table, changes it, and writes it under a new version folder; the pointer file
is a one-row table that names the version. A batch that is run again after a failure writes the same version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import buckets
from ..sources.shared import delete, exists


def file_stream(spark: SparkSession, path: str, schema, kind: str = "json", per_trigger: int = 100) -> DataFrame:
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", per_trigger).load(path)


def current(spark: SparkSession, table: str, before: int | None = None) -> DataFrame | None:
    """The table's newest version, or its newest of a batch before this one."""
    if not exists(spark, f"{table}/versions"):
        return None
    found = spark.read.json(f"{table}/versions", schema="batch long")
    newest = (found if before is None else found.where(F.col("batch") < before)).agg(F.max("batch")).first()[0]
    return None if newest is None else spark.read.parquet(f"{table}/batch={newest}")


def into_table(stream: DataFrame, table: str, change: Callable[[DataFrame | None, DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Applies change(table so far, batch) for each batch; see operators.store for changes. The newest version and the one before
    stay."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = change(current(spark, table, number), batch)
        new.write.mode("overwrite").parquet(f"{table}/batch={number}")
        spark.range(1).select(F.lit(number).cast("long").alias("batch")).write.mode("append").json(f"{table}/versions")
        delete(spark, f"{table}/batch={number - 2}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def into_buckets(stream: DataFrame, table: str, key: str, change: buckets.Change, checkpoint: str, n: int = 256) -> StreamingQuery:
    """As into_table, for a table of operators.buckets that is made at the first batch: a batch reads and writes the buckets of its
    own keys, and change(those buckets' rows, batch) may keep state in no other. A batch that is run again is made once."""

    def write(batch: DataFrame, number: int) -> None:
        if not exists(batch.sparkSession, f"{table}/layout/_SUCCESS"):
            buckets.create(batch.limit(0), table, key, n)
        buckets.change(table, batch, change, number)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(stream: DataFrame, ts: str, keys: list[str], value: str, width: str, late: str) -> DataFrame:
    """n and total by window and keys; rows later than `late` are left out."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")
