"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_owner: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where that is unset, a temporary folder on a local master, as in tests; on a
    cluster, where executors would not see each other's files there, RuntimeError."""
    found = spark.conf.get("spark.checkpoint.dir", None) or _own.get(spark.sparkContext.applicationId)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _own[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="tessera-scratch-")
    return found.rstrip("/")


#: Bytes of a batch that goes to a Python worker. The JVM and the worker hold some copies each, for every task.
BATCH_BYTES = 8 << 20
#: Where the folder is a local one: no checksum file beside each file, for which the JVM would start a process of its own.
_RAW = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by BATCH_BYTES, for results that are not made yet."""
    spark.conf.set(_BATCH, str(BATCH_BYTES))


@contextlib.contextmanager
def owned(tables: list[str]):
    """Tables stored meanwhile are put down in the list, for delete()."""
    _owner.append(tables)
    try:
        yield
    finally:
        _owner.pop()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it again: a lost executor takes nothing with it,
    sizes are known to the planner, and a later join gets its own exchange, which adaptive execution can split.

    Shuffle files that were only needed for the table are of no use then. Spark deletes them when the driver collects
    its garbage, which is asked for here, so that they don't pile up over the steps of an operator."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_BATCH)
    small_batches(spark)
    try:
        df.write.options(**_RAW).option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    if _owner:
        _owner[-1].append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that only tables stored since were made from."""
    for t in tables:
        if path := t.__dict__.pop("_tessera_path", None):
            _delete(t.sparkSession, path)


def delete(spark: SparkSession, tables: list[str]) -> None:
    """Deletes the tables of a list that owned() filled: for when all that was made from them is written."""
    while tables:
        _delete(spark, tables.pop())
