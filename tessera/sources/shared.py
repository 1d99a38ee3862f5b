"""Folders that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder's address below the cluster's spark.checkpoint.dir; on a local master without one, in a temporary folder. A
    cluster without one raises RuntimeError."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tessera-work-')}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or a whole folder; a path that isn't there is left alone."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, at = _file_system(spark, path)
    fs.create(at, True).close()
