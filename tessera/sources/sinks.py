"""Tables out of the engine: artifacts, ground truth, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import TRUTH


def write_artifacts(df: DataFrame, path: str, key: str = "paper_id", step: str = "step") -> None:
    """One JSON line a row, in a folder by key and step; a key's earlier artifacts of these steps are replaced."""
    rest = [c for c in df.columns if c not in (key, step)]
    rows = df.select(key, step, F.to_json(F.struct(*rest)).alias("value"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key, step).text(path)


def write_ground_truth(df: DataFrame, path: str) -> None:
    """CSV with a header, columns in a fixed order, NULL blank, booleans in capitals."""
    cols = [F.upper(F.col(c).cast("string")).alias(c) if t == "boolean" else F.col(c).cast(t).alias(c) for c, t in TRUTH]
    df.select(*cols).write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="")


def blank_template(df: DataFrame) -> DataFrame:
    """A paper's rows with all that a person is to fill in left blank."""
    asked = {"value", "error", "error_type", "notes"}
    return df.select(*[F.lit(None).cast(t).alias(c) if c in asked else F.col(c) for c, t in TRUTH])


def report_json(df: DataFrame, by: str) -> DataFrame:
    """by, report: each key's rows as one JSON array. Keys have few rows: a report's."""
    return df.groupBy(by).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*[c for c in df.columns if c != by])))).alias("report"))
