"""Files and catalogs as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_key, json_repair, strip, to_bool, to_double, to_int, to_str

SUFFIXES = (".html", ".htm", ".xml", ".xhtml", ".pdf")
# fixed values: columns of a ground-truth row, in order, with their types
TRUTH = [
    ("paper_id", "string"), ("experiment", "string"), ("measurement_domain", "string"), ("panel_label", "string"),
    ("panel_size", "int"), ("panel_demographics", "string"), ("substance_1", "string"), ("concentration_1", "double"),
    ("unit_1", "string"), ("substance_2", "string"), ("concentration_2", "double"), ("unit_2", "string"),
    ("base_matrix", "string"), ("is_control", "boolean"), ("attribute", "string"), ("value", "double"),
    ("value_type", "string"), ("error", "double"), ("error_type", "string"), ("source_type", "string"),
    ("source_location", "string"), ("notes", "string"),
]


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def document_files(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """path, length, content, text and kind of a folder's documents, not of those below it; hidden files are left out."""
    files = spark.read.format("binaryFile").load(folder)
    name = F.lower(_name(F.col("path")))
    wanted = ~name.startswith(".") & F.array_contains(F.array(*map(F.lit, suffixes)), F.regexp_extract(name, r"\.[^.]+$", 0))
    return files.where(wanted).select("path", "length", "content", decoded("content").alias("text"), file_kind("path").alias("kind"))


def decoded(content: Column | str) -> Column:
    """Bytes as UTF-8, or else as Latin-1, which always reads."""
    c = F.col(content) if isinstance(content, str) else content
    return F.coalesce(F.try_validate_utf8(c.cast("string")), F.decode(c, "ISO-8859-1"))


def file_kind(path: Column | str) -> Column:
    return F.when(F.lower(F.col(path) if isinstance(path, str) else path).endswith(".pdf"), "pdf").otherwise("html")


def job_list(spark: SparkSession, path: str) -> DataFrame:
    """file_path, doi, study_id of a job list; relative paths are relative to the list. Rows without a path are left out."""
    rows = spark.read.csv(path, header=True)
    have = [c for c in ("file_path", "doi", "study_id") if c in rows.columns]
    rows = rows.select(*[F.coalesce(strip(c), F.lit("")).alias(c) for c in have], F.col("_metadata.file_path").alias("_at"))
    folder = F.regexp_replace("_at", r"[^/]*$", "")
    full = F.when(F.col("file_path").rlike(r"^(/|[a-zA-Z][a-zA-Z0-9+.-]*:)"), F.col("file_path")).otherwise(F.concat(folder, F.col("file_path")))
    return rows.where("file_path <> ''").select(full.alias("file_path"), *[F.col(c) for c in have[1:]])


def ground_truth(spark: SparkSession, paths: str | list[str], blank_mark: str = "_BLANK") -> DataFrame:
    """Typed rows of ground-truth files; templates are left out, and a blank paper_id is the file's name."""
    rows = spark.read.schema(", ".join(f"{c} string" for c, _ in TRUTH)).csv(paths, header=True, enforceSchema=True)
    rows = rows.withColumn("_file", F.col("_metadata.file_name")).where(~F.col("_file").contains(blank_mark))
    types = {"double": to_double, "int": to_int, "boolean": to_bool, "string": to_str}
    out = rows.select("_file", *[types[t](c).alias(c) for c, t in TRUTH])
    return out.withColumn("paper_id", F.coalesce("paper_id", F.regexp_replace("_file", r"\.[^.]+$", ""))).drop("_file")


def json_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """path, paper_id and artifact (VARIANT, NULL where it can't be read) of files of one JSON document each."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.select("path", file_key("path").alias("paper_id"), json_repair("value").alias("artifact"))


def vocabulary(spark: SparkSession, path: str, field: str = "mappings") -> DataFrame:
    """raw, term of a vocabulary file's mappings."""
    rows = spark.read.text(path, wholetext=True)
    maps = F.from_json(F.get_json_object("value", f"$.{field}"), "map<string,string>")
    return rows.select(F.explode(maps).alias("raw", "term"))


def table_rows(spark: SparkSession, path: str, key: str, value: object, order: list[str]) -> DataFrame:
    """A table's rows of one key, in order; the key reaches the scan as a pushed filter."""
    return spark.read.parquet(path).where(F.col(key) == F.lit(value)).orderBy(*[F.col(c).asc_nulls_first() for c in order])


def catalog(spark: SparkSession) -> DataFrame:
    """table, column, type of the session's tables and views."""
    rows = [(t.name, c.name, c.dataType) for t in spark.catalog.listTables() for c in spark.catalog.listColumns(t.name)]
    return spark.createDataFrame(rows, "table string, column string, type string")


def local_copies(figures: DataFrame, files: DataFrame, url: str = "image_url") -> DataFrame:
    """figures with local_path: the file that has its picture's name, if there is one; nothing is fetched."""
    by_name = files.groupBy(F.lower(_name(F.col("path"))).alias("_n")).agg(F.min("path").alias("local_path"))
    return figures.withColumn("_n", F.lower(_name(F.regexp_replace(url, r"[?#].*$", "")))).join(by_name, "_n", "left").drop("_n")
