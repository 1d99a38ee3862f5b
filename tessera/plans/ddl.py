"""Tables of the session's catalog: creating what is missing, and adding columns without touching a file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schema

#: fixed values: what the sixth version of the store has beyond the fifth; None is a table that is created whole
SIXTH = {"panels": None, "observations": {"panel_id": ("string", None), "measurement_domain": ("string", "sensory")}}
_FIELDS = "table string, column string, type string, ord int, default string"


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else repr(value)


def _column(name: str, kind: str, default: object) -> str:
    return f"{_quoted(name)} {kind}" + (f" DEFAULT {_literal(default)}" if default is not None else "")


def create_table(spark: SparkSession, name: str, columns: dict[str, tuple[str, object]], location: str | None = None) -> bool:
    """Creates a table of columns (type, default) if there is none of that name, and says whether it did. Rows that are inserted
    without a column get its default."""
    if spark.catalog.tableExists(name):
        return False
    body = ", ".join(_column(c, kind, default) for c, (kind, default) in columns.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({body}) USING parquet" + (f" LOCATION {_literal(location)}" if location else ""))
    return True


def add_columns(spark: SparkSession, name: str, columns: dict[str, tuple[str, object]]) -> list[str]:
    """Adds the columns (type, default) that the table lacks, and gives their names. Only the catalog changes: rows of files
    from before have the default when they are read, and the files stay as they are. A second time adds nothing."""
    have = {f.name.lower() for f in spark.table(_quoted(name)).schema}
    new = {c: v for c, v in columns.items() if c.lower() not in have}
    if new:
        spark.sql(f"ALTER TABLE {_quoted(name)} ADD COLUMNS (" + ", ".join(_column(c, kind, default) for c, (kind, default) in new.items()) + ")")
    return list(new)


def store_columns(name: str) -> dict[str, tuple[str, object]]:
    """A store table's columns with their types and defaults."""
    defaults = schema.DEFAULTS.get(name, {})
    return {f.name: (f.dataType.simpleString(), defaults.get(f.name)) for f in T.StructType.fromDDL(schema.TABLES[name]).fields}


def create_store(spark: SparkSession, database: str, location: str | None = None) -> list[str]:
    """All of the store's tables that are missing in a database, created; gives their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    return [n for n in schema.TABLES if create_table(spark, f"{database}.{n}", store_columns(n), location and f"{location}/{n}")]


def to_sixth(spark: SparkSession, database: str, location: str | None = None, dry_run: bool = False) -> list[str]:
    """Brings a store of the fifth version to the sixth, and gives the steps taken (or, dry, those it would take): tables and
    columns, as table or table.column. Steps taken before are not taken again, so a migration that was stopped goes on."""
    steps = []
    for table, columns in SIXTH.items():
        name = f"{database}.{table}"
        if columns is None:
            if not spark.catalog.tableExists(name):
                steps.append(table)
                if not dry_run:
                    create_table(spark, name, store_columns(table), location and f"{location}/{table}")
        elif dry_run:
            have = {f.name for f in spark.table(_quoted(name)).schema}
            steps += [f"{table}.{c}" for c in columns if c not in have]
        else:
            steps += [f"{table}.{c}" for c in add_columns(spark, name, columns)]
    return steps


def described(spark: SparkSession, database: str) -> DataFrame:
    """table, column, type, ord, default of all of a database's tables: their names are listed, each is described as a frame."""
    names = [r.tableName for r in spark.sql(f"SHOW TABLES IN {_quoted(database)}").where("NOT isTemporary").collect()]
    parts = []
    for n in names:
        fields = spark.table(_quoted(f"{database}.{n}")).schema
        about = {f.name: (i, f.metadata.get("CURRENT_DEFAULT")) for i, f in enumerate(fields)}
        rows = spark.sql(f"DESCRIBE TABLE {_quoted(f'{database}.{n}')}").where(F.col("col_name").isin(*about)).dropDuplicates(["col_name"])
        extra = spark.createDataFrame([(c, i, d) for c, (i, d) in about.items()], "col_name string, ord int, default string")
        parts.append(rows.join(F.broadcast(extra), "col_name").select(F.lit(n).alias("table"), F.col("col_name").alias("column"), F.col("data_type").alias("type"), "ord", "default"))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _FIELDS)
