"""The store's tables, and creating what is missing of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: tables and columns; the first column is the key, but for unit_conversions, which has two
TABLES = {
    "papers": "paper_id string, doi string, title string, year int, journal string, context_json string, latest_run_id bigint, validation_status string",
    "experiments": "experiment_id string, paper_id string, experiment_label string, sensory_method string, scale_type string, scale_range string",
    "panels": "panel_id string, paper_id string, parent_panel_id string, panel_label string, panel_size int, attributes_json string, description string",
    "observations": "observation_id bigint, paper_id string, experiment_id string, panel_id string, measurement_domain string, substance_name string, components_json string, base_matrix string, is_control boolean, attribute_raw string, attribute_normalized string, value double, value_type string, error_value double, error_type string, source_type string, source_location string, extraction_confidence string, source_agent string, run_id bigint",
    "substances": "substance_id bigint, normalized_name string, cas_number string, smiles string, molecular_weight double, category string, properties_json string",
    "substance_aliases": "alias string, substance_id bigint",
    "extraction_runs": "run_id bigint, paper_id string, run_timestamp timestamp, agent1_prompt_version string, agent2_prompt_version string, agent3_prompt_version string, agent4_prompt_version string, model_versions string, status string, validation_report string, corrections_applied int, human_review_items int, token_usage string, total_cost_usd double, notes string",
    "unit_conversions": "unit_raw string, unit_canonical string, multiplier double, category string",
}
DEFAULTS = {"papers": {"validation_status": "pending"}, "observations": {"measurement_domain": "sensory", "is_control": False}, "extraction_runs": {"status": "in_progress", "corrections_applied": 0, "human_review_items": 0, "total_cost_usd": 0.0}}
#: Tables that are laid out by paper, so that a paper's rows are found and rewritten by themselves.
BY_PAPER = ("experiments", "panels", "observations")


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(TABLES[name]))


def conform(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """df with the table's columns and types, missing ones NULL or their default; and the rows in which a value would not
    cast, as they were."""
    fields = T.StructType.fromDDL(TABLES[name]).fields
    here = [f for f in fields if f.name in df.columns]
    bad = F.lit(False)
    for f in here:
        bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).cast("string").try_cast(f.dataType).isNull())
    defaults = DEFAULTS.get(name, {})
    cols = [(F.col(f.name).cast("string").try_cast(f.dataType) if f in here else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields]
    good = df.where(~bad).select(*cols).withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    return good, df.where(bad)


def create_missing(spark: SparkSession, folder: str) -> None:
    """Empty tables where there is none; tables that are there stay as they are."""
    for name in TABLES:
        out = empty(spark, name).write.mode("ignore")
        (out.partitionBy("paper_id") if name in BY_PAPER else out).parquet(f"{folder}/{name}")


def write(df: DataFrame, folder: str, name: str) -> None:
    """Replaces a table, or in tables laid out by paper only the papers that df has."""
    out = df.write.mode("overwrite")
    if name in BY_PAPER:
        out = out.partitionBy("paper_id").option("partitionOverwriteMode", "dynamic")
    out.parquet(f"{folder}/{name}")
