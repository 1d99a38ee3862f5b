"""Whole runs: pages to rows, evaluation against ground truth, validation, and changes of the schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nested
from ..functions.text import alias_key, doi_key, experiment_key, file_key, panel_key, to_double, to_int, without_prefix
from ..operators import dedup, match, resolve, validate
from ..operators.articles import articles

#: The structured artifact, one JSON text a paper.
STRUCTURED = """
struct<context:string,paper:struct<doi:string,title:string,year:int,journal:string>,
experiments:array<struct<experiment:string,label:string,method:string,scale_type:string,scale_range:string>>,
panels:array<struct<panel_label:string,experiment:string,parent_panel_label:string,panel_size:int,attributes_json:string,description:string>>,
observations:array<struct<experiment:string,panel_label:string,measurement_domain:string,substance:string,components:array<struct<substance:string,concentration:string,unit:string>>,base_matrix:string,is_control:boolean,attribute:string,attribute_normalized:string,value:double,value_type:string,error:double,error_type:string,source:string,source_type:string,confidence:string>>>
"""


def parse(files: DataFrame) -> DataFrame:
    """Page files (path, text, and doi if known) to articles with paper_id; for PDF text see articles.pdf_articles."""
    doi = F.col("doi") if "doi" in files.columns else F.lit(None).cast("string")
    keyed = files.withColumn("paper_id", F.coalesce(F.nullif(doi_key(doi), F.lit("")), file_key("path")))
    return articles(keyed.select("paper_id", "path", "text"), "text")


#: The artifact's names of what the store calls otherwise.
STORE_NAMES = {"substance": "substance_name", "attribute": "attribute_raw", "error": "error_value", "source": "source_location", "confidence": "extraction_confidence"}


def structured(artifacts: DataFrame, text: str = "value", run_id: int | None = None) -> dict[str, DataFrame]:
    """paper_id and artifact texts to the store's papers, experiments, panels and observations, and what was dropped.

    Observations have the store's columns (and ord, experiment, panel_label, components and fell_back beside them), so
    that schema.conform loses none of them."""
    a = artifacts.select("paper_id", F.from_json(text, STRUCTURED).alias("s"))
    papers = a.select("paper_id", "s.paper.*", F.when(~F.trim("s.context").isin("", "{}", "[]", "null"), F.col("s.context")).alias("context_json"), F.lit(run_id).cast("long").alias("latest_run_id"))
    number = lambda c: F.coalesce(c, F.lit("exp1"))
    experiments = a.select("paper_id", F.posexplode("s.experiments").alias("ord", "e")).select("paper_id", "ord", experiment_key(F.col("paper_id"), number(F.col("e.experiment"))).alias("experiment_id"), number(F.col("e.experiment")).alias("experiment"), F.col("e.label").alias("experiment_label"), F.col("e.method").alias("sensory_method"), "e.scale_type", "e.scale_range")
    panels = a.select("paper_id", F.posexplode("s.panels").alias("ord", "p")).select("paper_id", "ord", "p.*").withColumn("panel_label", F.coalesce("panel_label", F.lit("unknown"))).withColumn("panel_id", panel_key(F.col("paper_id"), F.col("panel_label")))
    panels = resolve.parents(panels, "paper_id", "panel_label", "parent_panel_label", "panel_id", "ord").withColumnRenamed("parent_key", "parent_panel_id")
    obs = a.select("paper_id", F.posexplode("s.observations").alias("ord", "o")).select("paper_id", "ord", "o.*").withColumnsRenamed(STORE_NAMES)
    obs = obs.withColumn("experiment", number(F.col("experiment"))).withColumns({"experiment_id": experiment_key(F.col("paper_id"), F.col("experiment")), "measurement_domain": F.coalesce("measurement_domain", F.lit("sensory")), "is_control": F.coalesce("is_control", F.lit(False)), "components_json": F.to_json("components", {"ignoreNullFields": "false"}), "source_agent": F.lit("structuring"), "run_id": F.lit(run_id).cast("long")})
    known = resolve.existing(obs, experiments, ["experiment_id"])
    dropped = resolve.missing(obs, experiments, ["experiment_id"], "unknown experiment")
    exact = resolve.last_by(panels.withColumn("label", F.col("panel_label")), ["paper_id", "label"], "panel_id", "ord")
    full = resolve.last_by(panels.where((F.coalesce("parent_panel_label", F.lit("")) == "") & (F.col("experiment") != "")), ["paper_id", "experiment"], "panel_id", "ord")
    placed = resolve.lookup_or(known, exact, full, {"paper_id": "paper_id", "label": "panel_label"}, {"paper_id": "paper_id", "experiment": "experiment"}, "panel_id", "panel_label")
    return {"papers": papers, "experiments": experiments, "panels": panels, "observations": placed, "dropped": dropped}


def summaries(artifacts: DataFrame, text: str = "value") -> DataFrame:
    """paper_id, observations and experiments: short JSON lists of an artifact, for a model that goes on from there.

    An observation's concentration is its first component's; NULLs are kept, a missing source or attribute is empty."""
    a = artifacts.select("paper_id", F.from_json(text, STRUCTURED).alias("s"))
    empty = F.lit("")
    one = lambda o: F.struct(
        o["substance"].alias("substance"), F.get(o["components"], F.lit(0))["concentration"].alias("concentration"), F.coalesce(o["attribute_normalized"], o["attribute"], empty).alias("attribute"),
        o["value"].alias("value"), F.coalesce(o["value_type"], empty).alias("value_type"), F.coalesce(o["source"], empty).alias("source"),
    )
    setting = lambda e: F.struct(*[e[c].alias(c) for c in ("experiment", "method", "scale_type", "scale_range")])
    as_json = lambda c, f: F.coalesce(F.to_json(F.transform(c, f), {"ignoreNullFields": "false"}), F.lit("[]"))
    return a.select("paper_id", as_json("s.observations", one).alias("observations"), as_json("s.experiments", setting).alias("experiments"))


def as_truth(obs: DataFrame, panels: DataFrame) -> DataFrame:
    """Stored observations in the ground truth's columns."""
    p = panels.select("panel_id", F.col("panel_size").alias("_size"), F.col("attributes_json").alias("_attributes"), F.col("panel_label").alias("_label"))
    slots = nested.component_slots("components_json", F.col("substance_name"))
    full = obs.drop("panel_label").join(p, "panel_id", "left").withColumn("_s", slots)
    return full.select(
        "paper_id", without_prefix("experiment_id", F.col("paper_id")).alias("experiment"), "measurement_domain", F.col("_label").alias("panel_label"), to_int(F.col("_size").cast("string")).alias("panel_size"),
        F.nullif(nested.flat_demographics("_attributes"), F.lit("")).alias("panel_demographics"), "_s.substance_1", "_s.concentration_1", "_s.unit_1", "_s.substance_2", "_s.concentration_2", "_s.unit_2",
        "base_matrix", F.coalesce("is_control", F.lit(False)).alias("is_control"), F.coalesce(F.nullif("attribute_raw", F.lit("")), "attribute_normalized").alias("attribute"), to_double(F.col("value").cast("string")).alias("value"),
        "value_type", F.col("error_value").alias("error"), "error_type", "source_type", "source_location", "_s.notes", "ord",
    )


def evaluate(truth: DataFrame, found: DataFrame, substances: dict[str, str], attributes: dict[str, str]) -> dict[str, DataFrame]:
    """Pairs, rows of one side only, mismatches, and the overall and broken-down scores, over all papers at once."""
    pairs = match.match_measurements(truth, found, substances, attributes)
    sides = match.two_sides(pairs, ["value_type", "source_location", "attribute", "experiment", "panel_label", "measurement_domain"])
    return {
        "pairs": pairs,
        "unmatched": pairs.where("status <> 'matched'"),
        "mismatches": pairs.where("status = 'matched' AND NOT is_correct").withColumn("pct_diff", F.round(F.col("pct_diff") * 100, 2)),
        "overall": match.overall(sides),
        "breakdown": match.breakdown(sides, match.measurement_dimensions()),
    }


def check(obs: DataFrame, experiments: DataFrame, panels: DataFrame, key: str = "ord") -> dict[str, DataFrame]:
    """All deterministic checks of observations, the corrected rows, and those that stay after duplicates went."""
    order = "ord" if "ord" in experiments.columns else "experiment_id"  # of repeated experiments the last of the list counts
    scaled = validate.with_scale(obs, experiments.select("paper_id", "experiment", "scale_range", order), ["paper_id", "experiment"], order)
    issues = validate.range_issues(scaled)
    fixed = validate.apply_corrections(obs.withColumn("_key", F.concat_ws("#", "paper_id", F.col(key).cast("string"))), issues.withColumn("_key", F.concat_ws("#", "paper_id", F.col(key).cast("string"))), "_key").drop("_key")
    keys: list[Column | str] = ["paper_id", *dedup.measurement_keys()]
    with_number = fixed.withColumns({"substance": F.col("substance_name"), "attribute": F.col("attribute_raw")}).withColumn("concentration", nested.first_concentration("components_json"))
    as_read = scaled.withColumns({"substance": F.col("substance_name"), "attribute": F.col("attribute_raw"), "concentration": nested.first_concentration("components_json")})
    return {
        "judged": validate.judged(as_read, panels, keys[1:], "paper_id", key, "attribute_raw", "panel_label"),
        "issues": issues,
        "contaminated": obs.where(validate.contaminated("attribute_raw")),
        "unknown_panels": validate.unknown_reference(obs, panels, ["paper_id", "panel_label"], "panel_label"),
        "panel_sizes": validate.larger_than_parent(panels, "panel_id", "parent_panel_id", "panel_size"),
        "duplicates": dedup.duplicate_pairs(with_number, keys, key),
        "corrected": fixed,
        "kept": dedup.survivors(with_number, keys, key, dedup.source_rank("source_type")),
    }


def add_columns(df: DataFrame, columns: dict[str, object]) -> DataFrame:
    """Columns that are missing, with a default; those there stay."""
    return df.withColumns({c: F.lit(v) for c, v in columns.items() if c not in df.columns})


def panels_in_context(papers: DataFrame, context: str = "context_json") -> DataFrame:
    """Papers whose context has panels that hold anything."""
    panels = F.from_json(F.get_json_object(context, "$.panels"), "map<string,string>")
    held = F.exists(F.map_values(panels), lambda v: v.isNotNull() & ~v.isin("", "0", "false", "[]", "{}"))
    return papers.where(F.coalesce(held, F.lit(False)))
