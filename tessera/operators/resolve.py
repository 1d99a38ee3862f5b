"""References: lookups with a fallback, parents, cascades, figures to places, and the join of old tables into one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import alias_key


def existing(df: DataFrame, store: DataFrame, on: list[str]) -> DataFrame:
    return df.join(store.select(*on).distinct(), on, "left_semi")


def missing(df: DataFrame, store: DataFrame, on: list[str], reason: str) -> DataFrame:
    """The rows that existing() leaves out, with a reason."""
    return df.join(store.select(*on).distinct(), on, "left_anti").withColumn("reason", F.lit(reason))


def last_by(df: DataFrame, keys: list[str], value: str, order: str, first: bool = False) -> DataFrame:
    """keys and the last (or first) value of each: what a map built in row order holds."""
    return df.groupBy(*keys).agg((F.min_by if first else F.max_by)(value, order).alias(value))


def lookup_or(df: DataFrame, exact: DataFrame, fallback: DataFrame, exact_on: dict[str, str], fallback_on: dict[str, str], value: str, label: str) -> DataFrame:
    """df with value from `exact`, or else from `fallback`, and fell_back; a blank label gets neither.

    The *_on give df's column for each key column of a lookup. Both lookups hold a key once (see last_by).
    """
    a = exact.select(*[F.col(k).alias(f"_a_{k}") for k in exact_on], F.col(value).alias("_exact"))
    b = fallback.select(*[F.col(k).alias(f"_b_{k}") for k in fallback_on], F.col(value).alias("_other"))
    out = df
    for side, on, tag in ((a, exact_on, "_a_"), (b, fallback_on, "_b_")):
        cond = None
        for k, mine in on.items():
            c = F.col(mine) == F.col(f"{tag}{k}")
            cond = c if cond is None else cond & c
        out = out.join(side, cond, "left").drop(*[f"{tag}{k}" for k in on])
    blank = F.coalesce(alias_key(label), F.lit("")) == ""
    return out.withColumns(
        {value: F.when(~blank, F.coalesce("_exact", "_other")), "fell_back": ~blank & F.col("_exact").isNull() & F.col("_other").isNotNull()}
    ).drop("_exact", "_other")


def parents(df: DataFrame, group: str, label: str, parent: str, key: str, order: str) -> DataFrame:
    """df with parent_key: the parent's key if the parent is in before its child; rows without parent go in first."""
    root = F.coalesce(F.col(parent), F.lit("")) == ""
    ranked = df.withColumn("_at", F.row_number().over(Window.partitionBy(group).orderBy((~root).cast("int"), order)))
    up = ranked.groupBy(F.col(group).alias("_g"), F.col(label).alias("_l")).agg(F.min_by(key, "_at").alias("_key"), F.min("_at").alias("_first"))
    return ranked.join(up, (F.col(group) == F.col("_g")) & (F.col(parent) == F.col("_l")), "left").withColumn("parent_key", F.when(F.col("_first") < F.col("_at"), F.col("_key"))).drop("_at", "_g", "_l", "_key", "_first")


def resolve_entities(names: DataFrame, aliases: DataFrame, entities: DataFrame, name: str = "name", number: str | None = "cas_number", canonical=None) -> DataFrame:
    """names with substance_id and resolved_by: alias, name, canonical name (a column function, if given), or registry number.

    What stays without an id is to be created (see dedup.creators). Registry sides are unique by their keys.
    """
    key = alias_key(name)
    out = names.withColumn("_key", key).join(aliases.select(F.col("alias").alias("_key"), F.col("substance_id").alias("_by_alias")), "_key", "left")
    out = out.join(entities.select(F.col("normalized_name").alias("_key"), F.col("substance_id").alias("_by_name")), "_key", "left")
    steps = [("alias", "_by_alias"), ("name", "_by_name")]
    if canonical is not None:
        out = out.withColumn("_canon", canonical(F.col(name))).join(entities.select(F.col("normalized_name").alias("_canon"), F.col("substance_id").alias("_by_canon")), "_canon", "left")
        steps.append(("canonical", "_by_canon"))
    if number:
        by_number = entities.where(f"{number} IS NOT NULL").groupBy(F.col(number).alias("_number")).agg(F.min("substance_id").alias("_by_number"))
        out = out.join(by_number, F.col(number) == F.col("_number"), "left")
        steps.append(("number", "_by_number"))
    how = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(n)) for n, c in steps])
    return out.withColumns({"substance_id": F.coalesce(*[F.col(c) for _, c in steps]), "resolved_by": how}).drop("_key", "_canon", "_number", *[c for _, c in steps])


def with_panels(obs: DataFrame, panels: DataFrame) -> DataFrame:
    """Measurements with their panels' columns, NULL where there is none."""
    extra = [c for c in panels.columns if c not in obs.columns]
    return obs.join(panels.select("panel_id", *extra), "panel_id", "left")


def alias_table(aliases: DataFrame, entities: DataFrame, only: list[str] | None = None) -> DataFrame:
    """alias and its entity's columns, for some aliases or all."""
    some = aliases if only is None else aliases.where(F.col("alias").isin(only))
    return some.join(entities, "substance_id")


def figure_of(obs: DataFrame, figures: DataFrame, group: str, location: str, figure: str, order: str, key: str) -> DataFrame:
    """obs with the first figure of its group whose id its location holds. Groups are small: papers."""
    f = figures.select(F.col(group).alias("_g"), F.col(figure).alias("_f"), F.col(order).alias("_o"))
    hits = obs.join(f, (F.col(group) == F.col("_g")) & F.lower(location).contains(F.lower("_f"))).groupBy(key).agg(F.min_by("_f", "_o").alias("figure_found"))
    return obs.join(hits, key, "left")


def figure_id(c: Column) -> Column:
    """figure_1, Figure 1 and Fig. 1 as one id."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"^fig(ure|\.)?[\s_]*", "figure_"), r"\s+", "_")


def wide_measurements(results: DataFrame, samples: DataFrame, parts: DataFrame, stimuli: DataFrame, entities: DataFrame) -> DataFrame:
    """One row a result with its sample, the sample's components as JSON and the first of them by name.

    Results whose sample or components are unknown stay; a component of an unknown stimulus is "unknown".
    """
    named = (
        parts.join(stimuli, "stimulus_id", "left")
        .join(entities.select("substance_id", F.col("normalized_name").alias("_known")), "substance_id", "left")
        .withColumn("_name", F.coalesce("_known", "stimulus_name", F.lit("unknown")))
    )
    listed = named.groupBy("sample_id").agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("component_id", "_name", "concentration", "unit"))), lambda x: F.struct(x["_name"].alias("substance"), x["concentration"].alias("concentration"), x["unit"].alias("unit")))).alias("components_json"),
        F.min_by("_name", "component_id").alias("substance_name"),
    )
    return results.join(samples, "sample_id", "left").join(listed, "sample_id", "left")


# fixed values: open columns of old papers, experiments and stimuli, in order; those named *_json hold JSON
OPEN_PAPER = (
    "country", "food_category", "num_experiments", "panel_types", "max_panel_size", "has_figure_data", "has_supplementary_data",
    "data_availability", "data_availability_details", "context_json",
)
OPEN_EXPERIMENT = ("panel_size", "panel_type", "serving_temp_c", "serving_temp_raw", "conditions_json")
OPEN_STIMULUS = ("supplier", "purity", "form", "details_json")


def _open(df: DataFrame, names: tuple[str, ...]) -> tuple[list[Column], Column]:
    """The named columns that df has, as variants (JSON that can't be read is text), and whether any is set."""
    have = [c for c in names if c in df.columns]
    value = lambda c: F.coalesce(F.try_parse_json(c), F.col(c).cast("variant")) if c.endswith("_json") else F.col(c).cast("variant")
    return [value(c).alias(c) for c in have], F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in have], F.lit(False))


def _by_name(df: DataFrame, name: Column, order: str, names: tuple[str, ...], out: str) -> DataFrame:
    """paper_id and a map of name to open columns; of one name the last row counts, rows without any are left out."""
    cols, some = _open(df, names)
    if not cols:
        return df.select("paper_id", F.lit(None).cast("map<string,string>").alias(out)).limit(0)
    rows = df.where(some).select("paper_id", name.cast("string").alias("_name"), F.col(order).alias("_at"), F.struct(*cols).alias("_v")).where("_name IS NOT NULL")
    last = rows.groupBy("paper_id", "_name").agg(F.max_by("_v", "_at").alias("_v"))
    listed = last.groupBy("paper_id").agg(F.collect_list(F.struct("_name", "_v")).alias("_l"))
    by_name = F.array_sort("_l", lambda a, b: F.when(a["_name"] < b["_name"], -1).when(a["_name"] > b["_name"], 1).otherwise(0))
    return listed.select("paper_id", F.map_from_entries(by_name).alias(out))


def open_context(papers: DataFrame, experiments: DataFrame, stimuli: DataFrame | None, order: str = "stimulus_id") -> DataFrame:
    """papers with context_json: what old papers, experiments and stimuli hold beyond the new columns, NULLs left out.

    stimuli have paper_id, substance_name and `order`. A paper with nothing of all this has no context."""
    own, some = _open(papers, OPEN_PAPER)
    out = papers.join(_by_name(experiments, F.col("experiment_id"), "experiment_id", OPEN_EXPERIMENT, "experiments"), "paper_id", "left")
    more, has = [F.col("experiments")], some | F.col("experiments").isNotNull()
    if stimuli is not None:
        out = out.join(_by_name(stimuli, F.col("substance_name"), order, OPEN_STIMULUS, "substance_sourcing"), "paper_id", "left")
        more, has = [*more, F.col("substance_sourcing")], has | F.col("substance_sourcing").isNotNull()
    keep = [c for c in papers.columns if c not in OPEN_PAPER]
    return out.select(*keep, F.when(has, F.to_json(F.struct(*own, *more))).alias("context_json"))
