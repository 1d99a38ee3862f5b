"""Checks on measurements: ranges and signs, contamination, references, hierarchy, relevance; corrections and reviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import alias_key, scale_range

# fixed values: words that mark a panel's demographics
DEMOGRAPHIC = [
    "mean_age", "age", "age_mean", "mean age", "bmi", "body mass index", "gender", "sex", "female", "male",
    "percentage female", "percent female", "gender ratio", "sex ratio", "taster status", "genotype", "height", "weight",
    "number of panelists", "panel size",
]
PERCENT_TYPES = ("frequency_pct", "dominance_rate", "relative_pct")
UNSIGNED_TYPES = ("raw_mean", "frequency_pct", "dominance_rate")
#: With more flagged rows than this no correction is asked for.
MOST_FLAGGED = 10


def with_scale(obs: DataFrame, experiments: DataFrame, on: list[str], order: str) -> DataFrame:
    """obs with low and high of its experiment's scale; of repeated experiments the last with a readable scale counts."""
    scales = experiments.withColumn("_s", scale_range("scale_range")).where("_s IS NOT NULL").groupBy(*on).agg(F.max_by("_s", order).alias("_s"))
    return obs.join(scales, on, "left").withColumns({"low": F.col("_s.low"), "high": F.col("_s.high")}).drop("_s")


def _range_list(value: str, value_type: str, low: str, high: str) -> Column:
    """A row's issues as an array of issue, suggested_value, auto_corrected, review; NULL for rows that aren't judged."""
    v, t, lo, hi = (F.col(c) for c in (value, value_type, low, high))
    out = (v < lo) | (v > hi)
    tenth = v / 10
    shift = ((hi <= 10) & (v > 10)) | ((hi > 10) & (hi <= 100) & (v > 100))
    fix = F.when(shift & tenth.between(lo, hi), tenth)
    nothing = F.lit(None).cast("double")
    issue = lambda when, name, fixed, review: F.when(when, F.struct(F.lit(name).alias("issue"), fixed.alias("suggested_value"), fixed.isNotNull().alias("auto_corrected"), review.alias("review")))
    issues = F.array_compact(
        F.array(
            issue(out, "scale_bound_violation", fix, F.when(fix.isNull(), "model").otherwise("none")),
            issue((v < 0) & t.isin(*UNSIGNED_TYPES), "negative_value", nothing, F.lit("human")),
            issue((v > 100) & t.isin(*PERCENT_TYPES), "percentage_over_100", nothing, F.lit("model")),
        )
    )
    return F.when(v.isNotNull() & (F.coalesce(t, F.lit("")) != "derived_param"), issues)


def range_issues(obs: DataFrame, value: str = "value", value_type: str = "value_type", low: str = "low", high: str = "high") -> DataFrame:
    """One row per row and issue: obs with issue, suggested_value, auto_corrected and review (model, human or none)."""
    return obs.select("*", F.explode(_range_list(value, value_type, low, high)).alias("_i")).select(*obs.columns, "_i.*")


def contaminated(attribute: Column | str, words: list[str] | None = None, whole_words: bool = False) -> Column:
    """Whether a name holds a demographic word anywhere (so "beverage" does), or as a word by itself."""
    key = alias_key(F.coalesce(F.col(attribute) if isinstance(attribute, str) else attribute, F.lit("")))
    words = DEMOGRAPHIC if words is None else words
    if whole_words:
        return key.rlike(r"\b(" + "|".join(sorted(words, key=len, reverse=True)) + r")\b")
    return reduce(Column.__or__, [key.contains(w) for w in words])


def unknown_reference(df: DataFrame, known: DataFrame, on: list[str], label: str) -> DataFrame:
    """Rows whose label is not blank and not known; rows of groups that know no label at all are left alone."""
    group = [c for c in on if c != label]
    some = df.where(F.coalesce(alias_key(label), F.lit("")) != "")
    some = some.join(known.select(*group).distinct(), group, "left_semi") if group else some
    return some.join(known.select(*on).distinct(), on, "left_anti")


def larger_than_parent(df: DataFrame, key: str, parent: str, size: str) -> DataFrame:
    """Rows larger than their parent, with the parent's size."""
    up = df.select(F.col(key).alias("_p"), F.col(size).alias("parent_size"))
    return df.join(up, df[parent] == F.col("_p")).where(F.col(size) > F.col("parent_size")).drop("_p")


def split_relevant(df: DataFrame, scored: DataFrame, on: list[str], score: str, least: float) -> DataFrame:
    """df with `dropped`: only rows with a score below `least` are; rows without one stay."""
    return df.join(scored.select(*on, score), on, "left").withColumn("dropped", F.coalesce(F.col(score) < least, F.lit(False)))


def not_processed(jobs: DataFrame, done: DataFrame, on: list[str], force: bool = False) -> DataFrame:
    return jobs if force else jobs.join(done.select(*on).distinct(), on, "left_anti")


def apply_corrections(obs: DataFrame, issues: DataFrame, key: str, value: str = "value") -> DataFrame:
    """obs with the suggested values of automatic corrections, by a stable key."""
    fixes = issues.where("auto_corrected").groupBy(key).agg(F.min("suggested_value").alias("_fix"))
    return obs.join(fixes, key, "left").withColumn(value, F.coalesce("_fix", value)).drop("_fix")


def to_correct(issues: DataFrame, most: int = MOST_FLAGGED) -> DataFrame:
    """The rows for a model to look at: none if there are more than `most`."""
    flagged = issues.where("review = 'model'")
    return flagged.crossJoin(F.broadcast(flagged.agg(F.count("*").alias("_n")))).where(F.col("_n") <= most).drop("_n")


def review_list(issues: DataFrame, missed: DataFrame, columns: list[str]) -> DataFrame:
    """What people are to look at: missed rows of high priority, and issues flagged for them."""
    return missed.where("priority = 'high'").select(*columns).unionByName(issues.where("review = 'human'").select(*columns))


def report(frames: dict[str, DataFrame], by: str) -> DataFrame:
    """by, check, n: how many rows each check raised."""
    parts = [f.select(by, F.lit(name).alias("check")) for name, f in frames.items()]
    return reduce(DataFrame.unionByName, parts).groupBy(by, "check").agg(F.count("*").alias("n"))


def judged(obs: DataFrame, panels: DataFrame, duplicate_keys: list[Column | str], by: str, order: str, attribute: str, label: str) -> DataFrame:
    """obs (with low and high, see with_scale) with what each check says of a row: _issues (an array), _contaminated, _unknown_panel
    and _duplicate. obs is read once; the row's panel and its duplicates are found by joins and a window on the way."""
    known = panels.select(F.col(by).alias("_by"), F.col(label).alias("_label")).distinct().withColumn("_known", F.lit(True))
    some = panels.select(F.col(by).alias("_some")).distinct()
    named = F.coalesce(alias_key(label), F.lit("")) != ""
    first = F.first(order).over(Window.partitionBy(by, *duplicate_keys).orderBy(order))
    rows = obs.withColumn("_duplicate", F.coalesce(F.col(order) != first, F.lit(False)))
    rows = rows.join(some, F.col(by) == F.col("_some"), "left").join(known, (F.col(by) == F.col("_by")) & (F.col(label) == F.col("_label")), "left")
    return rows.select(
        *obs.columns, F.coalesce(_range_list("value", "value_type", "low", "high"), F.array_compact(F.array(F.lit(None).cast(_ISSUE)))).alias("_issues"), contaminated(attribute).alias("_contaminated"),
        (named & F.col("_some").isNotNull() & F.col("_known").isNull()).alias("_unknown_panel"), "_duplicate",
    )


_ISSUE = "struct<issue:string,suggested_value:double,auto_corrected:boolean,review:string>"


def paper_reports(rows: DataFrame, by: str, order: str, totals: Observation | None = None) -> DataFrame:
    """by, report, corrections_applied, human_review_items: judged rows as one JSON a paper, which has the counts of the checks that
    raised something, the corrections in the rows' order, and what is for people to look at. It has no more entries than a few
    for each observation, and a paper's observations came as one JSON too.

    totals observes the run's counts (rows, issues, contaminated, unknown_panels, duplicates) in the same pass: they are there
    once the reports have been written. Of an empty table there are none, for Spark leaves the pass out."""
    counts = {"issues": F.sum(F.size("_issues")), "contaminated": F.count_if("_contaminated"), "unknown_panels": F.count_if("_unknown_panel"), "duplicates": F.count_if("_duplicate")}
    if totals is not None:
        rows = rows.observe(totals, F.count(F.lit(1)).alias("rows"), *[F.coalesce(c, F.lit(0)).alias(n) for n, c in counts.items()])
    review = lambda kind: F.filter("_issues", lambda i: i["review"] == kind if kind else i["auto_corrected"])
    listed = F.transform("_issues", lambda i: F.struct(F.col(order).alias(order), *[i[c].alias(c) for c in ("issue", "suggested_value", "auto_corrected", "review")]))
    per_paper = rows.groupBy(by).agg(
        *[c.alias(n) for n, c in counts.items()], F.sum(F.size(review(None))).cast("int").alias("corrections_applied"), F.sum(F.size(review("human"))).cast("int").alias("human_review_items"),
        F.array_sort(F.flatten(F.collect_list(F.when(F.size("_issues") > 0, listed)))).alias("_listed"),
    )
    people = F.transform(F.filter("_listed", lambda i: i["review"] == "human"), lambda i: F.concat(F.lit("Review: "), i["issue"], F.lit(" at row "), i[order].cast("string")))
    given = lambda c: F.when(F.size(c) > 0, c)
    report = F.to_json(F.struct(*[F.nullif(F.col(n), F.lit(0)).alias(n) for n in sorted(counts)], given(F.col("_listed")).alias("corrections"), given(people).alias("human_review_items")))
    return per_paper.select(by, report.alias("report"), "corrections_applied", "human_review_items")


def ask(df: DataFrame, answer, schema: T.StructType | str) -> DataFrame:
    """The hook for model calls: answer(batch of pandas rows) -> rows of schema; none is built in."""
    return df.mapInPandas(lambda parts: (answer(p) for p in parts), schema)


def ask_in_order(df: DataFrame, by: str, order: str, answer, schema: T.StructType | str) -> DataFrame:
    """The hook for calls that see what came before: answer(a group's rows, sorted) -> rows. A group is a paper's figures."""
    return df.groupBy(by).applyInPandas(lambda pdf: answer(pdf.sort_values(order)), schema)
