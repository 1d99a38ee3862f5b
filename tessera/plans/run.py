"""The run command: documents to published rows, for all papers of a batch at once, restartable at each step.

A store is a folder. Each run of the command is a batch with a number, and all that it writes lies under batch=<number>:

    articles/          the batch's documents, parsed
    runs_started/      one row a paper that the batch works on, in progress
    artifacts/<step>/  what a step gave: paper_id, run_id, value, error, usages
    <table>/           rows of the tables (plans.schema.TABLES) that are laid out by run
    extraction_runs/   the same runs with their results, written last

Rows are seen through published(): those of a paper's latest run that ended well. A batch that fails on its way has no such
runs, so nothing of it is seen, and nothing that was there before is changed; run(resume=True) takes the batch up again and
reads what its finished steps wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.client import USAGE, usage_rows
from ..operators import aggregate, dedup, store, validate
from ..operators.articles import prompt_text, tables_text
from . import lifecycle, schema

#: Where a run can begin. What comes before is read from artifacts.
STEPS = ("extract", "figures", "validate")
ARTIFACT = f"paper_id string, value string, error string, usages array<{USAGE}>"
#: Statuses of runs whose rows are seen, and of papers that are not worked on again unless forced.
GOOD, SETTLED = ("completed", "partial"), ("completed", "partial", "skipped_too_large")
#: An error that begins so means that a paper is too large for a model.
TOO_LARGE = "too large"
_BATCH = "batch"


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _there(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _batches(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the batches of which `name` is written whole."""
    fs, at = _fs(spark, f"{folder}/{name}")
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n.removeprefix(f"{_BATCH}=")) for n in names if n.startswith(f"{_BATCH}=") and _there(spark, f"{folder}/{name}/{n}/_SUCCESS"))


def _schema(name: str) -> str:
    if name.startswith("artifacts/"):
        return f"{ARTIFACT}, run_id long"
    if name in ("experiments", "panels"):
        return f"{schema.TABLES[name]}, run_id long"
    return schema.TABLES["extraction_runs" if name == "runs_started" else name]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """All batches of a table that are written whole, with their number; empty if there is none."""
    full = f"{_schema(name)}, {_BATCH} long"
    numbers = _batches(spark, folder, name)
    if not numbers:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{folder}/{name}").parquet(*[f"{folder}/{name}/{_BATCH}={n}" for n in numbers])


def write(df: DataFrame, folder: str, name: str, batch: int) -> DataFrame:
    """Puts a batch's part of a table in its place, a failed try's remains replaced, and reads it again."""
    path = f"{folder}/{name}/{_BATCH}={batch}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """All runs: those that ended with their results, the others in progress."""
    ended = read(spark, folder, "extraction_runs")
    return ended.unionByName(read(spark, folder, "runs_started").join(ended.select("run_id"), "run_id", "left_anti"))


def latest(spark: SparkSession, folder: str, statuses: tuple[str, ...] = GOOD) -> DataFrame:
    """paper_id, run_id of each paper's latest run that ended with one of the statuses."""
    return read(spark, folder, "extraction_runs").where(F.col("status").isin(*statuses)).groupBy("paper_id").agg(F.max("run_id").alias("run_id"))


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rows of a table that are seen: for each paper those of its latest run that ended well."""
    rows = read(spark, folder, name).drop(_BATCH)
    run = "latest_run_id" if name == "papers" else "run_id"
    return rows.join(latest(spark, folder).withColumnRenamed("run_id", run), ["paper_id", run], "left_semi").select(*schema.empty(spark, name).columns)


def _artifacts_before(spark: SparkSession, folder: str, step: str) -> DataFrame:
    """The newest good artifact of a step, for each paper."""
    rows = read(spark, folder, f"artifacts/{step}").where("error IS NULL AND value IS NOT NULL")
    return rows.groupBy("paper_id").agg(F.max_by(F.struct("value"), "run_id").alias("_v")).select("paper_id", "_v.value")


class _Batch:
    """One batch's steps: each is worked on once, or read if it was finished before."""

    def __init__(self, spark: SparkSession, folder: str, number: int, resume: bool):
        self.spark, self.folder, self.number, self.resume = spark, folder, number, resume

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if self.resume and self.number in _batches(self.spark, self.folder, name):
            return self.spark.read.parquet(f"{self.folder}/{name}/{_BATCH}={self.number}")
        return write(make(), self.folder, name, self.number)

    def step(self, name: str, given: DataFrame, hook: Callable[[DataFrame], DataFrame], started: DataFrame) -> DataFrame:
        """What the hook answers for papers without an error; a paper that it doesn't answer has an error."""

        def make() -> DataFrame:
            answers = hook(given)
            answers = answers.select(*[F.col(c) if c in answers.columns else F.lit(None).cast(kind).alias(c) for c, kind in (("paper_id", "string"), ("value", "string"), ("error", "string"), ("usages", f"array<{USAGE}>"))])
            asked = given.select("paper_id").join(started.select("paper_id", "run_id"), "paper_id")
            missing = F.when(F.col("value").isNull() & F.col("error").isNull(), F.lit(f"{name}: no answer"))
            return asked.join(answers, "paper_id", "left").select("paper_id", "value", F.coalesce("error", missing).alias("error"), "usages", "run_id")

        return self.once(f"artifacts/{name}", make)

    def from_before(self, name: str, started: DataFrame, needed: bool) -> DataFrame:
        """The artifacts of earlier batches as this one's; a paper without one has an error if it is needed."""

        def make() -> DataFrame:
            found = started.select("paper_id", "run_id").join(_artifacts_before(self.spark, self.folder, name), "paper_id", "left")
            error = F.when(F.col("value").isNull(), F.lit(f"{name}: missing artifact")) if needed else F.lit(None).cast("string")
            return found.select("paper_id", "value", error.alias("error"), F.lit(None).cast(f"array<{USAGE}>").alias("usages"), "run_id")

        return self.once(f"artifacts/{name}", make)


def _good(step: DataFrame) -> DataFrame:
    return step.where("error IS NULL AND value IS NOT NULL").select("paper_id", "value")


def _jobs(files: DataFrame, force: bool) -> DataFrame:
    """files as articles with paper_id, study_id (the paper_id where there is none) and again: of several files of one paper the
    first by path counts, or with force the last."""
    parsed = lifecycle.parse(files)
    chosen = parsed.groupBy("paper_id").agg((F.max_by if force else F.min_by)("path", "path").alias("_chosen"))
    parsed = parsed.join(chosen, "paper_id").withColumn("again", F.col("path") != F.col("_chosen")).drop("_chosen")
    if "study_id" in files.columns:
        parsed = parsed.join(files.groupBy("path").agg(F.max("study_id").alias("study_id")), "path", "left")
    own = F.nullif(F.col("study_id"), F.lit("")) if "study_id" in files.columns else F.lit(None).cast("string")
    return parsed.withColumn("study_id", F.coalesce(own, F.col("paper_id")))


def run(
    spark: SparkSession,
    files: DataFrame,
    folder: str,
    hooks: dict[str, Callable[[DataFrame], DataFrame]],
    from_step: str = "extract",
    force: bool = False,
    dry_run: bool = False,
    resume: bool = False,
    prices: DataFrame | None = None,
    models: dict[str, str] | None = None,
    prompts: dict[str, str] | None = None,
) -> DataFrame:
    """files (path, text; doi and study_id if known) through all steps into the store, and one row a file with what became of it.

    hooks are functions of frames: extract gets paper_id, prompt, tables and gives paper_id, value (and error, usages);
    structure gets paper_id, value (extract's) and gives lifecycle.STRUCTURED as JSON; figures, if there is one, gets paper_id,
    value (structure's) and the paper's figures and gives {"observations": [...]}, which are added; papers without figures
    are not asked. A hook that answers with an error ends that paper's run: its status is error, or skipped_too_large if the
    error begins with TOO_LARGE, and what the store had of it stays seen. Validation has no hook: corrections and removal of
    duplicates are validate's and dedup's, and rows that don't fit the tables' types make a run partial.

    Papers whose last run is settled are skipped unless force is set or a later from_step is: "figures" works figures and
    validation again, "validate" validation alone, both from stored artifacts (a paper that lacks one ends with an error).
    Errors are tried again by the next run. A dry run parses and names the papers, all skipped, and writes nothing. With
    resume, the last batch is taken up again if it has not ended. Duplicate papers in a batch, null or empty texts and an
    empty table of files are allowed; a file whose paper is worked on from another file is skipped.

    Returns path, paper_id, study_id, status (ok, error, skipped, too_complex), steps, cost_usd, error."""
    if from_step not in STEPS:
        raise ValueError(f"a run begins at one of {STEPS}")
    if force and from_step != "extract":
        raise ValueError("force extracts anew, so it can't begin at a later step")
    if dry_run:
        return _outcome(_jobs(files, force), None, {})
    begun, ended = _batches(spark, folder, "runs_started"), _batches(spark, folder, "extraction_runs")
    is_open = bool(begun) and begun[-1] not in ended
    number = begun[-1] if resume and is_open else max([0, *begun, *ended]) + 1
    batch = _Batch(spark, folder, number, resume and is_open)
    jobs = batch.once("articles", lambda: _jobs(files, force))
    settled = latest(spark, folder, SETTLED)

    def start() -> DataFrame:
        wanted = validate.not_processed(jobs.where("NOT again"), settled, ["paper_id"], force or from_step != "extract")
        return store.start_runs(runs(spark, folder).drop(_BATCH), wanted, models, prompts)

    started = batch.once("runs_started", start)
    try:
        return _work(spark, jobs, folder, hooks, from_step, prices, batch, started)
    except Exception as e:
        failed = started.withColumns({"status": F.lit("error"), "notes": F.lit(f"{type(e).__name__}: {e}"[:500])})
        write(failed.select(*started.columns), folder, "extraction_runs", number)
        raise


def _work(spark: SparkSession, jobs: DataFrame, folder: str, hooks: dict, from_step: str, prices: DataFrame | None, batch: _Batch, started: DataFrame) -> DataFrame:
    ids = started.select("paper_id", "run_id")
    worked = jobs.where("NOT again").join(ids, "paper_id")
    if from_step == "extract":
        extract = batch.step("extract", worked.select("paper_id", prompt_text().alias("prompt"), tables_text().alias("tables")), hooks["extract"], started)
        structure = batch.step("structure", _good(extract), hooks["structure"], started)
        asked = {"extract": extract, "structure": structure}
    else:
        extract, structure = (batch.from_before(step, started, True) for step in ("extract", "structure"))
        asked = {}
    steps = [extract, structure]
    if from_step == "validate":
        steps.append(batch.from_before("figures", started, False))
    elif "figures" in hooks:
        given = _good(structure).join(_good(extract).select("paper_id"), "paper_id", "left_semi").join(worked.where(F.size("figures") > 0).select("paper_id", "figures"), "paper_id")
        asked["figures"] = batch.step("figures", given, hooks["figures"], started)
        steps.append(asked["figures"])
    faults = reduce(DataFrame.unionByName, [s.where("error IS NOT NULL").select("paper_id", F.lit(i).alias("_i"), "error") for i, s in enumerate(steps)])
    faults = faults.groupBy("paper_id").agg(F.min_by("error", "_i").alias("error"))
    whole = _good(structure).join(faults, "paper_id", "left_anti")
    if len(steps) > 2:
        whole = _with_figures(whole, _good(steps[2]))
    got = lifecycle.structured(whole)
    got["observations"] = batch.once("resolved", lambda: got["observations"])  # read by each check and by the table
    checked = lifecycle.check(got["observations"], got["experiments"], got["panels"])
    titles = jobs.where("NOT again").select("paper_id", F.nullif("title", F.lit("")).alias("_title"))
    tables = {
        "papers": got["papers"].drop("latest_run_id").join(titles, "paper_id", "left").withColumn("title", F.coalesce("title", "_title")).join(ids.withColumnRenamed("run_id", "latest_run_id"), "paper_id"),
        "experiments": dedup.first_of_id(got["experiments"], "experiment_id", "ord", last=True),
        "panels": dedup.first_of_id(got["panels"], "panel_id", "ord", last=True),
        "observations": store.with_ids(read(spark, folder, "observations"), checked["kept"].drop("run_id").join(ids, "paper_id"), "observation_id", ["paper_id", "ord"]),
    }
    incomplete = [got["dropped"].select("paper_id")]
    for name, rows in tables.items():
        good, wrong = schema.conform(rows, name)
        good = good.join(ids, "paper_id") if name in ("experiments", "panels") else good
        batch.once(name, lambda good=good, name=name: good.select(*spark.createDataFrame([], _schema(name)).columns))
        incomplete.append(wrong.select("paper_id"))
    partial = reduce(DataFrame.unionByName, incomplete).distinct().withColumn("_partial", F.lit(True))
    usages = usage_rows(reduce(DataFrame.unionByName, [s.select("paper_id", "usages") for s in steps]), ["paper_id"])
    final = batch.once("extraction_runs", lambda: _ended(spark, started, faults, partial, checked, usages, prices))
    return _outcome(jobs, final, asked)


def _with_figures(whole: DataFrame, figures: DataFrame) -> DataFrame:
    """Structured artifacts with the observations of figures behind their own."""
    listed = lambda s: F.coalesce(s["observations"], F.array().cast(T.StructType.fromDDL(f"x {lifecycle.STRUCTURED.strip()}")["x"].dataType["observations"].dataType))
    both = whole.join(figures.select("paper_id", F.from_json("value", lifecycle.STRUCTURED).alias("_f")), "paper_id", "left").withColumn("_s", F.from_json("value", lifecycle.STRUCTURED))
    more = F.to_json(F.col("_s").withField("observations", F.concat(listed(F.col("_s")), listed(F.col("_f")))))
    return both.withColumn("value", F.when(F.col("_f").isNull(), F.col("value")).otherwise(more)).drop("_s", "_f")


def _ended(spark: SparkSession, started: DataFrame, faults: DataFrame, partial: DataFrame, checked: dict[str, DataFrame], usages: DataFrame, prices: DataFrame | None) -> DataFrame:
    prices = spark.createDataFrame([], "model string, price_in double, price_out double, ord int") if prices is None else prices
    costs = aggregate.cost_by_model(usages, prices, by=["paper_id"])
    tokens = F.to_json(F.array_sort(F.collect_list(F.struct("model", "calls", "input_tokens", "output_tokens"))))
    spent = costs.groupBy("paper_id").agg(F.round(F.sum("cost_usd"), 4).alias("_cost"), tokens.alias("_tokens"))
    report = validate.paper_reports(checked["judged"], "paper_id", "ord").select("paper_id", F.col("report").alias("_report"), F.col("corrections_applied").alias("_fixed"), F.col("human_review_items").alias("_review"))
    larger = checked["panel_sizes"].groupBy("paper_id").agg(F.count("*").alias("_larger"))
    out = started
    for part in (faults, partial, spent, report, larger):
        out = out.join(part, "paper_id", "left")
    status = F.when(F.startswith("error", F.lit(TOO_LARGE)), "skipped_too_large").when(F.col("error").isNotNull(), "error").when(F.col("_partial"), "partial").otherwise("completed")
    return out.withColumns({
        "status": status, "notes": F.col("error"), "total_cost_usd": F.coalesce("_cost", F.lit(0.0)), "token_usage": F.col("_tokens"), "validation_report": F.when(F.col("error").isNull(), _with_panels("_report", "_larger")),
        "corrections_applied": F.coalesce("_fixed", F.lit(0)), "human_review_items": F.coalesce("_review", F.lit(0)),
    })


def _with_panels(report: str, larger: str) -> Column:
    """The report with the number of panels that are larger than their parents."""
    n = F.concat(F.lit('{"panel_sizes":'), F.col(larger).cast("string"))
    rest = F.substring(F.coalesce(report, F.lit("{}")), 2, 2**31 - 1)
    return F.when(F.col(larger).isNull(), F.coalesce(report, F.lit("{}"))).otherwise(F.concat(n, F.when(rest == "}", rest).otherwise(F.concat(F.lit(","), rest))))


def _outcome(jobs: DataFrame, final: DataFrame | None, asked: dict[str, DataFrame]) -> DataFrame:
    """What became of each file. A paper's steps are those that answered without an error in this run."""
    if final is None:
        final = jobs.limit(0).select("paper_id", F.lit("").alias("status"), F.lit(0.0).alias("total_cost_usd"), F.lit("").alias("notes"))
    out = jobs.join(final.select("paper_id", F.col("status").alias("_ended"), "total_cost_usd", "notes"), "paper_id", "left")
    done = []
    for step, answers in asked.items():
        out = out.join(answers.where("error IS NULL").select("paper_id", F.lit(step).alias(f"_{step}")), "paper_id", "left")
        done.append(F.col(f"_{step}"))
    well = F.col("_ended").isin(*GOOD)
    status = F.when(F.col("_ended").isNull() | F.col("again"), "skipped").when(well, "ok").when(F.col("_ended") == "skipped_too_large", "too_complex").otherwise("error")
    steps = F.when(status == "skipped", F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*done, F.when(well, F.lit("validate")))))
    return out.select("path", "paper_id", "study_id", status.alias("status"), steps.alias("steps"), F.when(status == "skipped", 0.0).otherwise(F.col("total_cost_usd")).alias("cost_usd"), F.when(status != "skipped", F.col("notes")).alias("error"))
