"""Commands: `python -m tessera.commands run ...` and `... evaluate ...`."""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import vocab
from .operators import aggregate
from .plans import lifecycle
from .plans import run as runs
from .sources import files as sources


def documents(spark: SparkSession, folder: str | None = None, listed: str | None = None) -> DataFrame:
    """path, text, doi, study_id of a folder's documents, or of those that a job list names."""
    none = F.lit(None).cast("string")
    if folder:
        return sources.document_files(spark, folder).select("path", "text", none.alias("doi"), none.alias("study_id"))
    jobs = sources.job_list(spark, listed)
    for c in ("doi", "study_id"):
        jobs = jobs if c in jobs.columns else jobs.withColumn(c, none)
    folders = [r[0] for r in jobs.select(F.regexp_replace("file_path", r"[^/]*$", "").alias("f")).distinct().limit(10_000).collect()]
    found = sources.document_files(spark, folders) if folders else None
    if found is None:
        return jobs.select(F.col("file_path").alias("path"), none.alias("text"), "doi", "study_id")
    local = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    return jobs.join(found.select("path", "text"), local(F.col("path")) == local(F.col("file_path"))).select("path", "text", "doi", "study_id")


def evaluate(spark: SparkSession, truth_paths: str, store: str, paper: str | None = None, vocabulary: str | None = None) -> dict[str, DataFrame]:
    """lifecycle.evaluate of the store's published rows against ground-truth files, for papers that these name (or one).

    vocabulary is a file of attribute names, a few hundred, which become a literal of the plan."""
    truth = sources.ground_truth(spark, truth_paths)
    if paper:
        truth = truth.where(F.col("paper_id") == paper)
    truth = truth.withColumn("ord", F.monotonically_increasing_id())
    found = lifecycle.as_truth(runs.published(spark, store, "observations").withColumn("ord", F.col("observation_id")), runs.published(spark, store, "panels"))
    names = {r.raw: r.term for r in sources.vocabulary(spark, vocabulary).limit(10_000).collect()} if vocabulary else {}
    return lifecycle.evaluate(truth, found.join(truth.select("paper_id").distinct(), "paper_id", "left_semi"), vocab.SCORING_SUBSTANCES, names)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera")
    kinds = parser.add_subparsers(dest="command", required=True)
    r = kinds.add_parser("run", help="documents to published rows")
    given = r.add_mutually_exclusive_group(required=True)
    given.add_argument("--input-dir")
    given.add_argument("--file-list")
    r.add_argument("--store", required=True)
    r.add_argument("--hooks", required=True, help="a module with functions of frames: extract, structure and, if wanted, figures")
    r.add_argument("--from-step", choices=runs.STEPS, default="extract")
    for flag in ("force", "dry-run", "resume", "skip-figures"):
        r.add_argument(f"--{flag}", action="store_true")
    e = kinds.add_parser("evaluate", help="published rows against ground truth")
    e.add_argument("--truth", required=True)
    e.add_argument("--store", required=True)
    e.add_argument("--paper-id")
    e.add_argument("--vocabulary", help="a JSON file with mappings of attribute names")
    e.add_argument("--output-dir", help="where the scores, mismatches and unmatched rows go, as JSON")
    a = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("tessera").getOrCreate()
    if a.command == "evaluate":
        found = evaluate(spark, a.truth, a.store, a.paper_id, a.vocabulary)
        found["overall"].show(truncate=False)
        if a.output_dir:
            for name in ("overall", "breakdown", "mismatches", "unmatched"):
                found[name].write.mode("overwrite").json(f"{a.output_dir}/{name}")
        return 0
    module = importlib.import_module(a.hooks)
    hooks = {n: getattr(module, n) for n in ("extract", "structure", "figures") if hasattr(module, n) and not (n == "figures" and a.skip_figures)}
    became = runs.run(spark, documents(spark, a.input_dir, a.file_list), a.store, hooks, a.from_step, a.force, a.dry_run, a.resume)
    summary = aggregate.status_summary(became, "status", "cost_usd").orderBy("status").collect()
    for row in summary:
        print(f"{row.status}: {row.n} (${row.cost:.4f})")
    return int(any(row.status == "error" for row in summary))


if __name__ == "__main__":
    sys.exit(main())
