"""Whole reports of papers, and a run's totals from the same pass."""

import json

from pyspark.sql import Observation

from tessera.operators import validate

COLUMNS = "paper_id string, ord long, value double, value_type string, low double, high double, attribute string, panel_label string, k string"


def _judged(spark, tmp_path, rows, panels):
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/obs")
    return validate.judged(spark.read.parquet(f"{tmp_path}/obs"), spark.createDataFrame(panels, "paper_id string, panel_label string"), ["k"], "paper_id", "ord", "attribute", "panel_label")


def test_a_papers_report_and_the_runs_totals(spark, tmp_path):
    rows = [
        ("a", 1, 55.0, "raw_mean", 0.0, 9.0, "sweet", "P1", "x"),  # ten times too large
        ("a", 2, -3.0, "raw_mean", 0.0, 9.0, "Mean age", "p1", "y"),  # out of the scale, negative, another panel's name
        ("a", 3, 120.0, "frequency_pct", None, None, "sour", " ", "x"),  # over 100, a duplicate of 1
        ("a", 4, None, "raw_mean", 0.0, 9.0, None, None, None),
        ("a", 5, 500.0, "derived_param", 0.0, 9.0, "sweet", "P1", None),  # not judged, a duplicate of 4
        ("b", 1, 5.0, "raw_mean", 0.0, 9.0, "sweet", "P9", "x"),  # its paper knows no panels
        ("c", 1, 1.0, None, None, None, "bitter", None, "z"),
    ]
    totals = Observation("run")
    reports = validate.paper_reports(_judged(spark, tmp_path, rows, [("a", "P1"), ("a", "P1"), ("a", None), ("c", "P2")]), "paper_id", "ord", totals)
    got = {r.paper_id: r for r in reports.collect()}
    a = json.loads(got["a"].report)
    assert {k: a[k] for k in ("issues", "contaminated", "unknown_panels", "duplicates")} == {"issues": 4, "contaminated": 1, "unknown_panels": 1, "duplicates": 2}
    assert [(c["ord"], c["issue"], c.get("suggested_value"), c["review"]) for c in a["corrections"]] == [(1, "scale_bound_violation", 5.5, "none"), (2, "negative_value", None, "human"), (2, "scale_bound_violation", None, "model"), (3, "percentage_over_100", None, "model")]
    assert a["human_review_items"] == ["Review: negative_value at row 2"] and (got["a"].corrections_applied, got["a"].human_review_items) == (1, 1)
    assert got["b"].report == got["c"].report == "{}"
    assert totals.get == {"rows": 7, "issues": 4, "contaminated": 1, "unknown_panels": 1, "duplicates": 2}


def test_reports_read_their_rows_once(spark, tmp_path):
    reports = validate.paper_reports(_judged(spark, tmp_path, [("a", 1, 55.0, "raw_mean", 0.0, 9.0, "sweet", "P1", "x")], [("a", "P1")]), "paper_id", "ord", Observation("once"))
    plan = reports._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Python" not in plan and "NestedLoop" not in plan


def test_no_rows_no_reports(spark, tmp_path):
    assert validate.paper_reports(_judged(spark, tmp_path, [], []), "paper_id", "ord", Observation("none")).collect() == []


def test_panels_join_the_report(spark):
    from tessera.plans.run import _with_panels

    df = spark.createDataFrame([('{"issues":3}', 2), ("{}", 1), (None, 4), (None, None), ('{"issues":1}', None)], "r string, n long")
    got = [json.loads(x[0]) for x in df.select(_with_panels("r", "n")).collect()]
    assert got == [{"panel_sizes": 2, "issues": 3}, {"panel_sizes": 1}, {"panel_sizes": 4}, {}, {"issues": 1}]
