"""The run command, the commands around it, and the patient client's parts."""

import json
import sys
import types

import pytest
from pyspark.sql import functions as F

from tessera import commands
from tessera.functions import client
from tessera.operators import aggregate
from tessera.plans import run as runs

ARTIFACT = {
    "experiments": [{"experiment": "exp1", "scale_range": "0-100"}, {"experiment": "exp1", "scale_range": "0-10"}],
    "observations": [
        {"experiment": "exp1", "substance": "salt", "attribute": "salty", "value": 55.0, "value_type": "raw_mean", "source_type": "table"},
        {"experiment": "exp1", "substance": "sugar", "attribute": "sweet", "value": -3.0, "value_type": "raw_mean", "source_type": "table"},
        {"experiment": "exp9", "substance": "lost", "value": 1.0},
    ],
}
FIGURES = {"observations": [{"experiment": "exp1", "substance": "acid", "attribute": "sour", "value": 4.5, "value_type": "raw_mean", "source_type": "figure"}]}
PAGE = '<html><body><h1 class="title">T</h1><figure id="f1"><img src="f1.png"><figcaption>Figure 1. Taste.</figcaption></figure></body></html>'


def hooks(asked, broken=(), artifact=ARTIFACT, figures=None):
    def extract(df):
        asked.append("extract")
        usage = F.array(F.struct(F.lit("m").alias("model"), F.lit(1_000_000).cast("long").alias("input_tokens"), F.lit(0).cast("long").alias("output_tokens")))
        error = F.when(F.col("paper_id").isin(*broken), "broken").when(F.col("paper_id") == "large", "too large by far")
        return df.select("paper_id", F.lit("{}").alias("value"), error.alias("error"), usage.alias("usages"))

    def structure(df):
        asked.append("structure")
        return df.where("paper_id <> 'silent'").select("paper_id", F.lit(json.dumps(artifact)).alias("value"))

    def read_figures(df):
        asked.append("figures")
        return df.select("paper_id", F.lit(json.dumps(figures)).alias("value"))

    return {"extract": extract, "structure": structure, **({"figures": read_figures} if figures else {})}


def outcome(df):
    return {r.path: (r.status, r.steps, r.error) for r in df.collect()}


def rows(spark, folder):
    return {tuple(r) for r in runs.published(spark, folder, "observations").select("paper_id", "substance_name", "value", "run_id").collect()}


def files(spark, *names):
    return spark.createDataFrame([(n, PAGE) for n in names], "path string, text string")


def test_a_second_run_changes_nothing_and_errors_are_tried_again(spark, tmp_path):
    store, asked = f"file://{tmp_path}/store", []
    given = files(spark, "/in/a.html", "/in/b.html", "/more/a.html", "/in/large.html", "/in/silent.html")
    first = outcome(runs.run(spark, given, store, hooks(asked, broken=["b"])))
    assert first == {
        "/in/a.html": ("ok", ["extract", "structure", "validate"], None), "/more/a.html": ("skipped", [], None), "/in/b.html": ("error", [], "broken"),
        "/in/large.html": ("too_complex", [], "too large by far"), "/in/silent.html": ("error", ["extract"], "structure: no answer"),
    }
    seen = rows(spark, store)
    assert {(s, v) for _, s, v, _ in seen} == {("salt", 5.5), ("sugar", -3.0)}  # the last of two scales counts
    status = {r.paper_id: r for r in runs.runs(spark, store).collect()}
    assert {p: r.status for p, r in status.items()} == {"a": "partial", "b": "error", "large": "skipped_too_large", "silent": "error"}
    assert (status["a"].corrections_applied, status["a"].human_review_items, status["a"].total_cost_usd) == (1, 1, 3.0)
    assert json.loads(status["a"].token_usage)[0]["input_tokens"] == 1_000_000 and json.loads(status["a"].validation_report)["issues"] == 3
    assert {p: s for p, (s, *_) in outcome(runs.run(spark, given, store, hooks(asked))).items()} == {"/in/a.html": "skipped", "/more/a.html": "skipped", "/in/b.html": "ok", "/in/large.html": "skipped", "/in/silent.html": "error"}
    assert {r for r in rows(spark, store) if r[0] == "a"} == seen


def test_force_replaces_and_dry_runs_write_nothing(spark, tmp_path):
    store, asked = f"file://{tmp_path}/store", []
    assert {s for s, *_ in outcome(runs.run(spark, files(spark, "/a.html"), store, hooks(asked), dry_run=True)).values()} == {"skipped"}
    assert not (tmp_path / "store").exists() and asked == []
    runs.run(spark, files(spark, "/a.html"), store, hooks(asked))
    other = {**ARTIFACT, "observations": ARTIFACT["observations"][:1]}
    runs.run(spark, files(spark, "/a.html"), store, hooks(asked, artifact=other), force=True)
    assert {r[1] for r in rows(spark, store)} == {"salt"}
    assert len({r.observation_id for r in runs.read(spark, store, "observations").collect()}) == 3
    with pytest.raises(ValueError):
        runs.run(spark, files(spark, "/a.html"), store, {}, from_step="figures", force=True)
    with pytest.raises(ValueError):
        runs.run(spark, files(spark, "/a.html"), store, {}, from_step="structure")


def test_later_steps_read_artifacts(spark, tmp_path):
    store, asked = f"file://{tmp_path}/store", []
    assert outcome(runs.run(spark, files(spark, "/a.html"), store, hooks(asked, figures=FIGURES)))["/a.html"][1] == ["extract", "structure", "figures", "validate"]
    assert {r[1] for r in rows(spark, store)} == {"salt", "sugar", "acid"}
    asked.clear()
    late = {"observations": [{**FIGURES["observations"][0], "substance": "bitter"}]}
    became = outcome(runs.run(spark, files(spark, "/a.html", "/new.html"), store, hooks(asked, figures=late), from_step="figures"))
    assert became == {"/a.html": ("ok", ["figures", "validate"], None), "/new.html": ("error", [], "extract: missing artifact")}
    assert asked == ["figures"] and {r[1] for r in rows(spark, store)} == {"salt", "sugar", "bitter"}
    assert outcome(runs.run(spark, files(spark, "/a.html"), store, {}, from_step="validate"))["/a.html"] == ("ok", ["validate"], None)
    assert {r[1] for r in rows(spark, store)} == {"salt", "sugar", "bitter"}


def test_a_stopped_batch_goes_on_where_it_was(spark, tmp_path):
    store, asked = f"file://{tmp_path}/store", []

    def stops(df):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        runs.run(spark, files(spark, "/a.html"), store, {**hooks(asked), "structure": stops})
    assert [r.status for r in runs.runs(spark, store).collect()] == ["in_progress"] and rows(spark, store) == set()
    became = outcome(runs.run(spark, files(spark, "/a.html"), store, hooks(asked), resume=True))
    assert became["/a.html"][0] == "ok" and asked == ["extract", "structure"]  # extract was asked once
    assert [(r.run_id, r.status) for r in runs.runs(spark, store).collect()] == [(1, "partial")]


def test_a_failed_step_leaves_status_error(spark, tmp_path):
    store, asked = f"file://{tmp_path}/store", []
    runs.run(spark, files(spark, "/a.html"), store, hooks(asked))
    seen = rows(spark, store)

    def fails(df):
        raise OSError("no disk")

    with pytest.raises(OSError):
        runs.run(spark, files(spark, "/a.html"), store, {**hooks(asked), "structure": fails}, force=True)
    assert {r.run_id: (r.status, r.notes) for r in runs.runs(spark, store).collect()}[2] == ("error", "OSError: no disk")
    assert rows(spark, store) == seen  # what was there is still seen


def test_nothing_to_run(spark, tmp_path):
    store = f"file://{tmp_path}/store"
    assert outcome(runs.run(spark, spark.createDataFrame([], "path string, text string"), store, hooks([]))) == {}
    assert rows(spark, store) == set()


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.html").write_text(PAGE)
    (tmp_path / "in/b.html").write_text(PAGE)
    (tmp_path / "jobs.csv").write_text("file_path,doi,study_id\nin/a.html,10.1/x,S1\n")
    module = sys.modules["hooks_of_a_test"] = types.ModuleType("hooks_of_a_test")
    module.__dict__.update(hooks([], broken=["b"]))
    store = f"file://{tmp_path}/store"
    assert commands.main(["run", "--file-list", str(tmp_path / "jobs.csv"), "--store", store, "--hooks", "hooks_of_a_test"], spark) == 0
    assert commands.main(["run", "--input-dir", str(tmp_path / "in"), "--store", store, "--hooks", "hooks_of_a_test"], spark) == 1
    assert "error: 1" in capsys.readouterr().out
    assert {r[0] for r in rows(spark, store)} == {"10_1_x", "a"}
    (tmp_path / "truth.csv").write_text("paper_id,experiment,measurement_domain,panel_label,panel_size,panel_demographics,substance_1,concentration_1,unit_1,substance_2,concentration_2,unit_2,base_matrix,is_control,attribute,value,value_type,error,error_type,source_type,source_location,notes\na,exp1,sensory,,,,salt,,,,,,,FALSE,salty,5.5,raw_mean,,,table,,\n")
    assert commands.main(["evaluate", "--truth", str(tmp_path / "truth.csv"), "--store", store, "--output-dir", f"{tmp_path}/out"], spark) == 0
    overall = spark.read.json(f"{tmp_path}/out/overall").first()
    assert overall.n_truth == 1 and overall.n_found == 2 and overall.recall == 1.0


def test_fences_and_pauses():
    assert client.without_closing_fence("a\n```  \n") == "a" and client.without_closing_fence("a`` `") == "a`` `"
    assert client.without_opening_fence("```json\nx\ny") == "x\ny" and client.without_opening_fence("```\nx") == "x"
    assert client.without_opening_fence("```python\nx") == "```python\nx" and client.without_opening_fence("```json") == "```json"
    assert [client.pause_after(ValueError("Overloaded"), n, 5.0) for n in (1, 2, 3)] == [(5.0, True), (10.0, True), (20.0, True)]
    assert client.pause_after(ValueError("x"), 3, 5.0) == (5.0, False)


def test_a_service_that_stays_busy_is_named_as_the_cause():
    def busy(messages):
        raise ValueError("rate_limit")

    def broken(messages):
        raise KeyError("x")

    with pytest.raises(RuntimeError) as told:
        client.patient(busy, wait=lambda s: None)("x")
    assert isinstance(told.value.__cause__, ValueError)
    with pytest.raises(KeyError):
        client.patient(broken, wait=lambda s: None)("x")


def test_usages_become_costs(spark):
    answers = spark.createDataFrame([("p", [("m", 1_000_000, 0), (None, None, 1_000_000)]), ("q", None), ("r", [])], f"paper_id string, usages array<{client.USAGE}>")
    prices = spark.createDataFrame([("m", 1.0, 2.0, 0)], "model string, price_in double, price_out double, ord int")
    got = aggregate.cost_by_model(client.usage_rows(answers, ["paper_id"]), prices, by=["paper_id"])
    assert {(r.paper_id, r.model, r.calls, r.cost_usd) for r in got.collect()} == {("p", "m", 1, 1.0), ("p", "", 1, 2.0)}
