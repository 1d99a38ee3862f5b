"""Operators on small fixtures: edge cases by operator, and the loops' rewrites against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera import queries
from tessera.functions import client, nested, text, vocab
from tessera.operators import aggregate, articles, dedup, match, resolve, store, validate
from tessera.plans import lifecycle, schema
from tessera.sources import files, seeds, sinks
from tessera.streaming import ingest


def _one(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string").orderBy("i").select(f(F.col("s"))).collect()]


def test_numbers_and_flags(spark):
    given = ["1d", "1_000", "3.0", " 5 ", " 7\t", "", None, "nan", "1e3", ".5", "-", "1__0"]
    assert _one(spark, given, text.to_double) == [None, 1000.0, 3.0, 5.0, 7.0, None, None, None, 1000.0, 0.5, None, None]
    assert _one(spark, given, text.to_int) == [None, 1000, None, 5, 7, None, None, None, None, None, None, None]
    assert _one(spark, ["TRUE", " yes ", "1", "no", "", None], text.to_bool) == [True, True, True, False, False, False]
    assert _one(spark, [" a ", "\t\n", None], text.to_str) == ["a", None, None]


def test_text_functions(spark):
    assert _one(spark, ["  a\n\tb [12] c ", "[1] x"], text.clean_text) == ["a b  c", " x"]
    assert _one(spark, ["10.1016/j.foodqual.2018.01.001", "https://doi.org/doi:10.3390/nu10111632", "HTTP://DOI.ORG/10.1/A b"], text.doi_key) == ["10_1016_j_foodqual_2018_01_001", "10_3390_nu10111632", "10_1_a_b"]
    assert _one(spark, ["smith2019.html", "/x/Green_et_al_2010.pdf", ".hidden"], text.file_key) == ["smith2019", "green_et_al_2010", "hidden"]
    assert _one(spark, ["a/nutrients-10-01632-g001-550.jpg", "nutrients-10-01632-g001.png", "f_Large.gif"], text.figure_key) == ["nutrients-10-01632-g001", "nutrients-10-01632-g001", "f"]
    assert _one(spark, ["Figure 2", " FIG. 1", "Table 3", "p. 4", "", None], text.source_category) == ["figure", "figure", "table", "text", "unknown", "unknown"]
    got = _one(spark, ["0-100", "1 - 9", "-4-4", "0–10", "0-10-20", "1-", "text", None], text.scale_range)
    assert [r and tuple(r) for r in got] == [(0.0, 100.0), (1.0, 9.0), None, None, (0.0, 10.0), None, None, None]
    assert _one(spark, ["2. Materials and Methods", "Background", "Other"], text.section_name) == ["methods", "introduction", "Other"]
    assert _one(spark, ["```json\n{\"a\": 1}\n```", "so: {\"a\": 2} ok", "[1,2] x", "none"], lambda c: text.json_repair(c).cast("string")) == ['{"a":1}', '{"a":2}', "[1,2]", None]
    assert _one(spark, ["<?xml ?>", "<article dtd-version='1'>", "<html>"], text.document_kind) == ["xml", "xml", "html"]
    assert _one(spark, ["p1__exp2", "exp2"], lambda c: text.without_prefix(c, F.lit("p1"))) == ["exp2", "exp2"]
    assert _one(spark, ["exp2", None, "pilot"], lambda c: text.experiment_key(F.lit("p"), c)) == ["p__exp2", "p__exp1", "p__exppilot"]
    assert _one(spark, ["{A} and {B}"], lambda c: text.fill_template(c, {"{A}": F.lit("{B}"), "{B}": F.lit("x")})) == ["x and x"]
    assert _one(spark, ["a.JPG", "a.svg", "a"], text.media_type) == ["image/jpeg", "image/png", "image/png"]


def test_vocabulary(spark):
    m = {"sweet": "sweetness", "sour": "sourness", "acidity": "acid"}
    assert _one(spark, ["Sweet ", "sour intensity", "sweet rating", "acid", "x"], lambda c: vocab.vocabulary_term(c, m)) == ["sweetness", "sourness", "sweetness", "acid", None]
    assert _one(spark, ["Reb A", "citric  acid!", "KCl"], vocab.canonical_substance) == ["rebaudioside_a", "citric_acid", "potassium_chloride"]
    assert _one(spark, ["sucrose", "quinine", "water"], vocab.substance_category) == ["saccharide", "bitter", "other"]
    assert _one(spark, ["Sodium Chloride", "sodium_chloride", "new thing", None], lambda c: text.substance_key(c, vocab.SCORING_SUBSTANCES)) == ["sodium_chloride", "sodium_chloride", "new_thing", ""]
    df = spark.createDataFrame([(2.0, "mM", "M", None), (2.0, "g/L", "M", 4.0), (2000.0, "mg/L", "M", 4.0), (2.0, "g/L", "M", 0.0), (2.0, "x", "x", None), (2.0, "x", "y", None)], "v double, u string, t string, w double")
    assert [(r.value_converted, r.unit_converted) for r in vocab.convert_units(df, "v", "u", "t", "w").orderBy("u", "v", "w", "t").collect()] == [(None, None), (0.5, "M"), (0.002, "M"), (0.5, "M"), (2.0, "x"), (None, None)]


def test_nested(spark):
    doc = json.dumps({"demographics": {"n": 30, "age": "22±3", "sex": "60% F", "x": None}, "sensory_traits": {"training": "40h"}}, ensure_ascii=False)
    assert _one(spark, [doc, "bad", None, "[1]"], nested.flat_demographics) == ["n=30, age=22±3, sex=60% F, training=40h", "", "", ""]
    three = json.dumps([{"substance": " Sucrose ", "concentration": 5, "unit": "%"}, {"substance": "salt"}, {"substance": "x", "concentration": 1, "unit": "g"}, {}])
    got = _one(spark, [three, None], lambda c: nested.component_slots(c, F.lit("Water")))
    assert tuple(got[0]) == ("sucrose", 5.0, "%", "salt", None, None, "extra components: x@1 g; ?") and tuple(got[1]) == ("water", None, None, None, None, None, None)
    deep = json.dumps({"taste": {"sweetness": {"mean": 1}, "notes": {"a": {"mean": 2}}, "more": [{"bitterness": {"sd": 1}}]}})
    assert _one(spark, [deep, "x"], nested.attribute_names) == [["bitterness", "sweetness"], []]
    assert json.loads(_one(spark, [deep], lambda c: nested.rename_keys(c, {"sweetness": "sweet"}))[0])["taste"]["sweet"] == {"mean": 1}


PAGE = """<html><head><meta name="citation_title" content="Meta"></head><body><div class="article-body">
<h1 class="title x">A <b>title</b></h1><div class="abstract">An abstract [3].</div>
<section><h2>1. Introduction</h2><p>Enough text to be kept here.<p>More of it.</section><section><h3>Background</h3><p>This joins the introduction.</p></section>
<table class="t"><caption>Table one</caption><thead><tr><th>a</th><th>b</th></tr><tr><th>c<th>c</tr></thead><tr><td rowspan=2>1<td>2</tr><tr><td>3<td>4</tr></table>
<table><tr><td>k</td><td>v</td></tr><tr><th>x</th><td colspan="2">y</td></tr></table>
<table><tr><td>k</td><td>v</td></tr><tr><th>x</th><td colspan="2">y</td></tr></table>
<p>Before</p><figure><img src="/i/fig-g001-550.jpg"><figcaption>First</figcaption></figure><div class="fig"><img data-src="/i/fig-g001.png"></div><div class="fig toc"><img src="t.png"></div>
</div></body></html>"""


def test_articles(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<?xml version='1'?><article><title>T</title><sec><title>Results</title><p>One</p><p>two</p></sec></article>")], "id int, html string")
    got = {r.id: r for r in articles.articles(df, "html").collect()}
    r = got[1]
    assert (r.title, r.abstract, r.parse_confidence) == ("A title", "An abstract .", 0.85)
    assert [tuple(s) for s in r.sections] == [("introduction", "Enough text to be kept here. More of it. This joins the introduction.")]
    assert [(t.table_id, t.caption, t.headers, t.rows) for t in r.tables] == [("table_1", "Table one", ["c", "c"], [{"c": "2"}, {"c": "3", "col_2": "4"}]), ("table_2", "Table 2", ["k", "v"], [{"k": "x", "v": "y", "col_2": "y"}])]
    assert [tuple(f) for f in r.figures] == [("figure_1", "First", "/i/fig-g001.png", "Before")]
    assert got[2].parse_warnings == ["No sections found", "No tables found"] and got[3].source_type == "xml" and [tuple(s) for s in got[3].sections] == [("results", "One two")]


def test_pdf_text(spark):
    df = spark.createDataFrame([(1, "start\n## A\n## b \nx\n\n## B\n y\n## A\n", True, 1), (2, "## A", False, 0), (3, None, True, 0)], "id int, t string, m boolean, n int")
    df = df.withColumn("tables", F.when(F.col("n") > 0, F.array(F.lit("t"))))
    got = {r.id: r for r in articles.pdf_articles(df, "id", "t", "m", "tables").collect()}
    assert [tuple(s) for s in got[1].sections] == [("preamble", "start"), ("b", "y"), ("a", "")]
    assert [got[i].parse_confidence for i in (1, 2, 3)] == [0.7, 0.3, 0.6] and got[2].sections == []


def test_raw_tables(spark):
    df = spark.createDataFrame([(1, [[" a ", "b"], ["1", None], ["", ""]]), (2, [["", ""], ["h", "h"], ["1", "2"]]), (3, [["", ""]]), (4, [["h"]])], "id int, cells array<array<string>>")
    got = {r.id: r for r in articles.raw_tables(df).withColumn("c", articles.table_confidence()).withColumn("md", articles.table_markdown()).collect()}
    assert set(got) == {1, 2} and got[1].headers == ["a", "b"] and got[1].data == [["1", ""]] and got[1].c == 0.75 and got[2].c == 0.0  # of equal headers a row has one value
    assert got[1].md.splitlines() == ["| a | b |", "| --- | --- |", "| 1 |  |"]


def test_greedy_match_is_pairing_in_order(spark):
    rnd = random.Random(1)
    left = [(i, rnd.choice(["a", "b", None])) for i in range(40)]
    right = [(i, rnd.choice(["a", "b", None, "c"])) for i in range(40)]
    used, want = set(), []
    for i, k in left:
        j = next((j for j, m in right if m == k and j not in used), None)
        if j is not None:
            used.add(j)
            want.append((i, j))
    got = match.pair_in_order(spark.createDataFrame(left, "o int, k string"), spark.createDataFrame(right, "o int, k string"), ["k"], "o", "o")
    assert sorted((r.o, r.r_o) for r in got.collect()) == want


def test_values_and_mixtures(spark):
    df = spark.createDataFrame([(None, None), (1.0, None), (0.0, 0.0), (100.0, 101.0), (100.0, 102.0), (100.0, 110.0)], "t double, f double")
    strict, loose = match.value_test("t", "f", F.lit(False))[0], match.value_test("t", "f", F.lit(True))[0]
    assert [tuple(r) for r in df.select(strict, loose).collect()] == [(True, True), (False, False), (True, True), (True, True), (False, True), (False, True)]
    m = spark.createDataFrame([("NaCl", 1.0, "sucrose", 2.0), ("sucrose", 2.0, "salt", 1.0), ("salt", 1.0, None, None), ("salt", None, "", 3.0)], "a string, x double, b string, y double")
    keys = [r[0] for r in m.select(match.mixture_key([("a", "x"), ("b", "y")], vocab.SCORING_SUBSTANCES)).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == 3


def test_survivors(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["k", "l", None]), rnd.choice(["table", "text", "figure", "supplementary", ""])) for i in range(60)]
    rank = {"table": 4, "supplementary": 3, "text": 2, "figure": 1}
    first, gone = {}, set()
    for i, k, s in rows:
        if k in first:
            j = first[k]
            gone.add(j if rank.get(s, 0) > rank.get(rows[j][2], 0) else i)
        else:
            first[k] = i
    df = spark.createDataFrame(rows, "i int, k string, s string")
    got = {r.i for r in dedup.survivors(df, ["k"], "i", dedup.source_rank("s")).collect()}
    assert got == {i for i, *_ in rows} - gone
    assert dedup.survivors(df, ["k"], "i", dedup.source_rank("s"), "best").count() == 3
    assert {r.i for r in dedup.first_of_id(df, "k", "i").collect()} == set(first.values())


def test_checks(spark):
    obs = spark.createDataFrame([(1, 55.0, "raw_mean", 0.0, 10.0), (2, -1.0, "raw_mean", 0.0, 10.0), (3, 120.0, "frequency_pct", None, None), (4, 99.0, "derived_param", 0.0, 1.0), (5, None, "raw_mean", 0.0, 1.0), (6, 200.0, "raw_mean", 0.0, 15.0)], "id int, value double, value_type string, low double, high double")
    got = sorted((r.id, r.issue, r.suggested_value, r.review) for r in validate.range_issues(obs).collect())
    assert got == [(1, "scale_bound_violation", 5.5, "none"), (2, "negative_value", None, "human"), (2, "scale_bound_violation", None, "model"), (3, "percentage_over_100", None, "model"), (6, "scale_bound_violation", None, "model")]
    fixed = validate.apply_corrections(obs, validate.range_issues(obs), "id")
    assert {r.id: r.value for r in fixed.collect()}[1] == 5.5
    assert validate.to_correct(validate.range_issues(obs), 2).count() == 0 and validate.to_correct(validate.range_issues(obs)).count() == 3
    assert _one(spark, ["beverage liking", "sage", "sweet", None], validate.contaminated) == [True, True, False, False]
    assert _one(spark, ["beverage", "mean age"], lambda c: validate.contaminated(c, whole_words=True)) == [False, True]


def test_references(spark):
    panels = spark.createDataFrame([("p", "child", "root", "c", 1), ("p", "root", None, "r", 2), ("p", "late", "child2", "l", 3), ("p", "child2", "late", "c2", 4)], "g string, label string, parent string, key string, o int")
    assert {r.key: r.parent_key for r in resolve.parents(panels, "g", "label", "parent", "key", "o").collect()} == {"r": None, "c": "r", "l": None, "c2": "l"}
    known = spark.createDataFrame([("p", "A")], "paper_id string, panel_label string")
    df = spark.createDataFrame([("p", "A"), ("p", "B"), ("p", " "), ("q", "B")], "paper_id string, panel_label string")
    assert [tuple(r) for r in validate.unknown_reference(df, known, ["paper_id", "panel_label"], "panel_label").collect()] == [("p", "B")]
    figs = spark.createDataFrame([("p", "figure_1", 1), ("p", "fig", 2)], "g string, f string, o int")
    obs = spark.createDataFrame([(1, "p", "see Figure_1"), (2, "p", "text"), (3, "q", "fig")], "id int, g string, loc string")
    assert {r.id: r.figure_found for r in resolve.figure_of(obs, figs, "g", "loc", "f", "o", "id").collect()} == {1: "figure_1", 2: None, 3: None}
    assert _one(spark, ["Figure 1", "Fig. 2", "figure_3"], resolve.figure_id) == ["figure_1", "figure_2", "figure_3"]


def test_store(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None)], "k int, s string, v double")
    new = spark.createDataFrame([(2, None, 5.0, 1), (2, "z", None, 2), (3, "c", 3.0, 1)], "k int, s string, v double, o int")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(store.upsert(old, new, "k", "o")) == [(1, "a", 1.0), (2, "z", None), (3, "c", 3.0)]
    assert rows(store.upsert(old, new.where("o = 1"), "k", "o", True)) == [(1, "a", 1.0), (2, "b", 5.0), (3, "c", 3.0)]
    once = store.replace(old, new, "k", "o")
    assert rows(once) == rows(store.replace(once, new, "k", "o")) == [(1, "a", 1.0), (2, "z", None), (3, "c", 3.0)]
    assert rows(store.insert_missing(old, new, "k", "o")) == [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)]
    ids = store.with_ids(old, spark.range(50).select(F.col("id").alias("x")), "k", ["x"])
    assert sorted((r.x, r.k) for r in ids.collect()) == [(i, i + 3) for i in range(50)]
    listed = spark.createDataFrame([(9, ["q"])], "k int, s array<string>")
    assert rows(store.append(old, listed, {"v": 0.0}))[-1] == (9, '["q"]', 0.0)


def test_costs_and_samples(spark):
    usage = spark.createDataFrame([("m-1", 10**6, 0), ("m-1", 0, 10**6), ("other", 10**6, 0)], "model string, input_tokens long, output_tokens long")
    prices = spark.createDataFrame([("m", 1.0, 2.0, 0), ("m-1-long", 5.0, 5.0, 1)], "model string, price_in double, price_out double, ord int")
    assert {r.model: (r.calls, r.cost_usd) for r in aggregate.cost_by_model(usage, prices).collect()} == {"m-1": (2, 3.0), "other": (1, 3.0)}
    df = spark.range(30)
    assert aggregate.sample_share(df, 0.2, F.col("id")).count() == 6 and aggregate.sample_share(df.limit(2), 0.2, F.col("id")).count() == 1


def test_files(spark, tmp_path):
    (tmp_path / "a.HTML").write_bytes("é".encode("latin-1"))
    (tmp_path / "b.pdf").write_text("x")
    (tmp_path / ".c.html").write_text("x")
    (tmp_path / "d.txt").write_text("x")
    got = sorted((r.path.rsplit("/", 1)[1], r.text, r.kind) for r in files.document_files(spark, str(tmp_path)).collect())
    assert got == [("a.HTML", "é", "html"), ("b.pdf", "x", "pdf")]
    (tmp_path / "jobs.csv").write_text("file_path,doi,study_id\n a.html ,10.1/x,s\n,y,z\n/abs/b.pdf,,\n")
    jobs = [r.file_path for r in files.job_list(spark, str(tmp_path / "jobs.csv")).collect()]
    assert jobs[0].endswith(f"{tmp_path}/a.html") and jobs[1] == "/abs/b.pdf"
    (tmp_path / "v.json").write_text('{"version": "1",\n "mappings": {"sweet": "sweetness"}}')
    assert [tuple(r) for r in files.vocabulary(spark, str(tmp_path / "v.json")).collect()] == [("sweet", "sweetness")]
    row = {c: None for c, _ in files.TRUTH} | {"paper_id": None, "experiment": "exp1", "is_control": True, "value": 1.5, "attribute": "sweet"}
    types = ", ".join(f"{c} {t}" for c, t in files.TRUTH)
    sinks.write_ground_truth(spark.createDataFrame([tuple(row[c] for c, _ in files.TRUTH)], types).coalesce(1), str(tmp_path / "truth"))
    back = files.ground_truth(spark, str(tmp_path / "truth")).first()
    assert back.is_control is True and back.value == 1.5 and back.unit_1 is None and back.paper_id.startswith("part-")


def test_stream_into_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    columns = "k int, s string"
    change = lambda old, new: store.upsert(old, new, "k") if old is not None else new
    for n, rows in enumerate(([{"k": 1, "s": "a"}, {"k": 2, "s": "b"}], [{"k": 2, "s": "c"}])):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(map(json.dumps, rows)))
        ingest.into_table(ingest.file_stream(spark, str(tmp_path / "in"), columns), str(tmp_path / "t"), change, str(tmp_path / "cp")).awaitTermination()
    assert sorted(map(tuple, ingest.current(spark, str(tmp_path / "t")).collect())) == [(1, "a"), (2, "c")]


def test_lifecycle(spark):
    artifact = {
        "paper": {"doi": "10.1/x", "title": "T", "year": 2020, "journal": "J"},
        "experiments": [{"experiment": "exp1", "label": "L", "scale_range": "0-10"}],
        "panels": [{"panel_label": "full", "experiment": "exp1", "panel_size": 10}, {"panel_label": "sub", "experiment": "exp1", "parent_panel_label": "full", "panel_size": 12}],
        "observations": [
            {"experiment": "exp1", "panel_label": "sub", "substance": "NaCl", "components": [{"substance": "NaCl", "concentration": "1", "unit": "M"}], "is_control": False, "attribute": "salty", "value": 55.0, "value_type": "raw_mean", "source": "Table 1", "source_type": "table"},
            {"experiment": "exp1", "panel_label": "other", "substance": "x", "attribute": "age", "value": 1.0, "value_type": "raw_mean", "source": "Table 1", "source_type": "text"},
            {"experiment": "exp9", "substance": "x", "attribute": "sour", "value": 1.0, "value_type": "raw_mean"},
        ],
    }
    parts = lifecycle.structured(spark.createDataFrame([("p", json.dumps(artifact))], "paper_id string, value string"))
    assert parts["dropped"].count() == 1
    placed = {r.attribute_raw: (r.panel_id, r.fell_back) for r in parts["observations"].collect()}
    assert placed == {"salty": ("p__panel_sub", False), "age": ("p__panel_full", True)}
    checked = lifecycle.check(parts["observations"], parts["experiments"], parts["panels"])
    assert [r.suggested_value for r in checked["issues"].collect()] == [5.5] and checked["contaminated"].count() == 1 and checked["panel_sizes"].count() == 1
    assert {r.attribute_raw: r.value for r in checked["corrected"].collect()}["salty"] == 5.5
    found = lifecycle.as_truth(parts["observations"], parts["panels"])
    result = lifecycle.evaluate(found.withColumn("value", F.col("value") * 1.005), found, vocab.SCORING_SUBSTANCES, {"salty": "saltiness"})
    assert tuple(result["overall"].select("precision", "recall", "f1", "n_correct").first()) == (1.0, 1.0, 1.0, 2)
    assert {(r.dimension, r.key) for r in result["breakdown"].collect()} >= {("source", "table"), ("panel", "sub"), ("attribute", "salty")}


def test_schema_and_seeds(spark, tmp_path):
    schema.create_missing(spark, str(tmp_path))
    schema.create_missing(spark, str(tmp_path))
    substances = seeds.seed_substances(spark.read.parquet(f"{tmp_path}/substances"))
    assert substances.count() == seeds.seed_substances(substances).count() == 19 and substances.select("substance_id").distinct().count() == 19
    aliases = seeds.seed_aliases(spark.read.parquet(f"{tmp_path}/substance_aliases"), substances)
    assert aliases.count() == seeds.seed_aliases(aliases, substances).count() == sum(map(len, seeds.ALIASES.values()))
    good, bad = schema.conform(spark.createDataFrame([("1", "p", "2.5"), ("2", "q", "x")], "observation_id string, paper_id string, value string"), "observations")
    assert [(r.observation_id, r.value, r.measurement_domain, r.is_control) for r in good.collect()] == [(1, 2.5, "sensory", False)] and bad.first().value == "x"
    schema.write(good, str(tmp_path), "observations")
    schema.write(good.withColumn("paper_id", F.lit("z")), str(tmp_path), "observations")
    assert spark.read.parquet(f"{tmp_path}/observations").count() == 2


def test_hooks(spark):
    df = spark.createDataFrame([("p", 2, 1.0), ("p", 1, 5.0)], "p string, o int, v double")
    got = validate.ask_in_order(df, "p", "o", lambda pdf: pdf.assign(v=pdf.v.cumsum()), "p string, o int, v double")
    assert {r.o: r.v for r in got.collect()} == {1: 5.0, 2: 6.0}
    assert [r.v for r in validate.ask(df, lambda pdf: pdf[["v"]] * 2, "v double").orderBy("v").collect()] == [2.0, 10.0]
    assert [tuple(r) for r in vocab.unmapped_terms(spark.createDataFrame([("New ",), ("new",), ("sweet",)], "a string"), "a", {"sweet": "s"}).collect()] == [("new", 2)]


def test_counts_of_all_tables(spark, sf_dir):
    import os

    got = {r["table"]: r.n for r in queries.queries()["table_counts"](spark, sf_dir).collect()}
    assert sorted(got) == sorted(f.split(".")[0] for f in os.listdir(sf_dir))
    assert all(n == spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t, n in got.items())


def test_sections_of_whole_texts(spark, tmp_path):
    texts = ["one\n two \n\n## four\n\tfive\n", None, "", "\n".join(f"line {i}" for i in range(300))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.queries()["markdown_sections"](spark, str(tmp_path)).collect()))
    assert got == [(d, i, f"part {i}", x.strip()) for d, t in enumerate(texts) if t is not None for i, x in enumerate(t.split("\n"), 1)]


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_agree_with_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    import os

    got = queries.queries()[name](spark, sf_dir)
    rows = got.collect()
    if sql := queries.oracle_sql().get(name):
        con = duckdb.connect()
        for f in os.listdir(sf_dir):
            con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
        out = con.sql(sql)
        plain = lambda v: v if not isinstance(v, float) else float(f"{v:.9g}")
        want = sorted((tuple(plain(r[out.columns.index(c)]) for c in got.columns) for r in out.fetchall()), key=repr)
        assert sorted((tuple(map(plain, r)) for r in rows), key=repr) == want
    assert rows


def test_the_store_gets_all_of_an_observation(spark):
    obs = {"experiment": "exp2", "panel_label": "odd", "measurement_domain": "psychological", "substance": "NaCl", "components": [{"substance": "NaCl", "concentration": "1", "unit": None}], "base_matrix": "water", "is_control": True, "attribute": "salty", "attribute_normalized": "saltiness", "value": 5.5, "value_type": "raw_mean", "error": 0.5, "error_type": "SD", "source": "Table 1", "source_type": "table", "confidence": "high"}
    panels = [{"panel_label": "fuller", "experiment": "exp2", "parent_panel_label": "main"}, {"panel_label": "main", "experiment": "exp2", "parent_panel_label": ""}, {"panel_label": "x", "experiment": ""}]
    artifact = {"context": {"panels": {"n": 1}}, "paper": {"title": "T"}, "experiments": [{"experiment": "exp2", "label": "L"}], "panels": panels, "observations": [obs, {"value": 1.0}]}
    parts = lifecycle.structured(spark.createDataFrame([("p", json.dumps(artifact))], "paper_id string, value string"), run_id=3)
    good, bad = schema.conform(parts["observations"], "observations")
    row = good.first().asDict()
    assert bad.count() == 0 and good.count() == 1 and parts["dropped"].count() == 1
    want = {"paper_id": "p", "experiment_id": "p__exp2", "panel_id": "p__panel_main", "measurement_domain": "psychological", "substance_name": "NaCl", "components_json": '[{"substance":"NaCl","concentration":"1","unit":null}]', "base_matrix": "water", "is_control": True, "attribute_raw": "salty", "attribute_normalized": "saltiness", "value": 5.5, "value_type": "raw_mean", "error_value": 0.5, "error_type": "SD", "source_type": "table", "source_location": "Table 1", "extraction_confidence": "high", "run_id": 3}
    assert {k: row[k] for k in want} == want and len(want) == 18
    assert schema.conform(parts["papers"], "papers")[0].first()["context_json"] == '{"panels":{"n":1}}'
    assert {r.panel_label: r.parent_panel_id for r in parts["panels"].collect()} == {"fuller": "p__panel_main", "main": None, "x": None}


def test_runs(spark):
    runs = schema.conform(spark.createDataFrame([(4, "a", "completed")], "run_id long, paper_id string, status string"), "extraction_runs")[0]
    new = store.start_runs(runs, spark.createDataFrame([("b",), ("c",)], "paper_id string"), {"m": "1"}, {"agent1": "v2"})
    rows = {r.paper_id: r for r in new.collect()}
    assert (rows["b"].run_id, rows["c"].run_id) == (5, 6) and rows["b"].agent1_prompt_version == "v2" and rows["b"].agent2_prompt_version is None and rows["b"].status == "in_progress" and rows["b"].corrections_applied == 0 and json.loads(rows["b"].model_versions) == {"m": "1"}
    done = store.finish_run(new, 5, status="completed", token_usage={"in": 3}, paper_id="z").where("run_id = 5").first()
    assert (done.status, done.token_usage, done.paper_id) == ("completed", '{"in": 3}', "b")


def test_xml_figures(spark):
    page = '<?xml version="1.0"?><article><fig id="f1"><label>Fig. 1</label><caption><p>One</p></caption><graphic xlink:href="a.tif"/></fig><fig/></article>'
    got = articles.articles(spark.createDataFrame([(1, page)], "id int, html string"), "html").first().figures
    assert [(f.figure_id, f.caption, f.image_url) for f in got] == [("figure_1", "One", "a.tif"), ("figure_2", "Figure 2", "")]


def test_xml_is_read_as_xml(spark):
    """Marked sections are text, and names that HTML gives to empty or muted elements hold text like others."""
    page = '<?xml version="1.0"?><article><title>T <![CDATA[& <b>]]> u</title><abstract><p><![CDATA[Some text here]]> tail</p></abstract><sec><title>Methods</title><p>a<source>b</source>c<p>inner <col>d</col></p> e</p></sec></article>'
    got = articles.articles(spark.createDataFrame([(1, page), (2, "<p>x<![CDATA[gone]]>y")], "id int, html string"), "html").orderBy("id").collect()
    assert got[0].title == "T & <b> u" and got[0].abstract == "Some text here tail"
    assert [(s.name, s.text) for s in got[0].sections] == [("methods", "abcinner d e inner d")]


def test_wide_tables(spark):
    """Rows of every length against headers that are equal, blank or named like cells beyond them, against plain dictionaries."""
    import random

    rng, tables = random.Random(1), []
    for i in range(60):
        headers = [rng.choice(["a", "b", "c", "", "col_2", "col_5", "col_05"]) for _ in range(rng.choice([1, 3, 6]))]
        tables.append((i, [headers] + [[rng.choice(["1", "2", ""]) for _ in range(rng.choice([0, 1, 3, 6, 8]))] for _ in range(4)]))
    got = {r.id: (r.headers, r.data, r.c) for r in articles.raw_tables(spark.createDataFrame(tables, "id int, cells array<array<string>>")).withColumn("c", articles.table_confidence()).collect()}
    for i, (headers, *rows) in tables:
        if not any(headers):
            headers, *rows = rows
        as_map = lambda row, h=headers: {h[k] if k < len(h) else f"col_{k}": v for k, v in enumerate(row)}
        data = [r for r in rows if any(as_map(r).values())]
        assert (i in got) == bool(headers and data)
        if i in got:
            full, maps = [h for h in headers if h], [as_map(r) for r in data]
            cells = [v for m in maps for v in m.values()]
            want = 0.0
            if full:
                want = (0.5 * len(full) / len(headers) + 0.5 * len(set(full)) / len(full)) * sum(len(m) == len(headers) for m in maps) / len(maps) * (0.5 + 0.5 * (sum(map(bool, cells)) / len(cells) if cells else 0))
            assert got[i][:2] == (headers, data) and abs(got[i][2] - want) < 0.001
    wide = spark.createDataFrame([(1, [[f"h{k % 35}" for k in range(40)]] + [[str(k) for k in range(40)]] * 400)], "id int, cells array<array<string>>")
    assert articles.raw_tables(wide).select(articles.table_confidence().alias("c")).first().c == 0.0


def test_table_bounds(spark):
    wide = articles.table_grid(articles.Page("<table><tr><th>a<tr><td colspan=1000000000>x</table>").root.first("table"))[1]
    assert len(wide[0]) == 1000
    df = spark.createDataFrame([(3, 2, [["h", "i"], ["\t\n", "\u00a0"], ["1", "\t"]])], "n int, page int, cells array<array<string>>")
    got = articles.raw_tables(df, table_id="n").withColumn("c", articles.table_confidence()).first()
    assert got.data == [["1", ""]] and got.c == 0.75 and (got.table_id, got.caption) == ("table_3", "Table 3 (page 2)")


def test_texts_for_models(spark):
    rows = [(1, "T", "", [("Materials", "m"), ("Results", "r")], [("C", ["a", "b"], [{"a": "1"}]), ("D", [], [])]), (2, None, "x", [], [])]
    kind = "id int, title string, abstract string, sections array<struct<name:string,text:string>>, tables array<struct<caption:string,headers:array<string>,rows:array<map<string,string>>>>"
    a = spark.createDataFrame(rows, kind)
    got = a.orderBy("id").select(articles.prompt_text(), articles.joined_sections(), articles.section_text("RESULT"), articles.tables_text(none="(none)")).collect()
    assert tuple(got[0]) == ("TITLE: T\n\nMATERIALS:\nm\n\nRESULTS:\nr", "m", "r", "**C**\n\n| a | b |\n| --- | --- |\n| 1 |  |")
    assert tuple(got[1]) == ("\nABSTRACT:\nx", "", "", "(none)")
    assert _one(spark, ["a/b.TIF?x=.gif", "a.jpg/b", ""], text.extension) == [".tif", ".png", ".png"]


def test_open_columns_go_into_context(spark):
    papers = spark.createDataFrame([("p", "NL", '{"a": [1]}', "t"), ("q", None, None, "u"), ("r", None, "{bad", "v")], "paper_id string, country string, context_json string, title string")
    experiments = spark.createDataFrame([("p", "e1", 3, None), ("p", "e2", None, None), ("q", "e3", None, '{"t": null}')], "paper_id string, experiment_id string, panel_size int, conditions_json string")
    stimuli = spark.createDataFrame([("p", 1, "salt", "X"), ("p", 2, "salt", "Y"), ("p", 3, "sugar", None)], "paper_id string, stimulus_id int, substance_name string, supplier string")
    got = {r.paper_id: r.context_json and json.loads(r.context_json) for r in resolve.open_context(papers, experiments, stimuli).collect()}
    assert got == {
        "p": {"country": "NL", "context_json": {"a": [1]}, "experiments": {"e1": {"panel_size": 3}}, "substance_sourcing": {"salt": {"supplier": "Y"}}},
        "q": {"experiments": {"e3": {"conditions_json": {"t": None}}}},
        "r": {"context_json": "{bad"},
    }
    assert resolve.open_context(papers.where("paper_id = 'q'"), experiments.limit(0), None).first().context_json is None


def test_summaries(spark):
    value = json.dumps({"experiments": [{"experiment": "exp1", "method": "QDA"}], "observations": [{"substance": "salt", "components": [{"substance": "salt", "concentration": "2"}], "attribute": "salty", "value": 1.5}]})
    got = {r.paper_id: (json.loads(r.observations), json.loads(r.experiments)) for r in lifecycle.summaries(spark.createDataFrame([("p", value), ("q", "{}")], "paper_id string, value string")).collect()}
    assert got["p"] == ([{"substance": "salt", "concentration": "2", "attribute": "salty", "value": 1.5, "value_type": "", "source": ""}], [{"experiment": "exp1", "method": "QDA", "scale_type": None, "scale_range": None}])
    assert got["q"] == ([], [])


def test_patient_client():
    waits, said = [], []

    def send(messages):
        said.append(len(messages))
        if len(said) <= 2:
            raise ValueError("rate_limit" if len(said) == 1 else "broken")
        return ("```json\n[1,\n```", True, 5) if len(said) == 3 else ("```json\n2]\n```", False, 7)

    assert client.patient(send, wait=waits.append)("x") == ("```json\n[1,2]", [5, 7])
    assert waits == [5.0, 5.0] and said == [1, 1, 1, 3]

    def never(messages):
        raise ValueError("overloaded")

    waits.clear()
    with pytest.raises(RuntimeError):
        client.patient(never, wait=waits.append)("x")
    assert waits == [5.0, 10.0, 20.0]
