"""Stateful streams, Python data sources, picture status, and DDL on catalog tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import figures
from tessera.plans import ddl, schema
from tessera.sources import python_sources
from tessera.streaming import ingest, stateful

RUNS = "run string, status string, ts timestamp, n long"
DAY = dt.datetime(2024, 5, 1)


def at(minute):
    return DAY + dt.timedelta(minutes=minute)


def put(spark, folder, name, rows):
    spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    return f"{folder}/{name}"


def test_attempts_over_restarts_timers_and_late_rows(spark, tmp_path):
    """Three starts of one query, a file each: state and timers go on; a row behind the watermark is left out."""
    stateful.use_rocksdb(spark)
    found = []
    for n, rows in enumerate([
        [("a", "in_progress", at(0), 1), ("b", "in_progress", at(1), 1), ("c", "in_progress", at(2), 1), ("a", "in_progress", at(20), 2), (None, "error", at(3), 9), ("d", "in_progress", None, 9)],
        [("a", "completed", at(40), 3), ("b", "in_progress", at(50), 2), ("e", "error", at(180), 1)],
        [("c", "completed", at(10), 2), ("a", "in_progress", at(200), 4)],
    ]):
        put(spark, f"{tmp_path}/in", "rows", rows)
        stream = spark.readStream.schema(RUNS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/rows")
        out = stateful.attempts(stream, "run", "status", "ts", "n", dt.timedelta(minutes=30), "10 minutes")
        rows = stateful.to_the_end(out, f"{tmp_path}/out").collect()
        found.append({(r.run, r.status, r.started, r.ended, r.events) for r in rows})
        assert len(rows) == len(found[-1])
    assert found[0] == set()  # the watermark is at 10 minutes
    done = {("a", "completed", at(0), at(40), 3), ("b", "timed_out", at(1), at(1), 1), ("e", "error", at(180), at(180), 1)}
    timers = {("b", "timed_out", at(50), at(50), 1), ("c", "timed_out", at(2), at(2), 1)}
    assert found[1] == done | timers and found[2] == found[1]


def test_first_rows_win_over_files_and_watermarks(spark, tmp_path):
    for n, rows in enumerate([
        [("a", "first", at(0), 1), ("b", "first", at(5), 1), ("a", "again", at(1), 2)],
        [("a", "again", at(9), 3), ("c", "first", at(600), 1)],
        [("a", "much later", at(700), 4), ("d", "first", at(700), 1), ("b", "behind", at(6), 2)],
    ]):
        put(spark, f"{tmp_path}/in", "rows", sorted(rows, key=lambda r: r[2]))
        stream = ingest.file_stream(spark, f"{tmp_path}/in/rows", RUNS, "parquet", 1)
        stateful.first_into_table(stream, f"{tmp_path}/table", "run", "ts", "1 hour", f"{tmp_path}/checkpoint").awaitTermination()
    assert {(r.run, r.status) for r in ingest.current(spark, f"{tmp_path}/table").collect()} == {(x, "first") for x in "abcd"}


def test_windows_of_streams_are_those_of_tables(spark, tmp_path):
    rows = [(f"u{i % 3}", "x", at(7 * i * (1 + i % 4)), i) for i in range(40)] + [("u0", "x", None, 5)]
    path = put(spark, f"{tmp_path}/in", "rows", rows)
    table, stream = spark.read.parquet(path), spark.readStream.schema(RUNS).parquet(path)
    for k, window in enumerate((lambda d, late: stateful.sessions(d, "ts", ["run"], "n", "25 minutes", late), lambda d, late: stateful.sliding(d, "ts", ["run"], "n", "60 minutes", "15 minutes", late))):
        whole = {tuple(r) for r in window(table, None).collect()}
        streamed = {tuple(r) for r in stateful.to_the_end(window(stream, "1 minute"), f"{tmp_path}/out{k}").collect()}
        mark = max(r[2] for r in rows if r[2]) - dt.timedelta(minutes=1)
        end = lambda r, k=k: r[2] if k == 0 else r[1] + dt.timedelta(minutes=60)
        assert streamed == {r for r in whole if end(r) <= mark} and len(streamed) > 5
    assert sum(r[3] for r in stateful.sliding(table, "ts", [], "n", "60 minutes", "15 minutes").select(F.lit(0), "start", "start", "n").collect()) == 40 * 4


@pytest.fixture
def sources(spark):
    python_sources.register(spark)
    return spark


def artifacts(spark, n, step="extract"):
    return spark.range(n).select(F.concat(F.lit("p"), "id").alias("paper_id"), F.lit(step).alias("step"), F.lit('{"é": "line\\n"}\n').alias("value")).repartition(3)


def test_an_aborted_write_leaves_nothing(sources, tmp_path):
    path = f"file://{tmp_path}/a"
    read = lambda: sources.read.format("artifacts").load(path)
    assert read().collect() == []
    artifacts(sources, 20).write.format("artifacts").mode("append").save(path)
    before = sorted(os.listdir(tmp_path / "a/files"))
    bad = artifacts(sources, 50).withColumn("step", F.when(F.col("paper_id") != "p49", F.col("step")))
    with pytest.raises(Exception, match="needs a paper_id and a step"):
        bad.write.format("artifacts").mode("append").save(path)
    assert sorted(os.listdir(tmp_path / "a/files")) == before and os.listdir(tmp_path / "a/_staging") == [] and read().count() == 20
    assert {r.value for r in read().collect()} == {'{"é": "line\\n"}\n'}


def test_overwrites_and_lost_tasks(sources, tmp_path):
    path = f"file://{tmp_path}/a"
    artifacts(sources, 5, "old").write.format("artifacts").mode("append").save(path)
    artifacts(sources, 4, "new").write.format("artifacts").mode("overwrite").save(path)
    artifacts(sources, 3, "more").write.format("artifacts").mode("append").save(path)
    artifacts(sources, 0).write.format("artifacts").mode("append").save(path)
    assert {tuple(r) for r in sources.read.format("artifacts").load(path).groupBy("step").count().collect()} == {("new", 4), ("more", 3)}
    # a task that is tried again writes two files, of which the commit takes the one in its message
    writer = python_sources.ArtifactWriter({"path": path}, False)
    row = sources.createDataFrame([("p", "twice", "v")], python_sources.ARTIFACTS).first()
    writer.write(iter([row]))
    writer.commit([writer.write(iter([row])), writer.write(iter([])), None])
    assert sources.read.format("artifacts").load(path).where("step = 'twice'").count() == 1


def test_listing_and_its_filter(sources, tmp_path):
    for name in ("s1/fig_1.png", "s1/deep/fig_2.JPG", "s2/none", "s3/x.gif"):
        (tmp_path / "f" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "f" / name).write_bytes(b"xyz")
    df = sources.read.format("figures").option("tasks", 2).load(str(tmp_path / "f"))
    assert {(r.study_id, r.figure_id, r.suffix, r.bytes) for r in df.collect()} == {("s1", "fig_1", ".png", 3), ("s1", "fig_2", ".JPG", 3), ("s2", "none", "", 3), ("s3", "x", ".gif", 3)}
    reader = python_sources.FigureReader({"path": str(tmp_path / "f")})
    assert list(reader.pushFilters([python_sources.EqualTo(("study_id",), "s2"), python_sources.EqualTo(("bytes",), 3)])) == [python_sources.EqualTo(("bytes",), 3)]
    assert [p.names for p in reader.partitions()] == [["s2"]]
    assert sources.read.format("figures").load(str(tmp_path / "absent")).collect() == []


def test_places_of_pictures(spark):
    rows = [
        ("s", "/p/a.b.html", "f1", "a.b_files/x.png"), ("s", "/p/a.b.html", "f2", "https://h/q/y%20z.jpg?w=1"), ("s", "/p/a.b.html", "f3", "../up.gif"), ("s", "/p/a.b.html", "f4", "https://h/only.webp"),
        ("s", "/p/a.b.html", "f5", "  "), ("s", "/p/a.b.html", None, None), ("s", "/p/a.b.html", "f7", "https://h/"), ("s", "/p/a.b.html", "f8", "/abs/w.svg"), ("s", "/p/a.b.html", "f9", "https://h/both.png"), ("s", "/p/a.b.html", "f10", "bad%zz.png"),
    ]
    files = ["/p/a.b_files/x.png", "/p/a.b_bestanden/y z.jpg", "/p/other_files/only.webp", "/p/zother_files/only.webp", "/store/s/f8.svg", "/abs/w.svg", "/p/both.png", "/p/a.b_files/both.png", "/p/bad%zz.png"]
    df = spark.createDataFrame(rows, "study_id string, path string, figure_id string, image_url string").withColumn("status", F.lit("old")).drop("status")
    got = {r.figure_id: (r.status, r.found_at, r.local_path) for r in figures.picture_status(df, spark.createDataFrame([(f,) for f in files] * 2, "path string"), "/store").collect()}
    assert got == {
        "f1": ("local_copy", "/p/a.b_files/x.png", "/store/s/f1.png"), "f2": ("local_copy", "/p/a.b_bestanden/y z.jpg", "/store/s/f2.jpg"), "f3": ("to_fetch", None, "/store/s/f3.gif"),
        "f4": ("local_copy", "/p/other_files/only.webp", "/store/s/f4.webp"), "f5": ("no_url", None, None), None: ("no_url", None, None), "f7": ("to_fetch", None, "/store/s/f7.png"),
        "f8": ("exists", None, "/store/s/f8.svg"), "f9": ("local_copy", "/p/a.b_files/both.png", "/store/s/f9.png"), "f10": ("local_copy", "/p/bad%zz.png", "/store/s/f10.png"),
    }


def files_of(path):
    return {(f, os.stat(os.path.join(d, f)).st_mtime_ns) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_fifth_version_becomes_the_sixth_without_rewriting(spark, tmp_path):
    fifth = {c: v for c, v in ddl.store_columns("observations").items() if c not in ddl.SIXTH["observations"]}
    spark.sql("CREATE DATABASE IF NOT EXISTS moved")
    ddl.create_table(spark, "moved.observations", fifth, f"{tmp_path}/observations")
    spark.sql("INSERT INTO moved.observations (observation_id, paper_id, value) VALUES (1, 'it''s', 2.5), (2, 'q', NULL)")
    before = files_of(tmp_path / "observations")
    assert ddl.to_sixth(spark, "moved", str(tmp_path), dry_run=True) == ["panels", "observations.panel_id", "observations.measurement_domain"]
    assert not spark.catalog.tableExists("moved.panels")
    assert ddl.to_sixth(spark, "moved", str(tmp_path)) == ["panels", "observations.panel_id", "observations.measurement_domain"]
    assert ddl.to_sixth(spark, "moved", str(tmp_path)) == [] and ddl.to_sixth(spark, "moved", dry_run=True) == []
    assert files_of(tmp_path / "observations") == before
    assert {(r.observation_id, r.paper_id, r.measurement_domain, r.panel_id, r.is_control) for r in spark.table("moved.observations").collect()} == {(1, "it's", "sensory", None, False), (2, "q", "sensory", None, False)}
    spark.sql("INSERT INTO moved.observations (observation_id, measurement_domain) VALUES (3, 'texture')")
    assert {r.measurement_domain for r in spark.table("moved.observations").where("observation_id = 3").collect()} == {"texture"}
    about = {(r.table, r.column): (r.type, r.default) for r in ddl.described(spark, "moved").collect()}
    assert about["observations", "measurement_domain"] == ("string", "'sensory'") and about["panels", "panel_size"] == ("int", None)
    spark.sql("DROP DATABASE moved CASCADE")


def test_a_store_is_created_once(spark, tmp_path):
    assert ddl.create_store(spark, "fresh", str(tmp_path)) == list(schema.TABLES) and ddl.create_store(spark, "fresh", str(tmp_path)) == []
    spark.sql("INSERT INTO fresh.extraction_runs (run_id) VALUES (1)")
    row = spark.table("fresh.extraction_runs").first()
    assert (row.status, row.corrections_applied, row.total_cost_usd) == ("in_progress", 0, 0.0)
    assert ddl.described(spark, "fresh").count() == sum(len(ddl.store_columns(n)) for n in schema.TABLES)
    spark.sql("DROP DATABASE fresh CASCADE")
    spark.sql("CREATE DATABASE bare")
    assert ddl.described(spark, "bare").collect() == []
    spark.sql("DROP DATABASE bare")
