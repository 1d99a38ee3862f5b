"""Changes by bucket: what is rewritten, what a second attempt does, and streams into such a table."""

import glob
import json
import os

import pytest

from tessera.operators import buckets, store
from tessera.streaming import ingest


def _files(table):
    return {p: os.stat(p).st_ino for p in glob.glob(f"{table}/rows/_bucket=*/*.parquet")}


def _rows(spark, table):
    return {r.k: r.v for r in buckets.read(spark, table).collect()}


def _table(spark, tmp_path, n=8):
    table = str(tmp_path / "t")
    buckets.create(spark.createDataFrame([(i, f"v{i}") for i in range(100)], "k long, v string"), table, "k", n)
    return table


def test_a_change_of_one_key_rewrites_one_bucket(spark, tmp_path):
    table = _table(spark, tmp_path)
    before = _files(table)
    new = spark.createDataFrame([(5, "new")], "k long, v string")
    touched = buckets.upsert(table, new, 1)
    after = _files(table)
    assert len(touched) == 1 and {os.path.basename(os.path.dirname(p)) for p, _ in before.items() ^ after.items()} == {f"_bucket={touched[0]}"}
    assert _rows(spark, table) == {i: f"v{i}" for i in range(100)} | {5: "new"}
    buckets.delete_keys(table, spark.createDataFrame([(7,), (None,), (1000,)], "k long"), 2)
    assert _rows(spark, table) == {i: f"v{i}" for i in range(100) if i != 7} | {5: "new"}
    found = buckets.read_keys(spark, table, [5, 7])
    assert [tuple(r) for r in found.collect()] == [(5, "new")]
    assert "_bucket" in found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        _table(spark, tmp_path)


def test_a_change_that_failed_between_buckets_is_moved_again(spark, tmp_path, monkeypatch):
    """A change that adds to values is no upsert: made twice it would add twice."""
    table = _table(spark, tmp_path)
    batch = spark.createDataFrame([(i,) for i in range(50)], "k long")
    add = lambda old, b: old.join(b.withColumn("hit", store.F.lit("+")), "k", "left").selectExpr("k", "concat(v, coalesce(hit, '')) AS v")
    real = buckets._write

    def fails(rows, folder):
        real(rows.where("_bucket < 4"), folder)
        raise OSError("lost")

    monkeypatch.setattr(buckets, "_write", fails)
    with pytest.raises(OSError):
        buckets.change(table, batch, add, 1)
    monkeypatch.setattr(buckets, "_write", real)
    buckets.change(table, batch.limit(0), add, 2)  # the next one ends it
    for number in (1, 2):
        assert buckets.change(table, batch, add, number) == []
    assert _rows(spark, table) == {i: f"v{i}" + ("+" if i < 50 else "") for i in range(100)}


def test_emptied_and_null_keys(spark, tmp_path):
    table = _table(spark, tmp_path, 4)
    buckets.insert_missing(table, spark.createDataFrame([(None, "none"), (3, "late")], "k long, v string"), 1)
    assert _rows(spark, table) == {i: f"v{i}" for i in range(100)} | {None: "none"}
    buckets.delete_keys(table, buckets.read(spark, table), 2)
    assert _rows(spark, table) == {None: "none"}
    buckets.change(table, buckets.read(spark, table), lambda old, _b: old.limit(0), 3)
    assert _rows(spark, table) == {} and buckets.read(spark, table).columns == ["k", "v"]
    assert buckets.change(table, spark.createDataFrame([], "k long, v string"), lambda old, _b: old, 4) == []
    buckets.upsert(table, spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string").withColumn("o", store.F.col("v")), 5, order="o")
    assert _rows(spark, table) == {1: "b"}


def test_stream_into_buckets(spark, tmp_path):
    table, columns = str(tmp_path / "t"), "k long, v string, at long"
    os.mkdir(tmp_path / "in")
    seen = {}
    for part, rows in enumerate([[(1, "a", 1), (2, "b", 2), (1, "c", 3)], [(2, "d", 4)], [(3, "e", 5), (3, "f", 6)]]):
        (tmp_path / "in" / f"{part}.json").write_text("\n".join(json.dumps(dict(zip(("k", "v", "at"), r, strict=True))) for r in rows))
        stream = ingest.file_stream(spark, str(tmp_path / "in"), columns, per_trigger=1)
        change = lambda old, b: store.replace(old, b.withColumn("o", b.at), "k", "o")
        ingest.into_buckets(stream, table, "k", change, str(tmp_path / "cp"), 4).awaitTermination()
        seen |= {k: v for k, v, _ in rows}
        assert _rows(spark, table) == seen


def test_old_versions_of_a_streamed_table_go(spark, tmp_path):
    os.mkdir(tmp_path / "in")
    for part in range(4):
        (tmp_path / "in" / f"{part}.json").write_text(json.dumps({"k": part, "v": str(part)}))
        stream = ingest.file_stream(spark, str(tmp_path / "in"), "k long, v string")
        ingest.into_table(stream, str(tmp_path / "t"), lambda old, b: b if old is None else store.append(old, b), str(tmp_path / "cp")).awaitTermination()
    assert {r.k for r in ingest.current(spark, str(tmp_path / "t")).collect()} == {0, 1, 2, 3}
    assert sorted(d for d in os.listdir(tmp_path / "t") if d.startswith("batch")) == ["batch=2", "batch=3"]
