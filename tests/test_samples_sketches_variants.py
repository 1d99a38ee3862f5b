"""Samples without an order of all rows, sketches that merge, and the walk over variants, each against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import nested
from tessera.operators import aggregate


def test_samples_are_each_groups_smallest(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", None]), rng.getrandbits(60) if i % 3 else 5 << 48) for i in range(600)] + [(1000, "alone", 9), (1001, "two", 1), (1002, "two", 1)]
    df = spark.createDataFrame(rows, "id long, g string, h long").repartition(5)
    groups = {}
    for i, g, h in rows:
        groups.setdefault(g, []).append((h, i))
    for wanted, count in [(F.lit(7), lambda n: 7), (F.lit(10**6), lambda n: n), (F.lit(0), lambda n: 0), (F.greatest(F.lit(1), F.floor(F.col("_total") * 0.3)), lambda n: max(1, int(n * 0.3)))]:
        got = aggregate.smallest(df, "id", ["g"], wanted, F.col("h"))
        assert sorted((r.id, r.g or "") for r in got.collect()) == sorted((i, g or "") for g, x in groups.items() for _, i in sorted(x)[: count(len(x))])
        assert got.columns == df.columns
    assert aggregate.sample_share(df.limit(0), 0.2, "id", by=["g"]).collect() == [] and aggregate.sample_share(df.limit(0), 0.2, "id").collect() == []


def test_samples_by_the_hash_stay_the_same(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 3)
    h = F.xxhash64(F.lit(4), F.col("id"))
    want = {r.id for r in df.orderBy(h).limit(1000).collect()}
    assert {r.id for r in aggregate.sample_share(df, 0.2, "id", 4).collect()} == want == {r.id for r in aggregate.sample_share(df.repartition(7), 0.2, "id", 4).collect()}
    each = aggregate.sample_rows(df, 5, "id", 4, by=["g"])
    assert {r.id for r in each.collect()} == {r.id for g in range(3) for r in df.where(F.col("g") == g).orderBy(h).limit(5).collect()}
    plan = each._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" not in plan and "GlobalLimit" not in plan


def test_sketches_of_days_merge_within_their_errors(spark):
    df = spark.range(120000).select((F.col("id") % 30).alias("day"), (F.col("id") % 4).alias("g"), (F.col("id") * 7919 % 60000).alias("who"), F.when(F.col("id") % 10 > 0, F.pow(F.xxhash64("id") % 1000, F.lit(3))).alias("v"))
    days = aggregate.sketches(df, ["g", "day"], "who", "v")
    merged = aggregate.merged(aggregate.merged(days, ["g", "day"]), ["g"])
    got = {r.g: r for r in aggregate.estimates(merged, [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
    values = {g: sorted(r.v for r in df.where((F.col("g") == g) & F.col("v").isNotNull()).collect()) for g in range(4)}
    for g, r in got.items():
        true = df.where(F.col("g") == g).select("who").distinct().count()
        assert r.n == 30000 and r.n_values == len(values[g]) and abs(r.n_distinct - true) <= 0.04 * true
        for q in (10, 50, 90):
            low, high = (sum(f(v, r[f"q_{q}"]) for v in values[g]) / len(values[g]) for f in (lambda a, b: a < b, lambda a, b: a <= b))
            assert low - 0.01 <= q / 100 <= high + 0.01
        assert (r.q_0, r.q_100) == (values[g][0], values[g][-1])
    none = aggregate.estimates(aggregate.sketches(spark.createDataFrame([("a", None, None)], "g string, who long, v double"), ["g"], "who", "v"), [0.5]).first()
    assert tuple(none) == ("a", 1, 0, 0, None)


def _random(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        return rng.choice([1, "mean", None, [], {}, 2.5, True])
    if rng.random() < 0.3:
        return [_random(rng, depth - 1) for _ in range(rng.choice([0, 1, 3]))]
    keys = rng.sample(["mean", "sd", "sem", "means", "unit", "n", "sweet", "sour", "a b", "x.y", "é", "", "scale"], rng.choice([1, 2, 3]))
    return {k: _random(rng, depth - 1) for k in keys}


@pytest.mark.parametrize("seed", [1, 2])
def test_variant_walk_equals_the_function(spark, seed):
    rng = random.Random(seed)
    texts = [json.dumps(_random(rng, rng.choice([2, 5, 8])), ensure_ascii=False) for _ in range(400)]
    texts += [None, "", " ", "{", "null", "3", "[]", '{"a": {"mean": null}}', '{"a": {"b": {"c": {"d": {"e": {"f": {"mean": 1}}}}}}}', '{"a":' * 12 + "1" + "}" * 12]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(3)
    got = {r.id: r.attribute_names for r in nested.attribute_rows(df, "id", "t").collect()}
    want = {r.id: r.w for r in df.select("id", nested.attribute_names("t").alias("w")).collect()}
    assert got == want and sum(map(len, got.values())) > 100
    plan = nested.attribute_rows(df, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 1 + plan.count("REPARTITION")
