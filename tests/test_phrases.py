"""Phrases against brute force."""

import random

from tessera.operators import phrases


def test_phrases_equal_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "the", "the", "a", "b", "c", "dd", "E", "é", "f*"])
    docs = [(i, rng.choice([" ", "\n", " \t "]).join(word() for _ in range(rng.choice([0, 1, 3, 30])))) for i in range(80)] + [(80, None), (3, "dd dd dd the"), (None, "the a")]
    wanted = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 3, 4])))) for i in range(120)] + [(120, ""), (121, None), (122, "absent the"), (5, "The\tA"), (123, "th")]
    line = lambda t: " " + " ".join("".join(c.lower() if c.isascii() else c for c in (t or "")).split()) + " "
    want = {(d, p) for d, t in docs for p, x in wanted if d is not None and line(x).strip() and line(x) in line(t)}
    d, p = spark.createDataFrame(docs, "doc long, body string").repartition(3), spark.createDataFrame(wanted, "p long, x string")
    got = [tuple(r) for r in phrases.find_phrases(d, p, "doc", "body", "p", "x").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300
    assert phrases.find_phrases(d, p.limit(0), "doc", "body", "p", "x").collect() == [] and phrases.find_phrases(d.limit(0), p, "doc", "body", "p", "x").collect() == []


def test_no_text_meets_all_phrases(spark):
    """The plan joins by equal keys only."""
    d, p = spark.createDataFrame([(1, "a b c")], "doc long, body string"), spark.createDataFrame([(1, "b c")], "p long, x string")
    plan = phrases.find_phrases(d, p, "doc", "body", "p", "x")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
