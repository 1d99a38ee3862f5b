"""Hierarchies against walks in plain Python."""

import random

from tessera.operators import hierarchy


def test_ancestors_equal_walks(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, k - 1 if 0 < k < 40 else rng.choice([None, 3, 39, k, 900, rng.randrange(120), 60]) if k else None, rng.randrange(50)) for k in range(120)] + [(None, 3, 5), (200, 201, 1), (201, 202, 2), (202, 200, 3)]
    up, size = {k: p for k, p, _ in rows if k is not None}, {k: s for k, _, s in rows}
    want = {}
    for k in up:
        at, path = k, []
        while up.get(at) in up and up[at] is not None and len(path) <= len(up):
            at = up[at]
            path.append(at)
        want[k] = (None, None, None, True) if len(path) > len(up) else (at, len(path), max((size[x] for x in path), default=None), False)
    got = {r[0]: tuple(r)[1:] for r in hierarchy.ancestors(spark.createDataFrame(rows, "k long, p long, s long"), "k", "p", "s", f"{tmp_path}/rounds").collect()}
    assert got == want and sum(w[3] for w in want.values()) > 3 and max(w[1] or 0 for w in want.values()) >= 39
    assert hierarchy.ancestors(spark.createDataFrame([], "k long, p long, s long"), "k", "p", "s", f"{tmp_path}/none").collect() == []
