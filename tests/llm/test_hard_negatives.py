"""Hard negatives against all scores of small tables, and what the tree spares."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from marketloom.llm import hard_negatives as h
from tests.oracle import same

SCHEMA = "vec_id long, embedding array<float>, label int, q int, leaf string"


def brute(rows, every=50):
    held = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        row = (label, [math.floor(256 * x) for x in v])
        held[i] = min(held.get(i, row), row)
    out = set()
    for a, (la, va) in held.items():
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(va, vb)), b, lb) for b, (lb, vb) in held.items() if b != a))
        for p, pid, _ in [s for s in scored if s[2] == la][:5]:
            fits = [s for s in scored if s[2] != la and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out |= {(a, pid, i + 1, n[1], -p, -n[0]) for i, n in enumerate(fits[:3])}
    return out


def run(spark, rows, every=50):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = h.mine(h.relabelled(df), F.col("vec_id") % every == 0).collect()
    assert len(got) == len({tuple(r) for r in got})
    return {tuple(r) for r in got}


def test_given_table(spark, sf):
    assert same(h.op12_hard_negatives(spark, sf), h.OP12_SQL, sf) > 0


def test_odd_rows(spark):
    rng = random.Random(4)
    vector = lambda n=6: [float(np.float32(rng.gauss(0, 0.4))) for _ in range(n)]
    rows = [(i, vector(), rng.randrange(4)) for i in range(220)]
    hot = vector()
    rows += [(i, hot, rng.randrange(3)) for i in range(220, 420)]  # a third of all rows are equal
    rows += [(500, None, 1), (510, [0.1, None, 0.2], 1), (520, [0.1, float("nan")], 2), (530, [float("inf")] * 6, 2), (None, vector(), 1), (540, vector(), None)]
    rows += [(550, [], 1), (560, vector(3), 2), (570, [0.0] * 6, 3), (0, vector(), 2), (10, [9.0] * 6, 0), (580, [-x for x in hot], 1)] + rows[:7]
    assert run(spark, rows, 10) == brute(rows, 10)


def test_small_chunks_and_large_components(spark, monkeypatch):
    monkeypatch.setattr(h, "MOST_ANCHORS", 3)
    rng = random.Random(9)
    for scale in (1.0, 1e4, 2e6, 1e15):
        rows = [(i, [float(np.float32(scale * rng.gauss(1, 1))) for _ in range(3)], i % 3) for i in range(40)]
        want = {r for r in brute(rows, 5) if max(abs(r[4]), abs(r[5])) < 1 << 61}
        got = {r for r in run(spark, rows, 5) if max(abs(r[4]), abs(r[5])) < 1 << 61}
        assert got == want and (want or scale == 1e15)


def test_empty(spark):
    assert run(spark, []) == set()
    assert run(spark, [(1, [0.5], 1)]) == set() and run(spark, [(0, [0.5], 1)]) == set()


def test_ranges_spare_leaves():
    """In clustered data most leaves cannot hold a row of the window, and none that can is left out."""
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 200, (40, 16))
    x = np.concatenate([c + rng.normal(0, 12, (60, 16)) for c in centres]).round().astype(np.int64)
    tree = h.Tree(x[rng.permutation(len(x))[:800]])
    leaves = tree.leaves(x)
    for leaf in np.unique(leaves):
        own = x[leaves == leaf].astype(float)
        d = np.sqrt(h._squares(own, tree.points(leaf)))
        tree.ranges[leaf], tree.norms[leaf] = np.stack([d.min(0), d.max(0)], 1), ((own**2).sum(1).min(), (own**2).sum(1).max())
    looked = 0
    for a in range(0, len(x), 97):
        scores = x @ x[a]
        floor = np.sort(scores)[-6]
        for leaf in np.unique(leaves):
            low, high = (b[0] for b in tree.bounds(x[a : a + 1].astype(float), leaf))
            own = scores[leaves == leaf]
            assert low <= own.min() and own.max() <= high
            looked += high >= floor
    assert looked < 0.35 * len(range(0, len(x), 97)) * len(np.unique(leaves))
