"""The cell tree against all pairs, maps against numpy, blobs against a flood fill."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from marketloom.operators import library as L
from marketloom.operators import pockets as P


def moments_of(spark, n, seed):
    rng = random.Random(seed)
    day = dt.date(2024, 1, 1)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.5  # half of all moments are in one tiny cell
        rows.append((rng.choice("ABCD"), day + dt.timedelta(days=i % 30), i % 30 + 1, rng.randrange(5), 5.0, *(rng.gauss(0, 1e-4) if hot else rng.gauss(0, 1) for _ in range(3)), i))
    df = spark.createDataFrame(rows, "symbol string, date date, sess int, step int, dollars double, a double, b double, c double, i int")
    return df.dropDuplicates(["symbol", "date", "step"]).cache()


def test_tree_search_equals_all_pairs(spark, monkeypatch):
    lib = moments_of(spark, 1_500, 1)
    monkeypatch.setattr(L, "MOST_LEAF", 60)
    got = {tuple(r)[:6]: r.w for r in L.search(lib.filter("i % 40 = 0"), lib, ["a", "b", "c"], 0.9, 12, 1).collect()}
    rows, t = lib.collect(), {p: 0.9 * s for p, s in L.spreads(lib, ["a", "b", "c"]).items()}
    for p in "abc":
        x = np.array([r[p] for r in rows])
        assert np.isclose(t[p] / 0.9, (np.quantile(x, 0.75) - np.quantile(x, 0.25)) / 1.349)
    want = {}
    for q in rows:
        for m in rows if q.i % 40 == 0 else ():
            z = [abs(m[p] - q[p]) / t[p] for p in "abc"]
            if q.sess - 12 <= m.sess < q.sess and abs(m.step - q.step) <= 1 and max(z) < 1:
                want[q.symbol, q.date, q.step, m.symbol, m.date, m.step] = np.prod([1 - x * x for x in z])
    assert got.keys() == want.keys() and len(want) > 80 and all(np.isclose(got[k], want[k]) for k in want)
    own = L.search(lib.filter("i % 40 = 0"), lib, ["a", "b", "c"], 0.9, 12, 1, same_symbol=True, least_dollars=4.0).count()
    assert own == sum(k[0] == k[3] for k in want)


def test_no_hot_cell(spark):
    """Half of all rows lie within 1e-4 of each other: fixed cells would put them together, the tree's leaves stay near an even share."""
    lib = moments_of(spark, 4_000, 2)
    x = np.array([[r.a, r.b, r.c] for r in lib.collect()])
    tree = L.CellTree(x[:800], np.ones(3), 6)
    sizes = lib.select(tree.leaf(F.array("a", "b", "c")).alias("l")).groupBy("l").count().collect()
    assert len(sizes) >= 60 and max(r["count"] for r in sizes) <= 3 * len(x) / 64
    one = lib.select(tree.leaves(F.array("a", "b", "c"), F.array("a", "b", "c")).alias("ls"), tree.leaf(F.array("a", "b", "c")).alias("l")).collect()
    assert all(r.ls == [r.l] for r in one)


def test_maps_and_levels(spark):
    rng = np.random.default_rng(3)
    grid = np.where(rng.random((P.NX, P.NY)) < 0.03, rng.random((P.NX, P.NY)), 0)
    grid[0, 0] = grid[-1, -1] = 2.0
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), 3, grid.ravel().tolist())], "q_symbol string, q_date date, q_step int, grid array<double>")
    r = P.levels(P.densities(df)).first()
    k = np.array(P.kernel())
    out = grid
    for axis in (0, 1):
        padded = np.pad(out, [(3, 3) if a == axis else (0, 0) for a in (0, 1)], mode="symmetric")
        out = sum(w * np.take(padded, np.arange(i, i + out.shape[axis]), axis=axis) for i, w in enumerate(k))
    want = (out + 1e-9) / (out + 1e-9).sum()
    assert np.allclose(r.q, want.ravel(), rtol=1e-9, atol=1e-15)
    s = np.sort(want.ravel())[::-1]
    assert np.allclose(r.levels, [s[np.searchsorted(np.cumsum(s), a)] for a in P.LEVELS])


def flood(cells):
    cells, n = set(cells), 0
    while cells:
        n += 1
        stack = [cells.pop()]
        while stack:
            x, y = stack.pop()
            for c in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if c in cells:
                    cells.remove(c)
                    stack.append(c)
    return n


def test_blobs(spark):
    rng = random.Random(5)
    maps = {g: {(rng.randrange(20), rng.randrange(20)) for _ in range(n)} for g, n in enumerate((1, 150, 200, 260, 330))}
    maps[10] = {(0, 0), (1, 1)}  # a diagonal pair stays two
    maps[11] = {(x, y) for x in range(20) for y in range(20) if x % 2 == 0 or y == (0 if x % 4 == 1 else 19)}  # one winding snake
    rows = [(g, x, y) for g, own in maps.items() for x, y in own] + [(10, 0, 0)]
    got = {r.g: (r.n_blobs, r.n_cells) for r in P.blobs(spark.createDataFrame(rows, "g int, x int, y int"), ["g"], 20).collect()}
    assert got == {g: (flood(own), len(own)) for g, own in maps.items()}
    assert got[10] == (2, 2) and got[11][0] == 1
