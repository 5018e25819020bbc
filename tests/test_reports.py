"""Isotonic bins by a plain loop, fitted scales by a grid, the range model against the mean, ages, and dated files."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from marketloom.operators import news, reports, scoring
from marketloom.sources import io


def test_isotonic_by_loop(spark):
    rng = random.Random(2)
    rows = [(g, i, 1, round(rng.random(), 3), int(rng.random() < 0.3)) for g in (1, 2) for i in range(97)]
    got = {(r.grp, r.bin): (r.n, r.mean_p, r.rate) for r in reports.isotonic(spark.createDataFrame(rows, "grp long, symbol long, day_idx int, p double, hit int"), "grp", 7).collect()}
    for g in (1, 2):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[3], r[1], r[2]))
        sizes = [97 // 7 + (i < 97 % 7) for i in range(7)]
        cuts = np.cumsum([0, *sizes])
        bins = [own[a:b] for a, b in zip(cuts, cuts[1:])]
        hits, n = np.array([sum(r[4] for r in b) for b in bins], float), np.array(sizes, float)
        # The greatest monotone fit: max over starts of min over ends of the mean of a stretch.
        want = [max(min(hits[i : j + 1].sum() / n[i : j + 1].sum() for j in range(k, 7)) for i in range(k + 1)) for k in range(7)]
        for k in range(7):
            assert got[g, k + 1][0] == sizes[k] and np.isclose(got[g, k + 1][1], np.mean([r[3] for r in bins[k]])) and np.isclose(got[g, k + 1][2], want[k])


def test_fit_scale_by_grid(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(f), float(rng.normal(0, np.exp(0.3 + 0.6 * f))), [float(z) for z in scoring.Z]) for i, f in enumerate(rng.random(3_000))]
    df = spark.createDataFrame(rows, "symbol long, f double, actual double, q array<double>")
    a, b = reports.fit_scale(df, "f", steps=25)
    x, y, z = np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.array(scoring.Z)

    def loss(a, b):
        e = y[:, None] - z[None, :] * np.exp(a + b * x)[:, None]
        return np.maximum(np.array(scoring.TAUS) * e, (np.array(scoring.TAUS) - 1) * e).mean()

    best = min(loss(p, q) for p in np.linspace(-1, 1, 21) for q in np.linspace(-1, 1, 21))
    assert loss(a, b) < loss(0, 0) and loss(a, b) <= best * 1.01
    assert reports.fit_scale(df.limit(0), "f") == (0.0, 0.0)


def test_range_model_beats_the_mean(spark):
    rng = np.random.default_rng(5)
    x = rng.random((1_200, 2))
    y = np.exp(-3 + 2 * x[:, 0] + 0.3 * rng.normal(size=1_200))
    df = spark.createDataFrame([(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))], "id int, a double, b double, y double")
    out = reports.range_model(df.filter("id < 800"), df.filter("id >= 800"), ["a", "b"], "y").select("y", "mean_log", "score").collect()
    real = np.log([r.y for r in out])
    assert np.mean((real - [r.mean_log for r in out]) ** 2) < 0.5 * np.var(real)
    assert 0.7 < np.mean(real <= [r.score for r in out]) < 0.9


def test_ages(spark):
    seen = dt.datetime(2024, 1, 2, 12)
    rows = [("21h ago", seen - dt.timedelta(hours=21, minutes=59)), ("21h ago", seen - dt.timedelta(hours=22)), ("3d ago", seen + dt.timedelta(minutes=1)), ("now", seen), ("5m ago", None)]
    df = spark.createDataFrame([(a, seen, s) for a, s in rows], "age string, seen timestamp, stated timestamp")
    got = df.select(news.age_bounds("age").alias("b"), news.reconciled("seen", "age", "stated").alias("v")).collect()
    assert [r.v for r in got] == ["agrees", "differs", "future", None, None] and tuple(got[0].b) == (1260, 1320)


def test_dated_files_are_sorted_and_bounded(spark, tmp_path):
    df = spark.range(3_000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10 == 0).cast("int")).alias("date"), F.col("id").alias("symbol"))
    io.write_dated(df, str(tmp_path / "t"), sort=("symbol",), most_rows=500)
    files = sorted((tmp_path / "t" / "date=2024-01-01").glob("*.parquet"))
    import pyarrow.parquet as pq

    parts = [pq.read_table(f)["symbol"].to_pylist() for f in files]
    assert len(parts) > 4 and all(p == sorted(p) and len(p) <= 500 for p in parts) and sorted(sum(parts, [])) == [i for i in range(3_000) if i % 10]
    io.write_dated(df.filter("symbol < 5 AND symbol > 0"), str(tmp_path / "t"), sort=("symbol",))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4 + 300
