"""Rows that many steps read are made once: what comes out reads a staged table, not the given ones."""

import re

import numpy as np

from marketloom.operators import reports
from marketloom.plans import reports as plans
from marketloom.plans import moves, shapes


def sources(df):
    return {f.split("/")[-2].split("-")[0] for f in df.inputFiles()}


def test_fitted_scale(spark, sf):
    assert sources(plans.o210_fitted_scale(spark, sf)) == {"forecasts"}


def test_range_model(spark, sf):
    assert sources(plans.o213_range_model(spark, sf)) == {"ranges"}


def test_range_model_spread(spark):
    """The spread is the exact quantile of the training residuals, without one percentile over all of them."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.normal(size=300), np.exp(rng.normal(size=300)))], "x double, y double")
    out = reports.range_model(df, df, ["x"], "y")
    assert not re.search(r"(?<!approx_)percentile\(", out._jdf.queryExecution().optimizedPlan().toString())
    rows = out.collect()
    want = np.quantile([np.log(r.y) - r.mean_log for r in rows], 0.8)
    assert all(abs(r.score - r.mean_log - want) < 1e-9 for r in rows)


def test_shape_scores(spark, sf):
    assert sources(shapes.o203_shape_scores(spark, sf)) <= {"moment"}


def test_cumulative_moves(spark, sf):
    """Trades are read once, and a decision's windows are not shuffled again after they met what the prints made of them."""
    df = moves.o205_cumulative_moves(spark, sf)
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("\n").count("l_suppkey") == 1
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") <= 6
