"""Ranks of computed spreads don't depend on the order of the sums behind them."""

from datetime import date

from marketloom.operators import grading
from marketloom.plans import scoring


def test_day_picks_by_nine_decimals(spark):
    """Two sigmas apart by their last digit are a tie and go by symbol."""
    rows = spark.createDataFrame([(date(2024, 1, 2), 1, 0.5, 0.3), (date(2024, 1, 2), 2, 0.1, 0.1 + 0.2)], "date date, symbol int, moved double, sigma double")
    assert grading.day_picks(rows, ["sigma"], "moved", 1).first()["by_sigma"] == 0.5


def test_handoff_places_by_nine_decimals(spark, monkeypatch):
    rows = spark.createDataFrame([(s, date(2024, 1, 2), 1, 0.0, [0.0, 0.0, 0.0, 0.0, w]) for s, w in ((1, 0.3), (2, 0.1 + 0.2))], "symbol int, date date, day_idx int, actual double, q array<double>")
    monkeypatch.setattr(scoring, "forecasts", lambda spark, d: rows)
    monkeypatch.setattr(scoring, "sectors", lambda spark, d: spark.createDataFrame([(1, "A"), (2, "A")], "symbol int, sector string"))
    assert {r.symbol: r.place for r in scoring.o121_handoff(spark, "").collect()} == {1: 1, 2: 2}
