"""Move tables by hand, with unknown outcomes, days without a prediction and empty tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.operators import move_tables

D1, D2 = dt.date(2024, 3, 4), dt.date(2024, 3, 5)
SCHEMA = "symbol string, date date, minute int, side string, p double, reached int, touched int, formed int, centre double, best double, best_x double, vwap_move double, p_up double, p_dn double, reached_up int, reached_dn int"
ROWS = [
    ("a", D1, 600, "up", 0.8, 1, 1, 1, 0.2, 0.3, 3.0, 0.1, 0.8, 0.1, 1, 0),
    ("b", D1, 605, "up", 0.6, 0, 1, 1, 0.05, 0.1, 1.0, -0.1, 0.6, 0.7, 0, 1),
    ("b", D1, 620, "up", 0.6, 0, 0, 0, None, 0.02, 0.2, -0.3, 0.6, 0.6, 0, 0),
    ("c", D1, 600, "down", 0.5, None, None, None, None, None, None, None, 0.2, 0.5, None, None),
]


@pytest.fixture(scope="module")
def made(spark):
    scored = spark.createDataFrame([(D1, "up", 5), (D1, "down", 2), (D2, "up", 4)], "date date, side string, decisions long")
    return spark.createDataFrame(ROWS, SCHEMA), scored


def test_days_and_times(made):
    rows, scored = made
    days = {(r.date, r.side): r for r in move_tables.by_day(rows, scored).collect()}
    up = days[D1, "up"]
    assert (up.predictions, up.happened, up.touched_only, up.did_not, up.stocks, up.max_said) == (3, 1, 1, 1, 2, 0.8)
    assert (up.mean_over, up.median_best, up.median_vwap_move) == pytest.approx((2.0, 0.1, -0.1))
    down, quiet = days[D1, "down"], days[D2, "up"]
    assert (down.predictions, down.happened, down.touched_only, down.did_not, down.reached) == (1, 0, 0, 0, None)  # not known
    assert (quiet.decisions, quiet.predictions, quiet.happened, quiet.said) == (4, 0, 0, None)
    times = {(r.bucket, r.side): (r.predictions, r.happened, r.touched_only, r.did_not, r.unknown) for r in move_tables.by_time(rows).collect()}
    assert times == {(600, "up"): (2, 1, 1, 0, 0), (615, "up"): (1, 0, 0, 1, 0), (600, "down"): (1, 0, 0, 0, 1)}


def test_lean_and_period(made):
    rows, scored = made
    lean = {r.lean: r for r in move_tables.by_lean(rows).collect()}
    assert (lean["up"].predictions, lean["up"].share, lean["up"].lean_reached, lean["up"].other_reached) == (2, 0.5, 0.5, 0.0)  # equal chances lean up
    assert (lean["down"].predictions, lean["down"].lean_reached, lean["down"].went_up) == (2, 1.0, 0.0)
    period = {r.side: r for r in move_tables.by_period(rows, scored).collect()}
    assert {s: (r.predictions, r.decisions, r.stocks, r.days) for s, r in period.items()} == {"up": (3, 9, 2, 1), "down": (1, 2, 1, 1), "both": (4, 11, 3, 1)}
    assert period["up"].gap == pytest.approx((0.2 - 0.6 - 0.6) / 3) and period["up"].gap_low == pytest.approx(period["up"].gap)  # one day: every draw is that day
    assert period["down"].gap is None and period["up"].not_formed == pytest.approx(1 / 3)


def test_empty(made):
    rows, scored = made
    none = rows.limit(0)
    assert move_tables.by_lean(none).count() == 0 and move_tables.by_time(none).count() == 0
    assert {r.predictions for r in move_tables.by_day(none, scored).collect()} == {0}
    assert {(r.side, r.predictions) for r in move_tables.by_period(none, scored).collect()} == {("up", 0), ("down", 0), ("both", 0)}


def test_lean_deciles_and_skill(spark):
    rows = [("a", D1 if i < 10 else D2, i / 20, 0.0, int(i >= 10), int(i < 5), 0.0 if i == 0 else i - 9.5) for i in range(20)]
    frame = spark.createDataFrame(rows, "symbol string, date date, p_up double, p_dn double, touched_up int, touched_dn int, vwap_move double")
    named = spark.createDataFrame([(D2,)], "date date")
    out = {(r.days, r.decile): (r.n, r.went_up, r.touched_up) for r in move_tables.by_lean_decile(frame, named).collect()}
    assert {k: v[0] for k, v in out.items() if k[0] == "all"} == {("all", i): 2 for i in range(10)} and out["all", 9] == (2, 1.0, 1.0) and out["all", 0] == (2, 0.0, 0.0)
    assert {k: v[0] for k, v in out.items() if k[0] == "rest"} == {("rest", i): 1 for i in range(10)}
    skill = {r.outcome: (r.auc, r.n) for r in move_tables.lean_skill(frame).collect()}
    assert skill == {"went_up": (1.0, 19), "only_up_touched": (1.0, 15)}
    tied = move_tables.by_lean_decile(frame.withColumn("p_up", F.lit(0.5)), named).filter("days = 'all'").collect()
    assert [(r.decile, r.n) for r in tied] == [(5, 20)]  # equal leans stay together
