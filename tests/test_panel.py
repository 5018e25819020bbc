"""No column of a panel row but the target and the look-ahead label changes when the future is cut off; guards of next-session rows."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from marketloom.operators import panel
from marketloom.operators.asof import snap_to_session

AHEAD = {"target", "target_return", "to", "to_is_est", "window", "month_end", "quarter_end", "days_to_next"}


def calendar(spark, n):
    start = dt.date(2020, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(n * 2) if (start + dt.timedelta(days=i)).weekday() < 5][:n]
    return spark.createDataFrame([(d, i + 1) for i, d in enumerate(days)], "date date, day_idx int")


def test_earnings_by_loop_and_no_look_ahead(spark):
    cal = calendar(spark, 700)
    dates = {r.day_idx: r.date for r in cal.collect()}
    marks = [30, 95, 160, 225, 290, 292, 355, 420, 486, 560, 640]
    rows = [("A", m, m != 292) for m in marks] + [("B", 10, True)]
    bars = spark.createDataFrame([(s, i) for s in "ABC" for i in range(1, 701)], "symbol string, day_idx int")
    run = lambda rows, last: {(r.symbol, r.day_idx): r for r in panel.earnings_windows(bars.filter(F.col("day_idx") <= last), spark.createDataFrame(rows, "symbol string, day_idx int, scheduled boolean"), cal).collect()}
    got = run(rows, 700)
    snap = lambda m: next((i for i in range(1, 701) if dates[i] >= dates[m] + dt.timedelta(days=364)), None)
    for (s, i), r in got.items():
        own = [m for g, m, _ in rows if g == s and m <= i]
        if not own:
            assert r.since is None and r.to_est is None
            continue
        due = [a for m in own if (a := snap(m)) and a > own[-1] + 20]
        assert r.since == i - own[-1] and r.to_est == (min(due) - i if due else None), (s, i)
        nxt = [m for g, m, planned in rows if g == s and planned and m >= i]
        assert (r.to, r.to_is_est) == ((nxt[0] - i, 0) if nxt else (r.to_est, None if r.to_est is None else 1))
    assert got["A", 30].window == "Earnings_Day" and got["A", 32].window_pit == "Post_Earnings_Reaction" and got["C", 5].window == "Normal_Trading"
    assert any(r.window_pit == "Earnings_Eve" and r.to_est < 0 for r in got.values())
    for cut in (200, 291, 500):
        before = run([r for r in rows if r[1] <= cut], cut)
        assert all((r.since, r.to_est, r.window_pit) == (got[k].since, got[k].to_est, got[k].window_pit) for k, r in before.items())


def test_panel_rows_do_not_look_ahead(spark, sf, tmp_path, monkeypatch):
    """The panel of the tables cut at a day has the same columns for the rows before it as that of all tables."""
    from marketloom.plans import base
    from marketloom.plans import panel as plans

    cut = dt.date(1996, 6, 28)
    for name in ("supplier", "nation", "region"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{sf}/lineitem.parquet").filter(F.to_date("l_shipdate") <= F.lit(cut)).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{sf}/orders.parquet").filter(F.to_date("o_orderdate") <= F.lit(cut)).write.parquet(f"{tmp_path}/orders.parquet")
    full = {(r.symbol, r.date): r.asDict() for r in plans.whole(spark, sf).collect()}
    # An order's symbols come from its lines, some of which are shipped after the cut; the order itself was known.
    known = base.releases(spark, sf).filter(F.col("date") <= F.lit(cut))
    monkeypatch.setattr(plans, "releases", lambda *_: known)
    monkeypatch.setattr(plans, "_splits", lambda *_: known.filter("form = '1-URGENT' AND order_key % 7 = 0").select("symbol", F.col("date").alias("split_date"), F.lit(0.5).alias("factor")))
    short = {(r.symbol, r.date): r.asDict() for r in plans.whole(spark, str(tmp_path)).collect()}
    shared = [k for k in short if k in full and k[1] < cut - dt.timedelta(days=400)]  # the calendar of anniversaries ends with the data
    assert len(shared) > 50
    # Splits after the cut rescale prices and volumes of all rows before them by one factor; what is left are ratios.
    scaled = {"today_vwap", "vol_10d_mean", "volume", "trades_per_volume"}
    for k in shared:
        a, b = short[k], full[k]
        for c in a:
            if c in AHEAD | scaled or c.startswith("sec_"):
                continue
            assert a[c] == pytest.approx(b[c], rel=1e-6, abs=1e-9) if isinstance(a[c], float) else a[c] == b[c], (k, c, a[c], b[c])


def test_next_rows_are_guarded(spark):
    rows = panel.next_rows(spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string"), spark.createDataFrame([("A", i, 10.0, 100.0, 1.0) for i in range(1, 21)] + [("B", 19, 5.0, 50.0, None)], "symbol string, day_idx int, vwap double, volume double, split_factor double"), 21, "e1")
    day = dt.date(2024, 5, 6)
    prices = spark.createDataFrame([("A", day, 11.0, 20.0), ("B", day, None, 5.0)], "symbol string, date date, last double, open double")
    full = lambda cutoff="09:15", date=day, complete=True: spark.createDataFrame([("A", date, cutoff, 10.5, 10.0, 12.0, 9.0, complete)], "symbol string, date date, cutoff string, pm_vwap double, pm_volume double, pm_high double, pm_low double, complete boolean")
    meta = {"date": day, "cutoff": "09:15", "export_id": "e1"}
    none = spark.createDataFrame([], "symbol string, date date")
    got = {r.symbol: r for r in panel.fill_next(rows, prices, full(), meta, none).collect()}
    assert (round(got["A"].pm_last_pct, 9), got["A"].open_pct, got["A"].pm_px_known, round(got["A"].pm_range_pct, 9), got["A"].pm_full_known) == (0.1, 0.3, 1, 0.3, 1)
    assert (got["B"].pm_px_known, got["C"].pm_full_known, got["C"].vol_10d_mean, got["B"].vol_10d_mean) == (0, 0, None, 50.0)
    assert panel.fill_next(rows, prices, full(complete=False), meta, none).filter("pm_full_known = 1").isEmpty()
    assert panel.fill_next(rows, prices, full(), meta, spark.createDataFrame([("A", day)], "symbol string, date date")).filter("pm_px_known + pm_full_known > 0").isEmpty()
    for records, m, why in ((full("09:00"), meta, "cut-off"), (full(date=day - dt.timedelta(days=1)), meta, "another day"), (full(), meta | {"export_id": "e2"}, "another export")):
        with pytest.raises(ValueError, match=why):
            panel.fill_next(rows, prices, records, m, none)


def test_panel_rows_are_shuffled_by_symbol_alone(spark, sf):
    """Bars, releases and windows keep one partitioning by symbol; none is dealt again by symbol and day."""
    from marketloom.plans import panel as plans

    plan = plans.whole(spark, sf)._jdf.queryExecution().executedPlan().toString()
    keys = [k for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if "symbol" in k]
    assert keys and not [k for k in keys if "date" in k or "day_idx" in k]


def test_days_give_the_earnings_windows(spark):
    """Windows over a symbol's days are those of the as-of lookups, with releases off sessions and after the last one."""
    cal = calendar(spark, 700)
    dates = {r.day_idx: r.date for r in cal.collect()}
    rng = random.Random(3)
    known = [(s, dates[rng.randrange(1, 701)] + dt.timedelta(days=rng.randrange(0, 3)), rng.choice(["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])) for s in "ABC" for _ in range(25)] + [("A", dates[700] + dt.timedelta(days=9), "1-URGENT")]
    releases = spark.createDataFrame([(*r, 0.5, 0.5 if i % 9 == 0 else None) for i, r in enumerate(known)], "symbol string, date date, form string, score double, factor double")
    trades = spark.createDataFrame([(s, dates[i], 10.0 + i % 7, 2.0, i, 3) for s in "ABCD" for i in range(1, 701) if (i * 7 + ord(s)) % 5], "symbol string, date date, price double, volume double, seq1 long, seq2 long")
    got = panel.with_earnings(panel.symbol_days(trades, releases, cal, 3), cal)
    bars = trades.join(cal, "date").select("symbol", "day_idx")
    a = snap_to_session(releases.filter("form < '4'"), "date", cal).filter("day_idx IS NOT NULL").groupBy("symbol", "day_idx").agg(F.bool_or(F.col("form") <= "2").alias("scheduled"))
    want = panel.earnings_windows(bars, a, cal)
    assert {tuple(r) for r in got.select(want.columns).collect()} == {tuple(r) for r in want.collect()}
    splits = [(s, d) for i, (s, d, _) in enumerate(known) if i % 9 == 0]
    for r in got.collect():
        assert r.f == pytest.approx(0.5 ** sum(s == r.symbol and d > dates[r.day_idx] for s, d in splits))
