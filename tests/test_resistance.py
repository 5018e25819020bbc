"""Balances of trailing spans against a loop over all polls, from running sums only."""

import datetime as dt
import math
import random

from marketloom.operators import paths


def series_of(spark):
    r = random.Random(11)
    rows = []
    for symbol in "AB":
        for day in (1, 2):
            at = sorted({0.0, 0.5, 60.0, 119.999, 120.0, 120.7, 180.0, 240.0} | {r.choice([r.randrange(900), r.random() * 900]) for _ in range(120)})
            rows += [(symbol, dt.date(2024, 1, day), dt.datetime(2024, 1, day, 10) + dt.timedelta(seconds=t), r.choice([9.0, 10.0, 11.0]), float(r.randrange(1, 9)), float(r.choice([-1, 0, 1]))) for t in at]
    return rows, spark.createDataFrame(rows, "symbol string, date date, ts timestamp, price double, volume double, side double")


def test_resistance_by_loop(spark):
    rows, series = series_of(spark)
    got = {(x.symbol, x.ts): (x.balance_1m, x.balance_4m) for x in paths.resistance(series, [1, 4]).collect()}
    assert len(got) == len(rows)
    held = []
    for i, (symbol, day, ts, price, volume, side) in enumerate(rows):
        step = math.log(price / rows[i - 1][3]) if i and rows[i - 1][:2] == (symbol, day) else 0.0
        held.append((symbol, day, int(ts.replace(tzinfo=dt.timezone.utc).timestamp()), volume * (side > 0), volume * (side < 0), max(step, 0.0), max(-step, 0.0)))
    for (symbol, day, t, *_), row in zip(held, rows):
        for m, value in zip((1, 4), got[symbol, row[2]]):
            u, d, pu, pd = (sum(h[k] for h in held if h[:2] == (symbol, day) and t - 60 * m <= h[2] <= t) for k in (3, 4, 5, 6))
            assert math.isclose(value, math.log((u / (pu + 0.01) + 1) / (d / (pd + 0.01) + 1)), rel_tol=1e-9, abs_tol=1e-12)


def test_no_row_reads_its_whole_span(spark):
    plan = paths.resistance(series_of(spark)[1], [1])._jdf.queryExecution().executedPlan().toString()
    assert "RangeFrame" not in plan and "unboundedpreceding" in plan.lower()
