"""Session series and targets against a plain loop over small feeds."""

import datetime as dt
import math
import random
from statistics import median

from marketloom.operators import session_polls as sp

DAY = dt.datetime(2024, 3, 4)
SCHEMA = "symbol string, date date, ts timestamp, price double, volume double, day_open double, prev_close double"
OPENS, CLOSES = 570, 600


def at(seconds):
    return DAY + dt.timedelta(minutes=OPENS, seconds=seconds)


def frame(spark, rows):
    return spark.createDataFrame([(s, DAY.date(), at(t), p, v, o, c) for s, t, p, v, o, c in rows], SCHEMA)


def series_of(rows):
    """One symbol's (seconds, price, volume, day_open, prev_close) as a loop: base to end, with running sums."""
    rows = sorted(rows)
    carried, most, out = None, 0.0, []
    for t, p, v, o, c in rows:
        carried = p if p is not None else carried
        most = max(most, v or 0.0)
        out.append((t, carried, most, o))
    base = max(i for i, r in enumerate(out) if r[0] <= 0)
    after = [i for i, r in enumerate(out) if r[0] >= 1830]
    kept = out[base : (after[0] if after else len(out) - 1) + 1]
    first = next(r[1] for r in kept if r[1] is not None)
    opened = next((r[3] for r in kept if r[3] is not None), None)
    gaps = [b[0] - a[0] for a, b in zip(kept, kept[1:])]
    short = max(30.0, 2.5 * median(gaps))
    result, v0, pv, cv, sv, side, traded_at, crossed = [], None, 0.0, 0.0, 0.0, 0.0, kept[0][0], False
    for t, p, v, _ in kept:
        p = first if p is None else p
        if v0 is not None:
            dv, mid = v - v0[1], (p + v0[0]) / 2
            if dv > 0:
                mid = opened if opened is not None and not crossed else mid
                crossed, traded_at = True, t
            side = math.copysign(1, p - v0[0]) if p != v0[0] else side
            pv, cv, sv = pv + dv * mid, cv + dv, sv + dv * side
        v0 = (p, v)
        result.append((t, p, cv, pv, sv, traded_at))
    return result, bool(after), short


def feed(seed):
    r, rows, t, v = random.Random(seed), [], -90, 0.0
    while t < 1900:
        v += r.choice([0, 0, 10, 50])
        rows.append((t, r.choice([None, 10.0, 10.1, 10.2, 9.9]), r.choice([None, v, v, v, v / 2]), r.choice([None, None, 10.05]), r.choice([None, 9.8])))
        t += r.choice([10] * 12 + [20] * 12 + [30, 200, 700])
    return rows if any(p is not None for t, p, *_ in rows if t > 0) else feed(seed + 1000)


def test_series_and_targets_are_those_of_a_loop(spark):
    feeds = {f"s{i}": feed(i) for i in range(12)}
    polls = frame(spark, [(s, *r) for s, rows in feeds.items() for r in rows]).cache()
    series = sp.session_series(polls, OPENS, CLOSES).cache()
    seen = {}
    for r in series.orderBy("ts").collect():
        seen.setdefault(r.symbol, []).append(r)
    loops = {s: series_of(rows) for s, rows in feeds.items()}
    for s, (want, covered, short) in loops.items():
        got = [((r.ts - at(0)).total_seconds(), r.price, r.cum_v, r.cum_pv, r.cum_sv, (r.traded_at - at(0)).total_seconds()) for r in seen[s]]
        assert len(got) == len(want) and all(math.isclose(a, b, abs_tol=1e-6) for g, w in zip(got, want) for a, b in zip(g, w)), s
        assert seen[s][0].covered_close == covered and math.isclose(seen[s][0].gap_short, short)
    horizons, checked = {"r_1m": 60, "r_60m": 600}, 0
    found = sp.session_targets(sp.session_grid(series, OPENS, CLOSES, 60), series, horizons, 600, {"r_1m": 2}).collect()
    for row in found:
        want, covered, short = loops[row.symbol]
        a, times = (row.at - at(0)).total_seconds(), [w[0] for w in want]
        end_time = times[-1] if covered else 1830.0
        upto = lambda t: [w for w in want if w[0] <= t][-1]  # noqa: B023, E731
        for bit, (name, k) in enumerate([*horizons.items(), ("r_rod", None)]):
            b = end_time if k is None else min(a + k, end_time)
            limit = short if k == 60 else 600
            gap = any(y - x > limit and y > a and x < b for x, y in zip(times, times[1:]))
            volume = upto(b)[2] - upto(a)[2]
            ok = volume > 0 and not gap and (covered if k is None else b <= times[-1] and b > a)
            ok = ok and (k != 60 or sum(a < t <= b for t in times) >= 2)
            assert bool(row.tmask >> bit & 1) == ok, (row, name)
            if ok:
                checked += 1
                assert math.isclose(row[name], math.log((upto(b)[3] - upto(a)[3]) / volume / upto(a)[1]), abs_tol=1e-9)
            else:
                assert row[name] is None
    assert checked > 50


def test_drops_and_odd_rows(spark):
    rows = [
        ("late", 5, 10.0, 1.0, None, None), ("late", 50, 10.0, 2.0, None, None),  # no poll before the open
        ("early", -5, 10.0, 1.0, None, None),  # none after it
        ("bare", -5, None, 1.0, None, None), ("bare", 50, None, 2.0, None, None),  # no price at all
        ("good", -5, None, None, None, None), ("good", -5, 9.0, 3.0, None, None), ("good", 50, 10.0, 5.0, 9.5, None),
    ]
    polls = frame(spark, rows)
    assert {r.symbol: r.reason for r in sp.series_drops(polls, OPENS, CLOSES).collect()} == {"late": "no_premarket", "early": "no_rth", "bare": "no_rth", "good": "kept"}
    kept = sp.session_series(polls, OPENS, CLOSES).orderBy("ts").collect()
    assert [(r.symbol, r.price, r.traded, r.cum_pv) for r in kept] == [("good", 9.0, 0.0, 0.0), ("good", 10.0, 2.0, 19.0)]  # the opening cross at 9.5
    assert sp.session_series(polls.limit(0), OPENS, CLOSES).count() == 0


def test_one_shuffle(spark):
    polls = frame(spark, [("a", -5, 9.0, 1.0, None, None)]).repartition("symbol", "date")
    plan = sp.session_series(polls, OPENS, CLOSES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
