"""Profiles against a loop over the seconds of a day."""

import datetime as dt
import math
import random
from collections import defaultdict

from marketloom.operators import profiles

DAY, OPENS, STEP, WIDTH, HALF = dt.datetime(2024, 3, 4), 570, 60, 0.1, 120.0


def at(s):
    return DAY + dt.timedelta(minutes=OPENS, seconds=s)


def place(price, ref, sigma):
    return math.floor(math.log(price / ref) / sigma / WIDTH + 0.5)


def test_profiles_are_those_of_a_loop(spark):
    r = random.Random(5)
    polls = {}
    for s in ("a", "b"):
        times = sorted(r.sample(range(-20, 900), 60))
        times[0] = -20
        polls[s] = [(x, r.choice([9.8, 9.9, 10.0, 10.1, 10.3]), float(r.choice([0, 0, 5, 20]))) for x in times]
    series = spark.createDataFrame([(s, DAY.date(), at(x), p, v) for s, rows in polls.items() for x, p, v in rows], "symbol string, date date, ts timestamp, price double, traded double")
    scale = {"a": (10.0, 0.05, 100.0), "b": (9.9, 0.02, 50.0)}
    scales = spark.createDataFrame([(s, DAY.date(), ref, sig) for s, (ref, sig, _) in scale.items()] + [("none", DAY.date(), None, 0.1)], "symbol string, date date, ref double, sigma double")
    cells = profiles.cells(series, scales, OPENS, STEP, WIDTH, HALF)
    ends = range(60, 900, 60)
    points = []
    for s, rows in polls.items():
        for e in ends:
            points.append((s, DAY.date(), at(e), [p for x, p, _ in rows if x <= e][-1], *scale[s]))
    points.append(("none", DAY.date(), at(60), 1.0, None, 0.1, 1.0))
    frame = spark.createDataFrame(points, "symbol string, date date, at timestamp, price double, ref double, sigma double, typical double")
    got = {(x.symbol, (x.at - at(0)).total_seconds()): x for x in profiles.profiles(frame, cells, WIDTH, HALF, near=0.2).collect()}
    assert len(got) == 2 * len(ends)
    for s, _, when, price, ref, sigma, typical in points[:-1]:
        e, rows = (when - at(0)).total_seconds(), polls[s]
        seconds, faded, volume = defaultdict(float), defaultdict(float), defaultdict(float)
        for (x, p, v), nxt in zip(rows, [*[y[0] for y in rows[1:]], None]):
            b, start = place(p, ref, sigma), max(x, 0)
            if math.ceil(start / STEP) * STEP <= e:
                volume[b] += v
            for sec in range(start, start if nxt is None else min(nxt, int(e))):
                seconds[b] += 1
                faded[b] += HALF / math.log(2) * (2 ** ((sec + 1 - e) / HALF) - 2 ** ((sec - e) / HALF))
        now, total, mass = place(price, ref, sigma), sum(seconds.values()), sum(faded.values())
        hi, lo = max(b for b in seconds if seconds[b]), min(b for b in seconds if seconds[b])
        reach = max(math.floor(math.log(1.01) / sigma / WIDTH + 0.5), 1)
        row, vol = got[s, e], sum(volume.values())
        poc = max(seconds, key=lambda b: (seconds[b], -b))
        want = {
            "poc": (poc - now) * WIDTH, "time_above": sum(v for b, v in seconds.items() if b > now) / total, "dwell": seconds[now] / total,
            "time_above_faded": sum(v for b, v in faded.items() if b > now) / mass, "dwell_faded": faded[now] / mass,
            "linger_high": sum(v for b, v in seconds.items() if b >= hi - 2) / total, "linger_low": sum(v for b, v in seconds.items() if b <= lo + 2) / total,
            "volume_up": sum(v for b, v in volume.items() if now < b <= now + reach) / typical, "volume_down": sum(v for b, v in volume.items() if now - reach <= b < now) / typical,
        }
        for name, value in want.items():
            assert math.isclose(row[name], value, abs_tol=1e-9), (s, e, name, row[name], value)
        assert row.accept is None if not volume[now] else math.isclose(row.accept, (seconds[now] / total) / (volume[now] / vol))
    assert profiles.cells(series.limit(0), scales, OPENS, STEP, WIDTH, HALF).count() == 0
