"""Merged intervals and untouched windows against sets of seconds."""

import datetime as dt
import random

from marketloom.operators import intervals

T = dt.datetime(2024, 1, 2)
at = lambda s: T + dt.timedelta(seconds=s)


def test_union_and_untouched(spark):
    rng = random.Random(1)
    outs = [("a", s, s + rng.randrange(0, 40)) for s in (rng.randrange(0, 600) for _ in range(25))] + [("a", 100, 300), ("a", 150, 200), ("a", 300, 310), ("b", 5, 5), ("c", 9, 3)]
    windows = [(g, s, s + n) for g in "abcd" for s in range(0, 640, 7) for n in (1, 20, 120)]
    o = spark.createDataFrame([(g, at(s), at(e)) for g, s, e in outs], "g string, start timestamp, end timestamp")
    w = spark.createDataFrame([(g, at(s), at(e)) for g, s, e in windows], "g string, since timestamp, until timestamp")
    merged = [(r.g, (r.start - T).seconds, (r.end - T).seconds) for r in intervals.union(o, ["g"], "start", "end").collect()]
    cover = lambda rows, g: {x / 2 for k, s, e in rows if k == g for x in range(2 * s, 2 * e + 1)}
    for g in "ab":
        own = sorted(m[1:] for m in merged if m[0] == g)
        assert cover(merged, g) == cover(outs, g) and all(a[1] < b[0] for a, b in zip(own, own[1:]))
    assert not [m for m in merged if m[0] == "c"]
    got = {(r.g, r.since, r.until) for r in intervals.untouched(w, o, ["g"], "since", "until").collect()}
    want = {(g, at(s), at(e)) for g, s, e in windows if not any(k == g and a <= b and a < e and b > s for k, a, b in outs)}
    assert got == want and 0 < len(want) < len(windows)
