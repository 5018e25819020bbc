"""Where a poll's price shows up: every kind, ties, and polls without a bar."""

import datetime as dt

from marketloom.operators.feeds import SIGHTINGS, sightings

DAY = dt.datetime(2024, 3, 4, 10)


def at(s):
    return DAY + dt.timedelta(seconds=s)


def test_every_kind(spark):
    cases = {  # price, bars (end, low, high, close), previous close
        "a": (10.0, [(2, 9, 10, 10.0)], None), "b": (10.0, [(-1, 9, 10, 10.0), (1, 9, 10, 10.0)], None), "c": (10.0, [(1, 9, 11, 9.5)], None), "d": (10.0, [(-8, 9, 11, 9.5), (9, 9, 10, 10.0)], None),
        "e": (10.0, [(100, 9, 11, 10.0), (121, 9, 11, 10.0)], None), "f": (10.0, [(1, 8, 9, 9.0)], 10.0), "g": (10.0, [], 9.0), "h": (None, [(1, 8, 9, 9.0)], None),
    }
    polls = spark.createDataFrame([(s, DAY.date(), 1, at(0), p) for s, (p, _, _) in cases.items()], "symbol string, date date, poll_id long, at timestamp, price double")
    bars = spark.createDataFrame([(s, at(e), float(low), float(high), float(c)) for s, (_, rows, _) in cases.items() for e, low, high, c in rows], "symbol string, bar_end timestamp, low double, high double, close double")
    previous = spark.createDataFrame([(s, DAY.date(), c) for s, (_, _, c) in cases.items()], "symbol string, date date, previous_close double")
    got = {r.symbol: (SIGHTINGS.index(r.sighting), r.off_close, r.off_range) for r in sightings(polls, bars, previous, 2, 10, 120, 5e-5).collect()}
    assert got == {"a": (0, 2.0, 2.0), "b": (1, -1.0, 1.0), "c": (2, None, 1.0), "d": (3, 9.0, 8.0), "e": (4, None, 100.0), "f": (5, None, None), "g": (6, None, None), "h": (6, None, None)}
    assert sightings(polls, bars.limit(0), previous.limit(0), 2, 10, 120, 5e-5).filter("sighting = 'not printed'").count() == 8
