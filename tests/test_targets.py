"""Duration bins and row targets by hand."""

import datetime as dt
import math

import pytest

from marketloom.operators import paths

DAY = dt.datetime(2024, 3, 4)


def minute(m):
    return DAY + dt.timedelta(minutes=m)


@pytest.fixture(scope="module")
def made(spark):
    e = math.e
    rows = [  # minute, high, low, vwap, volume, normal: entry 1 at 600, sigma 1, so that places are logs
        (601, e, 1.0, e, 10.0, 5.0),
        (603, 1.0, 1 / e, 1 / e, 30.0, 5.0),
        (606, e**2, 1.0, e**2, 20.0, None),
        (608, 1.0, 1.0, None, 99.0, 1.0),
    ]
    minutes = spark.createDataFrame([("a", DAY.date(), minute(m), *r) for m, *r in rows], "symbol string, date date, minute timestamp, high double, low double, vwap double, volume double, normal double")
    entries = spark.createDataFrame([("a", DAY.date(), minute(600), 1.0, 1.0, 100.0), ("b", DAY.date(), minute(600), 1.0, 1.0, 100.0)], "symbol string, date date, at timestamp, entry double, sigma double, typical double")
    return minutes, entries


def test_bins(made):
    minutes, entries = made
    out = {(r.symbol, r.bin): r for r in paths.bin_targets(minutes, entries, [(0, 5), (5, 15), (30, None)], 610).collect()}
    first, second, third = (out["a", i] for i in (1, 2, 3))
    assert (first.volume, first.bulge, first.sag, first.mass_up, first.mass_dn, first.net) == pytest.approx((40, 0.25, 0.75, 0.25, 0.75, -0.5))
    assert (first.cm_up, first.cm_dn, first.rvol, first.pi_up, first.cut, first.mins) == pytest.approx((1, 1, math.log(41 / 11), 0.25 * 4 / 5, 0, 5))
    # A minute without a price gives no volume, but its normal volume counts; the close cuts the bin to five minutes.
    assert (second.volume, second.bulge, second.cm_dn, second.rvol, second.cut, second.mins) == (20, pytest.approx(2), None, pytest.approx(math.log(21 / 2)), 1, 5)
    assert (third.volume, third.bulge, third.mins, third.cut) == (0, None, 0, 0)  # nothing is left of the day
    assert (out["b", 1].volume, out["b", 1].bulge, out["b", 1].rvol, out["b", 1].pi_up) == (0, None, 0, None)
    peak = {r.symbol: (r.peak_up, r.peak_dn) for r in paths.peak_bins(paths.bin_targets(minutes, entries, [(0, 5), (5, 15)], 610)).collect()}
    assert peak == {"a": (2, 1), "b": (None, None)}


def test_rows(made):
    minutes, entries = made
    (r,) = paths.row_targets(minutes, entries, 60, 610, move=1.0, race=1.0).collect()  # no row for b
    assert (r.symbol, r.t50_up, r.t50_dn, r.race) == ("a", 6, 3, 0)  # 10 of 50 up at 1, all at 6; a touch of one sigma up comes first
    assert (r.vol_to_up, r.vol_to_dn) == pytest.approx((0.1, 0.4))
    assert (r.bulge, r.sag, r.mass_up) == pytest.approx((50 / 60, 0.5, 0.5))
    assert paths.row_targets(minutes, entries, 60, 610, move=9.0).first().vol_to_up == 1.0
