"""Announcements of three sources: groups, lone releases, missing reports, timing and ties."""

import datetime as dt

from marketloom.operators.announcements import announcements

START = dt.date(2024, 1, 1)
DAYS = [START + dt.timedelta(days=i) for i in range(120)]


def at(day, hour):
    return dt.datetime.combine(DAYS[day], dt.time()) + dt.timedelta(hours=hour)


def test_groups_sources_and_timing(spark):
    weekdays = [d for i, d in enumerate(DAYS) if i % 7 < 5]
    sessions = spark.createDataFrame([(d, i + 1) for i, d in enumerate(weekdays)], "date date, day_idx int")
    rows = [
        ("a", "8-K", "1", at(0, 8), DAYS[0], True), ("a", "8-K", "2", at(2, 17), DAYS[2], True), ("a", "10-Q", "3", None, DAYS[7], False),  # the second one is scheduled
        ("a", "8-K", "4", at(4, 16), DAYS[4], True),  # Friday after the close: the next Monday, which is the report's own day
        ("b", "8-K", "5", None, DAYS[1], True), ("b", "10-K", "6", None, DAYS[100], False),  # the report is too far away
        ("c", "10-K", "7", None, DAYS[3], False), ("c", "10-K", "8", None, DAYS[3], False),  # no release: the larger accession
        ("d", "8-K", "9", at(1, 10), DAYS[1], True), ("d", "8-K", "10", at(8, 10), DAYS[8], True),  # after the latest report: one group
        ("e", "S-1", "11", at(1, 10), DAYS[1], False), ("f", "8-K", "12", at(0, -30), DAYS[0], True),  # another form; before the calendar
        ("g", "8-K", "13", at(119, 20), DAYS[119], True),  # beyond the calendar
    ]
    filings = spark.createDataFrame(rows, "symbol string, form string, accession string, accepted_at timestamp, filing_date date, is_release boolean")
    vendor = spark.createDataFrame([("a", "10-K", DAYS[50]), ("e", "10-K", DAYS[5]), ("e", "10-K", DAYS[5]), ("e", "8-K", DAYS[9]), ("g", "10-Q", DAYS[9]), ("h", "10-Q", None)], "symbol string, form string, filing_date date")
    out = {(r.symbol, r.day_idx): (r.source, r.scheduled, r.timing, r.accession) for r in announcements(filings, vendor, sessions).collect()}
    assert out == {
        ("a", 1): ("release", False, "before_open", "1"), ("a", 4): ("release", False, "after_close", "2"), ("a", 6): ("release", True, "after_close", "4"),
        ("b", 2): ("release", True, None, "5"), ("b", 73): ("10-K", True, None, "6"),
        ("c", 4): ("10-K", True, None, "8"),
        ("d", 2): ("release", False, "market_hours", "9"), ("d", 7): ("release", True, "market_hours", "10"),
        ("e", 6): ("vendor 10-K", True, None, None),
    }
    assert announcements(filings.limit(0), vendor.limit(0), sessions).count() == 0
