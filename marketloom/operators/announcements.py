"""Results announcements from three sources of filings, the best one first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.operators.asof import asof_join, latest, snap_to_session

REPORTS = ("10-K", "10-Q")


def announcements(filings: DataFrame, vendor: DataFrame, sessions: DataFrame, most_sessions: int = 50, closes: int = 960, opens: int = 570) -> DataFrame:
    """O-110: (symbol, day_idx, date, source, scheduled, accepted_at, timing, accession), one row for each symbol and session.

    filings: symbol, form, accession, accepted_at (may be NULL), filing_date, is_release; forms other than releases and REPORTS are left out. vendor: symbol, form, filing_date, for symbols that have no
    filings. A release counts for the day of its acceptance, from the close on for the next one; without a time, as reports do, for its filing date; either for the first session on or after it. Those
    before the calendar are left out. A release belongs to the first report from one session before it to most_sessions after it; the last of such a group is scheduled. One whose next
    report is further away stands alone; those after the latest report are one group. A report without a release, and then the vendor's, is scheduled, too. Of a symbol's events of a session the better
    source counts, then scheduled, then the latest accepted, then source, then the largest accession. Each step is a shuffle by symbol; only the calendar (a row a day) is broadcast.
    """
    minute = F.hour("accepted_at") * 60 + F.minute("accepted_at")
    timed = F.col("is_release") & F.col("accepted_at").isNotNull()
    react = F.when(timed, F.date_add(F.to_date("accepted_at"), (minute >= closes).cast("int"))).otherwise(F.col("filing_date"))
    start = F.broadcast(sessions.agg(F.min("date").alias("__start")))  # one row
    known = filings.filter(F.col("is_release") | F.col("form").isin(*REPORTS)).withColumn("react", react).crossJoin(start).filter("react >= __start").drop("__start")
    placed = snap_to_session(known, "react", sessions)
    found = placed.filter("day_idx IS NOT NULL")
    reports = found.filter(~F.col("is_release"))
    days = reports.select("symbol", F.col("day_idx").alias("report_day")).distinct()
    releases = asof_join(found.filter("is_release").withColumn("__from", F.col("day_idx") - 1), days, ["symbol"], "__from", "report_day", "forward")
    group = F.when(F.col("report_day") <= F.col("day_idx") + most_sessions, F.col("report_day")).when(F.col("report_day").isNotNull(), -F.col("day_idx"))
    releases = releases.withColumn("grp", group)
    last = F.max("day_idx").over(Window.partitionBy("symbol", "grp"))
    event = lambda df, source, scheduled, at, accession, rank: df.select("symbol", "day_idx", source.alias("source"), scheduled.alias("scheduled"), at.alias("accepted_at"), accession.alias("accession"), F.lit(rank).alias("__rank"))
    none = F.lit(None)
    first = event(releases, F.lit("release"), F.col("day_idx") == last, F.col("accepted_at"), F.col("accession"), 0)
    taken = releases.select("symbol", F.col("grp").alias("day_idx")).distinct()
    second = event(reports.join(taken, ["symbol", "day_idx"], "left_anti"), F.col("form"), F.lit(True), none.cast("timestamp"), F.col("accession"), 1)
    others = vendor.filter(F.col("form").isin(*REPORTS)).join(known.select("symbol").distinct(), "symbol", "left_anti").crossJoin(start).filter("filing_date >= __start").drop("__start")
    others = snap_to_session(others, "filing_date", sessions).filter("day_idx IS NOT NULL")
    third = event(others, F.concat(F.lit("vendor "), "form"), F.lit(True), none.cast("timestamp"), none.cast("string"), 2)
    order = [F.col("__rank"), F.desc("scheduled"), F.desc_nulls_last("accepted_at"), F.col("source"), F.desc_nulls_last("accession")]
    one = latest(first.union(second).union(third), ["symbol", "day_idx"], order).join(F.broadcast(sessions.select("day_idx", "date")), "day_idx")
    timing = F.when(F.col("accepted_at").isNull(), None).when(F.col("date") > F.to_date("accepted_at"), "after_close").when(minute < opens, "before_open").when(minute < closes, "market_hours").otherwise("after_close")
    return one.select("symbol", "day_idx", "date", "source", "scheduled", "accepted_at", timing.alias("timing"), "accession")
