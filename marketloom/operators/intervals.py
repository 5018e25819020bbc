"""Unions of intervals, and windows that outages leave alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions.expr import ratio
from marketloom.operators.asof import asof_join


def union(intervals: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """(by, start, end): the fewest intervals [start, end] that cover the same times; those that overlap, nest or touch become one.

    One window a key, sorted by start: a new one begins where a start lies after every end before it.
    """
    order = Window.partitionBy(*by).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.filter(F.col(start) <= F.col(end)).withColumn("__new", F.when(F.col(start) <= reach, 0).otherwise(1))
    grouped = marked.withColumn("__g", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*by, "__g").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__g")


def gaps(series: DataFrame, by: list[str], at: str, seconds: int) -> DataFrame:
    """O-76, O-132: (by, start, end) between two neighbouring rows of a key more than so many seconds apart."""
    previous = F.lag(at).over(Window.partitionBy(*by).orderBy(at))
    found = series.select(*by, previous.alias("start"), F.col(at).alias("end")).filter(F.col("start").isNotNull())
    return found.filter(F.unix_micros("end") - F.unix_micros("start") > seconds * 1_000_000)


def untouched(windows: DataFrame, outages: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """windows (start, end) of which none of a key's outages (start, end) holds a time: the last outage that begins before the window's end ended by its start.

    outages are merged first, so the last one to begin is also the last to end, and one as-of lookup decides.
    """
    merged = union(outages.select(*by, F.col("start").alias("__s"), F.col("end").alias("__e")), by, "__s", "__e")
    found = asof_join(windows, merged, by, end, "__s", strict=True)
    return found.filter(F.col("__e").isNull() | (F.col("__e") <= F.col(start))).drop("__s", "__e")


def checkpoints(a: DataFrame, b: DataFrame, outages: DataFrame, points: DataFrame, minutes: dict[str, int | None]) -> DataFrame:
    """O-136b: (symbol, date, at, kind, vwap_a, vwap_b, bp): the VWAPs of two feeds over the same windows before each checkpoint, and their difference in basis points.

    a, b: symbol, date, ts, cum_pv, cum_v (running sums of a day). points: symbol, date, at. minutes: length of each kind of window, None for the day so far. Windows that an outage of either
    feed touches are dropped. Window sums are differences of running sums at two as-of lookups, so there is no range join.
    """
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(m).cast("int").alias("m")) for k, m in minutes.items()]))
    day = F.col("date").cast("timestamp")
    asked = points.select("symbol", "date", "at", kinds.alias("k")).select("symbol", "date", "at", "k.kind", F.when(F.isnull("k.m"), day).otherwise(F.greatest(day, F.timestamp_add("MINUTE", -F.col("k.m"), F.col("at")))).alias("since"))
    clear = untouched(asked, outages, ["symbol", "date"], "since", "at")

    def sums(df: DataFrame, feed: DataFrame, tag: str) -> DataFrame:
        own = feed.select("symbol", "date", "ts", F.col("cum_pv").alias("pv"), F.col("cum_v").alias("v"))
        later = asof_join(df, own, ["symbol", "date"], "at", "ts", prefix="e_").drop("e_ts")
        both = asof_join(later, own, ["symbol", "date"], "since", "ts", prefix="s_").drop("s_ts")
        part: Column = ratio(F.col("e_pv") - F.coalesce("s_pv", F.lit(0.0)), F.col("e_v") - F.coalesce("s_v", F.lit(0.0)))
        return both.withColumn(f"vwap_{tag}", part).drop("e_pv", "e_v", "s_pv", "s_v")

    out = sums(sums(clear, a, "a"), b, "b")
    return out.select("symbol", "date", "at", "kind", "vwap_a", "vwap_b", (10_000 * (ratio("vwap_a", "vwap_b") - 1)).alias("bp"))
