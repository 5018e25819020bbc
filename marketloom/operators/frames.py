"""Model frames: staggered decisions, categories, robust scales, known shares, indicators, visits and time-weighted prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions.expr import ratio
from marketloom.operators import ranks


def staggered(minutes: DataFrame, every: int) -> DataFrame:
    """O-155, O-106: rows of every `every`-th step of a stock-day, each stock-day with an offset of its own from a hash of its key."""
    w = Window.partitionBy("symbol", "date").orderBy("minute")
    offset = F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", F.col("symbol").cast("string"), F.col("date").cast("string"))), 1, 8), 16, 10).cast("long"), F.lit(every))
    return minutes.withColumn("__i", F.row_number().over(w) - 1).filter(F.pmod(F.col("__i"), F.lit(every)) == offset).drop("__i")


def vocabulary(rows: DataFrame, value: str, session: str, least: int) -> DataFrame:
    """O-157: (value, code) of values seen in at least `least` sessions, codes from 1 in order of the values; others are 0.

    value is a number. Values are numbered in slots, so that a vocabulary may be large.
    """
    known = rows.groupBy(F.col(value).alias("value")).agg(F.count_distinct(session).alias("n")).filter(F.col("n") >= least)
    return ranks.numbered(known, "value", "code")


def coded(rows: DataFrame, value: str, codes: DataFrame, name: str) -> DataFrame:
    """O-157: rows with the code of a value, 0 where it is unknown."""
    c = codes.select(F.col("value").alias("__v"), F.col("code").alias("__c"))
    return rows.join(c, F.col(value) == F.col("__v"), "left").withColumn(name, F.coalesce("__c", F.lit(0))).drop("__v", "__c")


def scaled(rows: DataFrame, columns: list[str], limit: float = 5.0) -> DataFrame:
    """O-157, O-55: (x - median) / (IQR / 1.349) within +-limit, 0 where x is unknown."""
    out = rows
    for c in columns:
        out = out.crossJoin(F.broadcast(ranks.quantiles(rows, [], c, [0.25, 0.5, 0.75]).select(F.col("q").alias(f"__q_{c}"))))  # one row

    def z(c: str) -> Column:
        at = lambda i: F.get(F.col(f"__q_{c}"), F.lit(i))
        v = ratio(F.col(c) - at(1), (at(2) - at(0)) / 1.349)
        return F.coalesce(F.greatest(F.lit(-limit), F.least(F.lit(limit), v)), F.lit(0.0)) if c else v

    return out.withColumns({c: F.when(F.col(c).isNull(), F.lit(0.0)).otherwise(z(c)) for c in columns}).drop(*[f"__q_{c}" for c in columns])


def normal_shares(minutes: DataFrame) -> DataFrame:
    """O-140, O-156: each minute's share of its day's normal volume, the share still to come and minutes to the last one."""
    day = Window.partitionBy("symbol", "date")
    after = day.orderBy("minute").rowsBetween(1, Window.unboundedFollowing)
    to_close = (F.unix_seconds(F.max("minute").over(day)) - F.unix_seconds("minute")) / 60
    return minutes.select("symbol", "date", "minute", ratio(F.col("volume"), F.sum("volume").over(day)).alias("share"), F.coalesce(ratio(F.sum("volume").over(after), F.sum("volume").over(day)), F.lit(0.0)).alias("to_come"), to_close.cast("long").alias("to_close"))


def indicators(minutes: DataFrame, steps: list[int]) -> DataFrame:
    """O-158, O-137: returns, range and place of the close over trailing windows of steps, deviation from the running VWAP."""
    by = Window.partitionBy("symbol", "date").orderBy("minute")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    out = [F.col("symbol"), F.col("date"), F.col("minute")]
    for n in steps:
        w = by.rowsBetween(-n + 1, 0)
        high, low = F.max("high").over(w), F.min("low").over(w)
        out += [F.ln(ratio(F.col("close"), F.lag("close", n).over(by))).alias(f"ret_{n}"), ratio(high - low, F.col("close")).alias(f"range_{n}"), ratio(F.col("close") - low, high - low).alias(f"place_{n}")]
    vwap = ratio(F.sum(F.col("vwap") * F.col("volume")).over(upto), F.sum("volume").over(upto))
    return minutes.select(*out, (ratio(F.col("close"), vwap) - 1).alias("off_vwap"))


def visits(minutes: DataFrame, near: float) -> DataFrame:
    """O-146: how often a stock-day comes near its high so far, and the mean length of a visit in rows."""
    by = Window.partitionBy("symbol", "date").orderBy("minute")
    high = F.max("high").over(by.rowsBetween(Window.unboundedPreceding, 0))
    m = minutes.withColumn("__n", F.col("close") >= high * (1 - near))
    m = m.withColumn("__s", F.when(F.col("__n") & ~F.coalesce(F.lag("__n").over(by), F.lit(False)), 1).otherwise(0))
    return m.groupBy("symbol", "date").agg(F.sum("__s").alias("visits"), ratio(F.sum(F.col("__n").cast("int")), F.sum("__s")).alias("mean_rows"))


def time_weighted(series: DataFrame) -> DataFrame:
    """O-147: time-weighted price of each hour (each poll counts until the next of the day) and its gap to the hour's VWAP."""
    by = Window.partitionBy("symbol", "date").orderBy("ts")
    held = (F.unix_micros(F.lead("ts").over(by)) - F.unix_micros("ts")) / 1e6
    h = series.withColumns({"__h": F.coalesce(held, F.lit(0.0)), "hour": F.date_trunc("hour", "ts")})
    g = h.groupBy("symbol", "date", "hour").agg(ratio(F.sum(F.col("price") * F.col("__h")), F.sum("__h")).alias("twap"), ratio(F.sum(F.col("price") * F.col("volume")), F.sum("volume")).alias("vwap"))
    return g.withColumn("gap", ratio(F.col("vwap"), F.col("twap")) - 1)
