"""Poll series, minute grids, windows over polls, tick rules, profiles, pockets, zig-zag legs and targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions.expr import ratio
from marketloom.operators.asof import asof_join


def poll_series(polls: DataFrame) -> DataFrame:
    """O-130, O-142: polls (symbol, date, ts, price, volume) with running sums, tick-rule side and squared returns.

    Equal times keep the row with the larger volume, then price. A price change gives the side of a trade; without one the last
    side stays.
    """
    one = polls.groupBy("symbol", "date", "ts").agg(F.max(F.struct("volume", "price")).alias("x")).select("symbol", "date", "ts", F.col("x.price").alias("price"), F.col("x.volume").alias("volume"))
    w = Window.partitionBy("symbol", "date").orderBy("ts")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    sign = F.signum(F.col("price") - F.lag("price").over(w))
    s = one.withColumns({"__sign": F.when(sign != 0, sign), "__r": F.ln(ratio(F.col("price"), F.lag("price").over(w)))})
    s = s.withColumn("side", F.coalesce(F.last("__sign", ignorenulls=True).over(upto), F.lit(0.0)))
    return s.select(
        "symbol", "date", "ts", "price", "volume", "side",
        F.sum("volume").over(upto).alias("cum_v"),
        F.sum(F.col("price") * F.col("volume")).over(upto).alias("cum_pv"),
        F.sum(F.col("side") * F.col("volume")).over(upto).alias("cum_sv"),
        F.sum(F.coalesce(F.col("__r") * F.col("__r"), F.lit(0.0))).over(upto).alias("cum_rv"),
        F.max("price").over(upto).alias("high"),
        F.min("price").over(upto).alias("low"),
        F.count("*").over(upto).alias("n"),
    )


def grid(series: DataFrame, step_minutes: int, first_hour: int = 0, last_hour: int = 24) -> DataFrame:
    """O-134, O-106: (symbol, date, at) every step of each day that a symbol has polls on."""
    days = series.select("symbol", "date").distinct()
    start = F.timestamp_add("HOUR", F.lit(first_hour), F.col("date").cast("timestamp"))
    end = F.timestamp_add("HOUR", F.lit(last_hour), F.col("date").cast("timestamp"))
    return days.select("symbol", "date", F.explode(F.sequence(start, end, F.expr(f"INTERVAL {step_minutes} MINUTES"))).alias("at"))


def windows_at(points: DataFrame, series: DataFrame, minutes: list[int]) -> DataFrame:
    """O-33, O-131: for each point (symbol, date, at) the VWAP and volume of the last m minutes, for each m.

    Any window (a, b] is the difference of two as-of lookups of running sums, so windows cost no range join.
    """
    sums = series.select("symbol", "date", F.col("ts").alias("__ts"), "cum_v", "cum_pv", "n")
    looked = points.select("symbol", "date", "at", F.lit(0).alias("m"))
    for m in minutes:
        looked = looked.unionByName(points.select("symbol", "date", "at", F.lit(m).alias("m")))
    looked = looked.withColumn("__t", F.timestamp_add("MINUTE", -F.col("m"), F.col("at")))
    hit = asof_join(looked, sums, ["symbol", "date"], "__t", "__ts")
    zero = lambda c, m: F.coalesce(F.max(F.when(F.col("m") == m, F.col(c))), F.lit(0.0))
    out = hit.groupBy("symbol", "date", "at").agg(*[zero(c, m).alias(f"{c}_{m}") for m in (0, *minutes) for c in ("cum_v", "cum_pv")])
    columns = {}
    for m in minutes:
        columns[f"volume_{m}m"] = F.col("cum_v_0") - F.col(f"cum_v_{m}")
        columns[f"vwap_{m}m"] = ratio(F.col("cum_pv_0") - F.col(f"cum_pv_{m}"), F.col("cum_v_0") - F.col(f"cum_v_{m}"))
    columns["session_vwap"] = ratio(F.col("cum_pv_0"), F.col("cum_v_0"))
    return out.withColumns(columns).select("symbol", "date", "at", *columns)


def minute_bars(polls: DataFrame, minutes: int = 1) -> DataFrame:
    """O-37, O-239: OHLC, volume and VWAP of each bucket of minutes."""
    bucket = F.window("ts", f"{minutes} minutes")["start"]
    order = F.struct("ts", "price")
    return polls.withColumn("minute", bucket).groupBy("symbol", "date", "minute").agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("volume").alias("volume"), ratio(F.sum(F.col("price") * F.col("volume")), F.sum("volume")).alias("vwap"))


def dense(bars: DataFrame, step_minutes: int) -> DataFrame:
    """O-38: every step between a symbol-day's first and last bar: no bar gives volume 0 and the last close carried on.

    VWAP, high and low fall back to the carried close; the open stays NULL.
    """
    span = bars.groupBy("symbol", "date").agg(F.min("minute").alias("a"), F.max("minute").alias("b"))
    every = span.select("symbol", "date", F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {step_minutes} MINUTES"))).alias("minute"))
    w = Window.partitionBy("symbol", "date").orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    filled = every.join(bars, ["symbol", "date", "minute"], "left").withColumn("__c", F.last("close", ignorenulls=True).over(w))
    return filled.select("symbol", "date", "minute", "open", *[F.coalesce(c, "__c").alias(c) for c in ("high", "low", "vwap")], F.col("__c").alias("close"), F.coalesce("volume", F.lit(0.0)).alias("volume"))


def running_extremes(minutes: DataFrame) -> DataFrame:
    """O-73, O-74: high and low so far, minutes since each, place in the range, and the high and low still to come."""
    by = Window.partitionBy("symbol", "date").orderBy("minute")
    upto, after = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(1, Window.unboundedFollowing)
    s = minutes.withColumns({"high_so_far": F.max("high").over(upto), "low_so_far": F.min("low").over(upto)})
    new_high = F.last(F.when(F.col("high") == F.col("high_so_far"), F.col("minute")), ignorenulls=True).over(upto)
    new_low = F.last(F.when(F.col("low") == F.col("low_so_far"), F.col("minute")), ignorenulls=True).over(upto)
    since = lambda t: ((F.unix_seconds("minute") - F.unix_seconds(t)) / 60).cast("long")
    return s.select(
        "symbol", "date", "minute", "high_so_far", "low_so_far",
        since(new_high).alias("since_high"), since(new_low).alias("since_low"),
        ratio(F.col("close") - F.col("low_so_far"), F.col("high_so_far") - F.col("low_so_far")).alias("in_range"),
        F.max("high").over(after).alias("high_to_come"), F.min("low").over(after).alias("low_to_come"),
    )


def typical_curve(minutes: DataFrame) -> DataFrame:
    """O-49: mean share of a day's volume traded by each minute of the day."""
    day = Window.partitionBy("symbol", "date")
    share = ratio(F.sum("volume").over(day.orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)), F.sum("volume").over(day))
    m = (F.hour("minute") * 60 + F.minute("minute")).alias("minute_of_day")
    return minutes.select(m, share.alias("share")).groupBy("minute_of_day").agg(F.avg("share").alias("share"), F.count("*").alias("n"))


def target_mask(points: DataFrame, series: DataFrame, horizons: list[int]) -> DataFrame:
    """O-135, O-105: log changes from the price at each point to the price m minutes later, and a mask of the valid ones.

    A target counts if a poll lies in the span.
    """
    sums = series.select("symbol", "date", F.col("ts").alias("__ts"), "price", "n")
    looked = points.select("symbol", "date", "at", F.lit(0).alias("m"))
    for m in horizons:
        looked = looked.unionByName(points.select("symbol", "date", "at", F.lit(m).alias("m")))
    hit = asof_join(looked.withColumn("__t", F.timestamp_add("MINUTE", F.col("m"), F.col("at"))), sums, ["symbol", "date"], "__t", "__ts")
    pick = lambda c, m: F.max(F.when(F.col("m") == m, F.col(c)))
    wide = hit.groupBy("symbol", "date", "at").agg(*[pick(c, m).alias(f"{c}_{m}") for m in (0, *horizons) for c in ("price", "n")])
    valid = {m: F.col("price_0").isNotNull() & (F.col(f"n_{m}") > F.col("n_0")) for m in horizons}
    mask = sum((F.when(F.coalesce(v, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, v in enumerate(valid.values())), F.lit(0))
    return wide.select("symbol", "date", "at", *[F.when(v, F.ln(ratio(F.col(f"price_{m}"), F.col("price_0")))).alias(f"r_{m}m") for m, v in valid.items()], mask.cast("int").alias("tmask"))


def pockets(minutes: DataFrame, entries: DataFrame, horizon: int) -> DataFrame:
    """O-148, O-149: volume-weighted pocket of each entry (symbol, date, at, entry): bulge, sag and mass above and below its price.

    A join of a symbol-day's entries with its later minutes inside the horizon: bounded by the minutes of a day.
    """
    later = minutes.select("symbol", "date", "minute", F.col("vwap").alias("p"), F.col("volume").alias("v"))
    at = F.unix_seconds("at")
    joined = entries.join(later, ["symbol", "date"]).filter((F.unix_seconds("minute") > at) & (F.unix_seconds("minute") <= at + 60 * horizon))
    d, v = F.ln(ratio(F.col("p"), F.col("entry"))), F.col("v")
    total = F.sum("v")
    up, down = F.when(d > 0, d), F.when(d < 0, d)
    return joined.groupBy("symbol", "date", "at").agg(
        F.coalesce(ratio(F.sum(up * v), total), F.lit(0.0)).alias("bulge"),
        F.coalesce(ratio(F.sum(-down * v), total), F.lit(0.0)).alias("sag"),
        F.coalesce(ratio(F.sum(F.when(d > 0, v)), total), F.lit(0.0)).alias("mass_up"),
        F.coalesce(ratio(F.sum(F.when(d < 0, v)), total), F.lit(0.0)).alias("mass_down"),
        F.when(F.sum(F.when(d > 0, v)) >= 0.05 * total, ratio(F.sum(up * v), F.sum(F.when(d > 0, v)))).alias("centre_up"),
        ratio(F.sum(d * v), total).alias("net"),
    )


def excursions(minutes: DataFrame, entries: DataFrame, horizon: int) -> DataFrame:
    """O-153: high and low after each entry inside the horizon, and when the first of each came."""
    at = F.unix_seconds("at")
    joined = entries.join(minutes.select("symbol", "date", "minute", "high", "low"), ["symbol", "date"]).filter((F.unix_seconds("minute") > at) & (F.unix_seconds("minute") <= at + 60 * horizon))
    return joined.groupBy("symbol", "date", "at").agg(F.max("high").alias("high"), F.min("low").alias("low"), F.min_by("minute", F.struct(-F.col("high"), F.col("minute"))).alias("high_at"), F.min_by("minute", F.struct("low", "minute")).alias("low_at"))


def time_at_price(series: DataFrame, width: float) -> DataFrame:
    """O-144: seconds that the price stood in each bin of a width, until the next poll; the bin with most is the point of control."""
    w = Window.partitionBy("symbol", "date").orderBy("ts")
    held = (F.unix_micros(F.lead("ts").over(w)) - F.unix_micros("ts")) / 1e6
    bins = series.withColumns({"held": F.coalesce(held, F.lit(0.0)), "bin": F.floor(F.col("price") / width)})
    out = bins.groupBy("symbol", "date", "bin").agg(F.sum("held").alias("seconds"), F.sum("volume").alias("volume"))
    best = Window.partitionBy("symbol", "date").orderBy(F.desc("seconds"), "bin")
    return out.withColumn("is_control", F.row_number().over(best) == 1)


def value_area(histogram: Column, share: float = 0.7) -> Column:
    """O-145: (low, high) indices of the bins around the fullest that hold a share: the larger neighbour first, ties to the upper.

    histogram: array<double>. A fold over at most as many steps as there are bins.
    """
    n = F.size(histogram)
    total = F.aggregate(histogram, F.lit(0.0), lambda a, x: a + x)
    mode = (F.array_position(histogram, F.array_max(histogram)) - 1).cast("int")
    start = F.struct(mode.alias("low"), mode.alias("high"), F.array_max(histogram).alias("held"))

    def step(acc, _):
        below = F.when(acc["low"] > 0, F.get(histogram, acc["low"] - 1))
        above = F.when(acc["high"] < n - 1, F.get(histogram, acc["high"] + 1))
        upward = above.isNotNull() & (below.isNull() | (above >= below))
        moved = F.struct(
            F.when(upward, acc["low"]).otherwise(F.greatest(acc["low"] - 1, F.lit(0))).alias("low"),
            F.when(upward, acc["high"] + 1).otherwise(acc["high"]).alias("high"),
            (acc["held"] + F.coalesce(F.when(upward, above).otherwise(below), F.lit(0.0))).alias("held"),
        )
        return F.when(acc["held"] >= share * total, acc).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), start, step)


def zigzag(prices: Column, threshold: float) -> Column:
    """O-141: causal zig-zag legs at each place of an ordered array of prices: direction, length, age and confirmed pivots.

    A leg turns only when the price has come back from the leg's extreme by the threshold (in log price), so what was said about
    earlier places never changes.
    """
    x = F.transform(prices, lambda p: F.ln(p))
    state = F.struct(
        F.lit(0).alias("dir"), F.get(x, F.lit(0)).alias("pivot"), F.get(x, F.lit(0)).alias("extreme"), F.lit(0).alias("age"), F.lit(0).alias("legs"),
        F.array().cast("array<struct<dir:int,length:double,age:int,legs:int>>").alias("out"),
    )

    def step(s, p):
        up, down = p - F.least(s["extreme"], s["pivot"]), F.greatest(s["extreme"], s["pivot"]) - p
        turn_up = (s["dir"] <= 0) & (F.when(s["dir"] == 0, up).otherwise(p - s["extreme"]) >= threshold)
        turn_down = (s["dir"] >= 0) & (F.when(s["dir"] == 0, down).otherwise(s["extreme"] - p) >= threshold)
        turned = turn_up | turn_down
        direction = F.when(turn_up, F.lit(1)).when(turn_down, F.lit(-1)).otherwise(s["dir"])
        pivot = F.when(turned & (s["dir"] != 0), s["extreme"]).otherwise(s["pivot"])
        further = F.when(direction == 1, p > s["extreme"]).when(direction == -1, p < s["extreme"]).otherwise(F.abs(p - s["pivot"]) > F.abs(s["extreme"] - s["pivot"]))
        extreme = F.when(turned | further, p).otherwise(s["extreme"])
        age = F.when(turned, F.lit(0)).otherwise(s["age"] + 1)
        legs = s["legs"] + F.when(turned, F.lit(1)).otherwise(F.lit(0))
        row = F.struct(direction.alias("dir"), (extreme - pivot).alias("length"), age.alias("age"), legs.alias("legs"))
        return F.struct(direction.alias("dir"), pivot.alias("pivot"), extreme.alias("extreme"), age.alias("age"), legs.alias("legs"), F.concat(s["out"], F.array(row)).alias("out"))

    return F.aggregate(x, state, step)["out"]
