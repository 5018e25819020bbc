"""Polls of a regular session: cumulative volumes made monotone, a base before the open, the opening cross, gaps, held prices and forward targets.

All windows of a step share one partitioning by (symbol, date), so a series costs one shuffle and one sort. A symbol-day has at most one row a poll time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from marketloom.functions.expr import ratio
from marketloom.operators.asof import asof_join

DAY = ["symbol", "date"]


def _by() -> WindowSpec:
    return Window.partitionBy(*DAY).orderBy("ts")


def _upto() -> WindowSpec:
    return _by().rowsBetween(Window.unboundedPreceding, 0)


def _whole() -> WindowSpec:
    return _by().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _clock(minute: int, second: int = 0) -> Column:
    return F.timestamp_add("SECOND", F.lit(60 * minute + second), F.col("date").cast("timestamp"))


def _seconds(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 1e6


def _marked(polls: DataFrame, opens: int, closes: int, grace: int) -> DataFrame:
    fields = ("volume", "price", "day_open", "prev_close")
    one = polls.groupBy(*DAY, "ts").agg(F.max(F.struct(*fields)).alias("x")).select(*DAY, "ts", "x.*")
    m = one.withColumns({
        "__p": F.last("price", ignorenulls=True).over(_upto()),
        "__v": F.coalesce(F.max("volume").over(_upto()), F.lit(0.0)),
        "__base": F.max(F.when(F.col("ts") <= _clock(opens), F.col("ts"))).over(_whole()),
        "__after": F.min(F.when(F.col("ts") >= _clock(closes, grace), F.col("ts"))).over(_whole()),
        "__prev": F.first("prev_close", ignorenulls=True).over(_whole()),
    })
    m = m.withColumn("__end", F.coalesce("__after", F.max("ts").over(_whole())))
    m = m.withColumn("__in", F.coalesce(F.col("ts").between(F.col("__base"), F.col("__end")), F.lit(False)))
    priced = F.max(F.when(F.col("__in"), F.col("__p"))).over(_whole())
    return m.withColumn("reason", F.when(F.col("__base").isNull(), "no_premarket").when((F.col("__end") <= F.col("__base")) | priced.isNull(), "no_rth"))


def series_drops(polls: DataFrame, opens: int, closes: int, grace: int = 30) -> DataFrame:
    """O-130: (symbol, date, reason): no_premarket (no poll at or before the open), no_rth (none after it, or no price), or 'kept'."""
    return _marked(polls, opens, closes, grace).groupBy(*DAY).agg(F.coalesce(F.max("reason"), F.lit("kept")).alias("reason"))


def session_series(polls: DataFrame, opens: int, closes: int, grace: int = 30, least_gap: float = 30.0, long_gap: float = 600.0) -> DataFrame:
    """O-130, O-142: each symbol-day from its last poll before the open to the first one `grace` seconds after the close.

    polls: symbol, date, ts, price, volume (so far in the day, as reported), day_open, prev_close; any of the last four may be NULL. Of equal times the row with the
    largest volume (then price) counts. opens, closes: minutes of the day. Prices are carried on (and the first one back to the base), volumes only grow. What is traded between two
    polls counts at their mean price; the first trade of the session at the day's open, if that is known. No change of price keeps the last side. gap_short, the longest
    gap of short windows, is 2.5 median steps, at least least_gap. Symbol-days of `series_drops` other than 'kept' have no rows.
    """
    s = _marked(polls, opens, closes, grace).filter(F.col("__in") & F.col("reason").isNull())
    s = s.withColumns({
        "price": F.coalesce("__p", F.first("__p", ignorenulls=True).over(_whole())),
        "prev_close": F.coalesce("__prev", F.first("__p").over(_whole())),
        "day_open": F.first("day_open", ignorenulls=True).over(_whole()),
        "traded": F.coalesce(F.col("__v") - F.lag("__v").over(_by()), F.lit(0.0)),
        "__gap": _seconds(F.col("ts"), F.lag("ts").over(_by())),
    })
    before = F.lag("price").over(_by())
    s = s.withColumns({
        "__mid": (F.col("price") + before) / 2,
        "__r": F.coalesce(F.ln(ratio(F.col("price"), before)), F.lit(0.0)),
        "__sign": F.nullif(F.signum(F.col("price") - before), F.lit(0.0)),
        "__first": F.min(F.when(F.col("traded") > 0, F.col("ts"))).over(_whole()),
        "gap_short": F.greatest(F.lit(least_gap), 2.5 * F.percentile("__gap", F.lit(0.5)).over(_whole())),
    })
    s = s.withColumns({
        "side": F.coalesce(F.last("__sign", ignorenulls=True).over(_upto()), F.lit(0.0)),
        "__px": F.when((F.col("ts") == F.col("__first")) & F.col("day_open").isNotNull(), F.col("day_open")).otherwise(F.coalesce("__mid", F.lit(0.0))),
    })
    total = lambda c: F.sum(c).over(_upto())
    return s.select(
        *DAY, "ts", "price", "traded", "side", "day_open", "prev_close", "gap_short",
        F.col("__after").isNotNull().alias("covered_close"),
        F.col("__end").alias("last_poll"),
        F.when(F.col("__after").isNotNull(), F.col("__end")).otherwise(_clock(closes, grace)).alias("end_time"),
        total("traded").alias("cum_v"), total(F.col("traded") * F.col("__px")).alias("cum_pv"),
        total(F.col("traded") * F.col("side")).alias("cum_sv"), total(F.col("__r") * F.col("__r")).alias("cum_rv"),
        F.coalesce(F.max(F.when(F.col("traded") > 0, F.col("ts"))).over(_upto()), F.first("ts").over(_whole())).alias("traded_at"),
        F.count("*").over(_upto()).alias("n"),
        total((F.coalesce("__gap", F.lit(0.0)) > long_gap).cast("int")).alias("long_gaps"),
        total((F.coalesce("__gap", F.lit(0.0)) > F.col("gap_short")).cast("int")).alias("short_gaps"),
    )


def session_grid(series: DataFrame, opens: int, closes: int, step: int, phase: Column | None = None) -> DataFrame:
    """O-134, O-106: decision times every `step` seconds from the open (plus phase, seconds from the date) to before the close, with the day's constants."""
    const = ["gap_short", "covered_close", "last_poll", "end_time"]
    days = series.groupBy(*DAY).agg(*[F.first(c).alias(c) for c in const])
    start = F.unix_seconds(_clock(opens)) + (F.lit(0) if phase is None else phase)
    at = F.explode(F.sequence(start, F.unix_seconds(_clock(closes)) - 1, F.lit(step).cast("long")))
    return days.select(*DAY, *const, at.alias("__s")).withColumn("at", F.timestamp_seconds("__s")).drop("__s")


def held_prices(points: DataFrame, series: DataFrame, cap: float = 600.0) -> DataFrame:
    """O-37: the price held at each point, seconds since the last poll and since the last trade (at most cap)."""
    hit = asof_join(points.select(*DAY, "at"), series.select(*DAY, "ts", "price", "traded_at"), DAY, "at", "ts")
    age = lambda t: F.least(_seconds(F.col("at"), F.col(t)), F.lit(cap))
    return hit.select(*DAY, "at", "price", age("ts").alias("staleness"), age("traded_at").alias("since_trade"))


def session_targets(points: DataFrame, series: DataFrame, horizons: dict[str, int], long_from: int = 3600, least_polls: dict[str, int] | None = None) -> DataFrame:
    """O-135, O-105: log moves from the price at each point to the VWAP of the following seconds, of the rest of the session and of the whole day, and a mask of the valid ones.

    points: from `session_grid`; with day_vwap (may be NULL), r_close is valid where it is there. A window (at, at + seconds] ends with the session. It is valid if polls reach its end, something was
    traded in it and no gap of polls overlaps it: of gap_short for windows under `long_from` seconds, else of the series' long gap. The rest of the session needs a covered close. least_polls: how
    many polls a window of that name needs. Windows are differences of running sums at two as-of lookups; the lookups of a day share its one sort.
    """
    names = [*horizons, "r_rod"]
    end = {n: F.least(F.timestamp_add("SECOND", F.lit(k), F.col("at")), F.col("end_time")) for n, k in horizons.items()} | {"r_rod": F.col("end_time")}
    keep = [c for c in points.columns if c not in DAY]
    asked = F.explode(F.array(F.struct(F.lit("at").alias("w"), F.col("at").alias("t")), *[F.struct(F.lit(n).alias("w"), t.alias("t")) for n, t in end.items()]))
    looked = points.select(*DAY, *keep, asked.alias("__a")).select(*DAY, *keep, "__a.*")
    ahead = lambda c: F.coalesce(F.lead(c).over(_by()), F.col(c))
    sums = series.select(*DAY, F.col("ts").alias("__ts"), "price", "cum_v", "cum_pv", "n", "long_gaps", "short_gaps", ahead("long_gaps").alias("next_long"), ahead("short_gaps").alias("next_short"))
    hit = asof_join(looked, sums, DAY, "t", "__ts")
    # A gap that a window overlaps starts before its end: the next poll closes it, unless a poll stands at the end itself.
    until = lambda k: F.when(F.col("__ts") == F.col("t"), F.col(f"{k}_gaps")).otherwise(F.col(f"next_{k}"))
    value = F.struct("t", "price", "cum_v", "cum_pv", "n", "long_gaps", "short_gaps", until("long").alias("until_long"), until("short").alias("until_short"))
    wide = hit.groupBy(*DAY, *keep).agg(*[F.max(F.when(F.col("w") == w, value)).alias(w if w != "at" else "__0") for w in ("at", *names)])
    valid, moves = {}, {}
    for n in names:
        kind = "short" if horizons.get(n, long_from) < long_from else "long"
        volume = F.col(f"{n}.cum_v") - F.col("__0.cum_v")
        ok = (volume > 0) & (F.col(f"{n}.until_{kind}") == F.col(f"__0.{kind}_gaps"))
        ok &= F.col("covered_close") if n == "r_rod" else (F.col(f"{n}.t") <= F.col("last_poll")) & (F.col(f"{n}.t") > F.col("at"))
        if n in (least_polls or {}):
            ok &= F.col(f"{n}.n") - F.col("__0.n") >= least_polls[n]
        valid[n], moves[n] = F.coalesce(ok, F.lit(False)), F.ln(ratio(ratio(F.col(f"{n}.cum_pv") - F.col("__0.cum_pv"), volume), F.col("__0.price")))
    if "day_vwap" in keep:
        valid["r_close"], moves["r_close"] = F.col("day_vwap").isNotNull(), F.ln(ratio(F.col("day_vwap"), F.col("__0.price")))
    mask = sum((F.when(v, F.lit(1 << i)).otherwise(F.lit(0)) for i, v in enumerate(valid.values())), F.lit(0))
    return wide.select(*DAY, "at", F.col("__0.price").alias("last"), *[F.when(v, moves[n]).alias(n) for n, v in valid.items()], mask.cast("int").alias("tmask"))
