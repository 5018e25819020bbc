"""Feed work: canonical messages, listings, universes, audits, morning files and comparisons of feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions.expr import ratio
from marketloom.operators.asof import asof_join, latest, near_join

MESSAGE = "ev string, sym string, s bigint, o double, h double, l double, c double, v double, av double, z double"


def aggregate_messages(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """O-09: second bars of 'A' messages (value: JSON text), and counts of what is wrong with the others."""
    m = raw.select(F.from_json("value", MESSAGE).alias("m"), "value")
    problem = F.when(F.col("m.ev").isNull(), "unparseable").when(F.col("m.ev") != "A", "other").when(F.col("m.sym").isNull() | F.col("m.s").isNull(), "incomplete")
    m = m.withColumn("problem", problem)
    good = m.filter("problem IS NULL").select("m.*").select(F.col("sym").alias("symbol"), F.timestamp_millis("s").alias("ts"), F.col("c").alias("price"), F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"), F.col("v").alias("volume"), F.col("av").alias("volume_cum"), F.col("z").alias("avg_trade_size"))
    return good, m.filter("problem IS NOT NULL").groupBy("problem").count()


def rest_bars(rows: DataFrame) -> DataFrame:
    """O-10, O-10b: single-letter fields renamed, rows without a key dropped, mean trade size of bars with trades."""
    return rows.filter(F.col("t").isNotNull()).select(F.col("t").alias("ticker"), F.col("o").alias("open"), F.col("c").alias("close"), F.col("v").alias("volume"), F.col("n").alias("trades"), F.when(F.col("n") > 0, F.round(F.col("v") / F.col("n"))).alias("avg_trade_size"))


def memberships(pairs: DataFrame, universe: DataFrame, key: str, group: str) -> tuple[DataFrame, DataFrame]:
    """O-19c: distinct pairs of known members, and how many members have a group and how many have none."""
    known = pairs.select(key, group).distinct().join(universe.select(key), key, "left_semi")
    has = universe.select(key).distinct().join(known.select(key).distinct().withColumn("has", F.lit(1)), key, "left")
    return known, has.agg(F.count("has").alias("matched"), (F.count("*") - F.count("has")).alias("unmatched"))


# Patterns of names that are no common stock, first match first.
NOT_EQUITY = {
    "note": r"(?i)\bnotes?\b|\bdue \d{4}\b|debenture|subordinated",
    "preferred": r"(?i)preferred|depositary|\bpfd\b",
    "fund": r"(?i)\bfund\b",
    "rights": r"(?i)\brights?\b",
}


def exclusion(name: str) -> Column:
    """O-20b: why a listing of common stock is none by its name, else NULL."""
    out = None
    for reason, pattern in NOT_EQUITY.items():
        hit = F.col(name).rlike(pattern)
        out = F.when(hit, reason) if out is None else out.when(hit, reason)
    return out


def survivors(listings: DataFrame, since: str) -> DataFrame:
    """O-20e: listings that are active, or were delisted on or after a date (NULL: not known, so left out unless active)."""
    return listings.filter(F.col("active") | (F.col("delisted") >= F.lit(since).cast("date")))


def universe_from_bars(bars: DataFrame, listings: DataFrame) -> DataFrame:
    """O-20c, O-20d, O-20e: each traded ticker with its best listing that is no fund or note, or the reason for none.

    listings: ticker, kind, name, active. CS listings whose name passes are kept; otherwise 'adr' if an ADR exists, else 'no row'.
    """
    bad = exclusion("name").isNotNull()
    own = listings.groupBy("ticker").agg(F.min_by("name", F.when((F.col("kind") == "CS") & ~bad, F.struct(F.when(F.col("active"), 0).otherwise(1), F.col("name")))).alias("best"), F.max(F.col("kind") == "ADR").alias("adr"))
    out = bars.select("ticker").distinct().join(own, "ticker", "left")
    return out.select("ticker", F.col("best").alias("name"), F.when(F.col("best").isNotNull(), "kept").when(F.col("adr"), "adr").otherwise("no row").alias("reason"))


def snapshot_dates(sessions: DataFrame, stored: DataFrame) -> DataFrame:
    """O-20m: the last session on or before each quarter's end that is not stored yet."""
    ends = sessions.groupBy(F.year("date").alias("year"), F.quarter("date").alias("quarter")).agg(F.max("date").alias("date"))
    return ends.join(stored.select("date"), "date", "left_anti").select("date", "year", "quarter")


def is_due(series: DataFrame, month: str, value: str, today) -> DataFrame:
    """O-20n: one row: the newest month with a value and whether it lies before the month before last."""
    newest = F.max(F.when(F.col(value).isNotNull(), F.col(month)))
    return series.agg(newest.alias("newest")).withColumn("due", F.col("newest") < F.add_months(F.trunc(F.lit(today).cast("date"), "month"), -2))


def cross_volume(polls: DataFrame, bars: DataFrame) -> DataFrame:
    """O-27: for each poll the first bar whose cumulative volume reaches the poll's."""
    right = bars.groupBy("symbol", "date", "bar_v").agg(F.min("bar_ts").alias("bar_ts"))
    return asof_join(polls, right, ["symbol", "date"], "cum_v", "bar_v", "forward")


def semantics(series: DataFrame) -> DataFrame:
    """O-47: how often the next cumulative VWAP follows from the bar, and how much volume lies outside the session, per symbol."""
    w = Window.partitionBy("symbol", "date").orderBy("ts")
    before_v, before_pv = F.lag("cum_v").over(w), F.lag("cum_pv").over(w)
    follows = F.abs((before_pv + F.col("price") * F.col("volume")) / (before_v + F.col("volume")) - F.col("cum_pv") / F.col("cum_v")) < 1e-6
    outside = ~F.hour("ts").between(9, 15)
    rows = series.withColumns({"__f": follows.cast("int"), "__o": F.when(outside, F.col("volume")).otherwise(0.0)})
    return rows.groupBy("symbol").agg(F.avg("__f").alias("follows"), ratio(F.sum("__o"), F.sum("volume")).alias("outside_share"), F.count("*").alias("n"))


def filing_flags(bars: DataFrame, filings: DataFrame) -> DataFrame:
    """O-111: whether a session carries a filing of each kind. filings: symbol, day_idx, form."""
    f = filings.groupBy("symbol", "day_idx").agg(F.max(F.col("form").startswith("1")).alias("is_10k"), F.max(F.col("form").startswith("2")).alias("is_10q"))
    return bars.join(f, ["symbol", "day_idx"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("is_10k", "is_10q")})


def vwap_check(feed: DataFrame, daily: DataFrame) -> DataFrame:
    """O-136: difference of a feed's and a daily VWAP in basis points: number, median and 95th percentile of its size by symbol."""
    bp = (ratio("feed_vwap", "daily_vwap") - 1) * 10000
    j = feed.join(daily, ["symbol", "date"]).withColumn("bp", F.abs(bp))
    q = F.percentile("bp", F.array(F.lit(0.5), F.lit(0.95)))
    return j.groupBy("symbol").agg(F.count("*").alias("n"), q.alias("q")).select("symbol", "n", F.get("q", F.lit(0)).alias("median_bp"), F.get("q", F.lit(1)).alias("p95_bp"))


def selected_price(rows: DataFrame) -> DataFrame:
    """O-126b, O-124: the middle of bid and ask where they fit, else the price once opened; a live value before a delayed one."""
    middle = F.when(F.col("ask") >= F.col("bid"), (F.col("ask") + F.col("bid")) / 2)
    return rows.withColumn("chosen", F.coalesce("live", middle, F.when(F.col("day_open").isNotNull(), F.col("price"))))


def complete(rows: DataFrame, cutoff: str, delay_minutes: int) -> DataFrame:
    """O-125: whether the data, delayed by some minutes, reaches a cut-off."""
    until = F.timestamp_add("MINUTE", F.lit(-delay_minutes), F.col("fetched_at"))
    return rows.withColumns({"data_until": until, "complete": until >= F.col(cutoff)})


def gap_free(points: DataFrame, gaps: DataFrame, minutes: int) -> DataFrame:
    """O-132: whether no gap touches the minutes before each point: as-of on the ends of gaps, since gaps of a symbol don't overlap."""
    ends = latest(gaps.select("symbol", F.col("gap_end").alias("g_end"), F.col("gap_start").alias("g_start")), ["symbol", "g_end"], [F.col("g_start")])
    before = asof_join(points, ends, ["symbol"], "at", "g_end")
    inside = asof_join(before, ends.withColumnsRenamed({"g_end": "n_end", "g_start": "n_start"}), ["symbol"], "at", "n_end", "forward", strict=True)
    start = F.timestamp_add("MINUTE", F.lit(-minutes), F.col("at"))
    touched = F.coalesce(F.col("g_end") > start, F.lit(False)) | F.coalesce(F.col("n_start") < F.col("at"), F.lit(False))
    return inside.withColumn("gap_free", ~touched).drop("g_end", "g_start", "n_end", "n_start")


def model_frame(rows: DataFrame, target: str) -> DataFrame:
    """O-162: targets moved one row down in each series, and a row of padding at each end."""
    w = Window.partitionBy("symbol").orderBy("day_idx")
    moved = rows.withColumn("__t", F.lag(target).over(w))
    pad = rows.groupBy("symbol").agg((F.max("day_idx") + 1).alias("day_idx"), F.max_by(target, "day_idx").alias(target))
    return moved.select("symbol", "day_idx", F.col("__t").alias(target), F.lit(False).alias("padding")).unionByName(pad.withColumn("padding", F.lit(True)))


SIGHTINGS = ("close shortly after", "close shortly before", "inside a bar close by", "printed near", "printed far", "previous close", "not printed")


def sightings(polls: DataFrame, bars: DataFrame, previous: DataFrame, soon: int, near: int, far: int, tick: float) -> DataFrame:
    """O-31: where the price of each poll shows up in the bars around the moment it describes: seconds to the nearest bar that closes on it, to the nearest that holds it, and the first SIGHTINGS that fits.

    polls: symbol, date, poll_id (unique in a symbol), at, price; bars: symbol, bar_end, low, high, close; previous: symbol, date, previous_close. Closing and, first, holding bars are at most `near` seconds away;
    if none holds the price, bars up to `far` seconds away count. Closes within `soon` seconds are close; of equally near bars the earlier counts. Prices are equal within tick. Polls and bars meet by (symbol, bucket
    of time), in one pass for both distances; every poll has a row.

    A poll stands in one bucket, so all its pairs follow each other in one task and are reduced to a row before anything is shuffled. The smallest distances are numbers, not structs: a smallest struct
    would have every pair sorted.
    """
    asked = ["symbol", "date", "poll_id", "at", "price"]
    pairs = near_join(polls.select(*asked), bars.select("symbol", "bar_end", "low", "high", "close"), ["symbol"], "at", "bar_end", far, "left")
    off = F.unix_micros("bar_end") - F.unix_micros("at")
    pairs = pairs.withColumns({"__off": off, "__apart": F.abs(off)})
    inside = F.col("price").between(F.col("low") - tick, F.col("high") + tick)
    close_by = F.col("__apart") <= near * 1_000_000
    # Twice the distance, and one more for a later bar: of equally near bars the earlier is smaller.
    place = 2 * F.col("__apart") + F.when(F.col("__off") > 0, 1).otherwise(0)
    least = lambda c, x: F.min(F.when(c, x))
    seen = pairs.groupBy(*asked).agg(least(close_by & (F.abs(F.col("price") - F.col("close")) < tick), place).alias("__place"), least(close_by & inside, F.col("__apart")).alias("__near"), least(inside, F.col("__apart")).alias("__far"))
    back = F.shiftright("__place", 1) / 1e6
    seen = seen.withColumns({"off_close": F.when(F.col("__place") % 2 == 1, back).otherwise(-back), "__near": F.col("__near") / 1e6, "__far": F.col("__far") / 1e6})
    out = seen.join(previous, ["symbol", "date"], "left")
    c, n = F.col("off_close"), F.col("__near")
    kinds = [(c > 0) & (c <= soon), c.between(-soon, 0), n <= soon, n.isNotNull(), F.col("__far").isNotNull(), F.abs(F.col("price") - F.col("previous_close")) < tick, F.lit(True)]
    kind = F.coalesce(*[F.when(k, F.lit(name)) for k, name in zip(kinds, SIGHTINGS)])
    return out.select("symbol", "date", "poll_id", "at", "price", "off_close", F.coalesce("__near", "__far").alias("off_range"), kind.alias("sighting"))
