"""Parts of a session (before, during and after regular hours), scans of feeds, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions.expr import ratio

OPEN, CLOSE, HALF_CLOSE = 570, 960, 780  # minutes of the exchange's day


def session_parts(prints: DataFrame, cuts: list[int], half_days: DataFrame) -> DataFrame:
    """O-39: one row for each (symbol, date): first and last price, high, low, volume and VWAP before, during and after regular hours, and the last
    price before each cut-off minute.

    prints: symbol, date, minute (of the exchange's day), price, volume, and seq, an order without ties. half_days: dates that end at 13:00, a
    few rows a year. One aggregation.
    """
    marked = prints.join(F.broadcast(half_days.select("date").distinct().withColumn("__half", F.lit(True))), "date", "left")
    close = F.when(F.col("__half"), HALF_CLOSE).otherwise(CLOSE)
    part = {"pre": F.col("minute") < OPEN, "regular": (F.col("minute") >= OPEN) & (F.col("minute") < close), "after": F.col("minute") >= close}
    out: list[Column] = []
    for name, inside in part.items():
        price, volume = F.when(inside, F.col("price")), F.when(inside, F.col("volume"))
        order = F.when(inside, F.struct("minute", "seq"))
        out += [F.min_by("price", order).alias(f"{name}_first"), F.max_by("price", order).alias(f"{name}_last"), F.max(price).alias(f"{name}_high"), F.min(price).alias(f"{name}_low"), F.sum(volume).alias(f"{name}_volume"), ratio(F.sum(price * volume), F.sum(volume)).alias(f"{name}_vwap")]
    cut = [F.max_by("price", F.when(F.col("minute") < c, F.struct("minute", "seq"))).alias(f"last_before_{c}") for c in cuts]
    return marked.groupBy("symbol", "date").agg(*out, *cut, F.coalesce(F.max("__half"), F.lit(False)).alias("half_day"))


def extended_changes(days: DataFrame) -> DataFrame:
    """O-64: the last price before the open against the previous close, and the last after the close against the same day's close.

    days: symbol, date, day_idx, close, pre_last, after_last, split_factor (of the bars), ext_split_factor (of the extended prices, which may
    have been fetched at another time). Both sides are adjusted by their own factor; NULL without such a trade.
    """
    close = F.col("close") * F.coalesce("split_factor", F.lit(1.0))
    before = F.lag(close).over(Window.partitionBy("symbol").orderBy("day_idx"))
    own = F.coalesce("ext_split_factor", F.lit(1.0))
    return days.withColumns({"pre_market_change": ratio(F.col("pre_last") * own, before) - 1, "after_hours_change": ratio(F.col("after_last") * own, close) - 1})


def daily_context(days: DataFrame, sessions: int = 10, least: int = 5) -> DataFrame:
    """O-133: what is known before a session: the two closes before, their VWAP moves, and the mean volume of the sessions before it.

    The mean needs at least some sessions, all with one split factor, so that a split in between gives NULL and not a mixed scale. One
    partitioning serves all windows. days: symbol, day_idx, close, vwap, volume, split_factor.
    """
    by = Window.partitionBy("symbol").orderBy("day_idx")
    past = by.rowsBetween(-sessions, -1)
    same = F.min("split_factor").over(past) == F.max("split_factor").over(past)
    return days.withColumns({
        "close_1": F.lag("close", 1).over(by),
        "close_2": F.lag("close", 2).over(by),
        "vwap_move_1": F.ln(ratio(F.lag("vwap", 1).over(by), F.lag("vwap", 2).over(by))),
        "volume_mean": F.when((F.count("volume").over(past) >= least) & same, F.avg("volume").over(past)),
    })


def merge_morning(held: DataFrame, opens: DataFrame, lasts: DataFrame, open_pass: bool) -> DataFrame:
    """O-126: morning records (symbol, last, open) after one more pass: an open pass keeps last prices and fills only missing opens; any other
    takes the new last prices and keeps opens."""
    j = held.join(opens.select("symbol", F.col("open").alias("__open")), "symbol", "full").join(lasts.select("symbol", F.col("last").alias("__last")), "symbol", "full")
    if open_pass:
        return j.select("symbol", "last", F.coalesce("open", "__open").alias("open"))
    return j.select("symbol", F.col("__last").alias("last"), "open")


def union_feeds(feeds: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """O-03, O-84: several sources of a day as one, one row for each key: that of the earliest source in the list, ties by order."""
    rows = None
    for i, f in enumerate(feeds):
        own = f.withColumn("source_rank", F.lit(i))
        rows = own if rows is None else rows.unionByName(own)
    w = Window.partitionBy(*keys).orderBy("source_rank", *order)
    return rows.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def regular_minutes(bars: DataFrame, month: str | None = None) -> DataFrame:
    """O-04: minute bars in regular hours of the exchange's day, of one month if given; VWAP falls back to the close; first_open is the open of
    the stock-day's first bar.

    bars: symbol, ts (UTC), open, close, vwap, volume.
    """
    ny = F.from_utc_timestamp("ts", "America/New_York")
    rows = bars.withColumns({"date": F.to_date(ny), "minute": F.hour(ny) * 60 + F.minute(ny)}).filter((F.col("minute") >= OPEN) & (F.col("minute") < CLOSE))
    if month:
        rows = rows.filter(F.date_format("date", "yyyy-MM") == month)
    first = F.first("open").over(Window.partitionBy("symbol", "date").orderBy("minute"))
    return rows.select("symbol", "date", "minute", "open", "close", F.coalesce("vwap", "close").alias("vwap"), "volume", first.alias("first_open"))


def volume_at_price(minutes: DataFrame, decisions: DataFrame, width: float = 0.25, reach: int = 12, half_life: float = 30.0) -> DataFrame:
    """O-159: for each decision (symbol, date, at, price, sigma) the volume of the day's earlier minutes by price, in bins of width sigmas around it.

    Returns the share above, the same with volumes that halve in half_life minutes, the fullest bin (ties to the lower), and the bins by which
    15 % and 85 % of the volume are reached. A join on (symbol, date), at most 2 * reach + 1 bins for each decision.
    """
    j = decisions.join(minutes.filter("volume > 0").select("symbol", "date", "minute", "vwap", "volume"), ["symbol", "date"]).filter("minute < at")
    y = F.ln(F.col("vwap") / F.col("price")) / F.col("sigma")
    age = (F.unix_seconds("at") - F.unix_seconds("minute")) / 60.0
    j = j.withColumns({"y": y, "w": F.col("volume") * F.pow(F.lit(0.5), age / half_life)}).filter("y IS NOT NULL")
    place = F.greatest(F.lit(-reach), F.least(F.lit(reach), F.floor(F.col("y") / width + 0.5))).cast("int")
    key = ["symbol", "date", "at"]
    cells = j.groupBy(*key, place.alias("bin")).agg(F.sum("volume").alias("v"), F.sum(F.when(F.col("y") > 0, F.col("volume")).otherwise(0.0)).alias("up"), F.sum("w").alias("w"), F.sum(F.when(F.col("y") > 0, F.col("w")).otherwise(0.0)).alias("w_up"))
    upto = Window.partitionBy(*key).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("v").over(upto) / F.sum("v").over(Window.partitionBy(*key))
    ranked = cells.withColumn("share", share)
    reached = lambda s: F.min(F.when(F.col("share") >= s, F.col("bin"))) * width
    return ranked.groupBy(*key).agg(ratio(F.sum("up"), F.sum("v")).alias("above"), ratio(F.sum("w_up"), F.sum("w")).alias("above_recent"), (F.max_by("bin", F.struct("v", -F.col("bin"))) * width).alias("control"), reached(0.15).alias("low"), reached(0.85).alias("high"))


def reconcile(rows: DataFrame, by: list[str], ratios: dict[str, tuple[str, str]], matches: dict[str, tuple[str, str]], tolerance: float = 0.005) -> DataFrame:
    """O-127: how two feeds agree, by group: for each pair of volumes the median, least and largest ratio (of four decimals; rows where either is 0
    or NULL do not count), for each pair of prices the rows within a relative tolerance.

    One row for each group and pair: pair, n, median, least, largest, hits. Ratios are counted by value before the median, so a group's task
    meets distinct values and no rows.
    """
    kinds = [F.struct(F.lit(k).alias("pair"), F.round(_nonzero_ratio(a, b), 4).alias("value"), F.lit(None).cast("int").alias("hit")) for k, (a, b) in ratios.items()]
    close = lambda a, b: (F.abs(F.col(a) - F.col(b)) <= tolerance * F.greatest(F.abs(F.col(b)), F.lit(1e-9))).cast("int")
    kinds += [F.struct(F.lit(k).alias("pair"), F.lit(None).cast("double").alias("value"), close(a, b).alias("hit")) for k, (a, b) in matches.items()]
    long = rows.select(*by, F.explode(F.array(*kinds)).alias("x")).select(*by, "x.*").filter("value IS NOT NULL OR hit IS NOT NULL")
    counted = long.groupBy(*by, "pair", "value").agg(F.count("*").alias("c"), F.sum("hit").alias("hits"))
    return counted.groupBy(*by, "pair").agg(F.sum("c").alias("n"), F.percentile("value", F.lit(0.5), F.col("c")).alias("median"), F.min("value").alias("least"), F.max("value").alias("largest"), F.sum("hits").alias("hits"))


def _nonzero_ratio(a: str, b: str) -> Column:
    """a / b where neither is 0."""
    return F.when(F.col(a) != 0, ratio(a, b))


def index_minutes(minutes: DataFrame, past: int = 20) -> DataFrame:
    """O-139b: a market index by minute of the regular session: the close carried forward within the day, volume (0 where nothing traded), the day's VWAP
    and the normal volume of the minute, its median over the sessions before (NULL with fewer than `past`).

    minutes: symbol, date, minute (OPEN to CLOSE - 1), close, volume, vwap. One row for each symbol, session of it, and minute.
    """
    days = minutes.groupBy("symbol", "date").agg(ratio(F.sum(F.col("vwap") * F.col("volume")), F.sum("volume")).alias("day_vwap"))
    grid = days.select("symbol", "date", "day_vwap", F.explode(F.sequence(F.lit(OPEN), F.lit(CLOSE - 1))).alias("minute"))
    m = grid.join(minutes.select("symbol", "date", "minute", "close", "volume"), ["symbol", "date", "minute"], "left").withColumn("volume", F.coalesce("volume", F.lit(0.0)))
    m = m.withColumn("close", F.last("close", ignorenulls=True).over(Window.partitionBy("symbol", "date").orderBy("minute")))
    before = F.sort_array(F.collect_list("volume").over(Window.partitionBy("symbol", "minute").orderBy("date").rowsBetween(-past, -1)))
    middle = (F.get("__v", F.lit((past - 1) // 2)) + F.get("__v", F.lit(past // 2))) / 2
    return m.withColumn("__v", before).withColumn("normal_volume", F.when(F.size("__v") == past, middle)).drop("__v")


def index_days(daily: DataFrame, dividends: DataFrame) -> DataFrame:
    """O-139b, O-139: an index's sessions with the dividends that go ex that day, and the gap of the open over the previous close less those dividends.

    daily: symbol, date, open, close; dividends: symbol, ex_date, cash, any number a day.
    """
    paid = dividends.groupBy("symbol", F.col("ex_date").alias("date")).agg(F.sum("cash").alias("dividend"))
    d = daily.join(paid, ["symbol", "date"], "left").withColumn("dividend", F.coalesce("dividend", F.lit(0.0)))
    before = F.lag("close").over(Window.partitionBy("symbol").orderBy("date"))
    return d.withColumn("gap", F.ln(ratio("open", before - F.col("dividend"))))
