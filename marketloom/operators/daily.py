"""Daily bars, point-in-time features, market returns, announcements and panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions.expr import ratio
from marketloom.operators.asof import asof_join, latest, range_product, snap_to_session
from marketloom.operators.rolling import sessions_window, with_min


def daily_bars(trades: DataFrame) -> DataFrame:
    """O-39, O-40: (symbol, date) bars of trades (symbol, date, price, volume, seq1, seq2): open, high, low, close, volume, vwap, trades."""
    order = F.struct("seq1", "seq2", "price")
    return trades.groupBy("symbol", "date").agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("volume").alias("volume"),
        (F.sum(F.col("price") * F.col("volume")) / F.sum("volume")).alias("vwap"),
        F.count("*").alias("trades"),
    )


def calendar(dates: DataFrame) -> DataFrame:
    """O-90b: sessions with day_idx and calendar columns. One row for each session: the window over all of them stays small."""
    w = Window.orderBy("date")
    s = dates.select("date").distinct()
    next_date = F.lead("date").over(w)
    return s.select(
        "date",
        F.row_number().over(w).alias("day_idx"),
        (F.dayofweek("date") - 1).alias("day_of_week"),
        F.month("date").alias("month"),
        F.coalesce(F.month(next_date) != F.month("date"), F.lit(False)).alias("month_end"),
        F.coalesce(F.quarter(next_date) != F.quarter("date"), F.lit(False)).alias("quarter_end"),
        F.date_diff(next_date, F.col("date")).alias("days_to_next"),
    )


def forward_vwaps(bars: DataFrame) -> DataFrame:
    """O-61..O-65: forward VWAPs of 1 and 10 sessions and the rest of the ISO week, change from the previous bar, past volume means.

    All windows but the week's share one partitioning by symbol.
    """
    pv = bars.withColumn("pv", F.col("vwap") * F.col("volume"))
    over = lambda w: ratio(F.sum("pv").over(w), F.sum("volume").over(w))
    by = Window.partitionBy("symbol").orderBy("day_idx")
    week = Window.partitionBy("symbol", F.expr("extract(YEAROFWEEK FROM date)"), F.weekofyear("date")).orderBy("day_idx").rowsBetween(0, Window.unboundedFollowing)
    return pv.select(
        "symbol", "date", "day_idx", "vwap", "volume",
        over(sessions_window("symbol", "day_idx", 1, 1)).alias("vwap_nx1"),
        over(sessions_window("symbol", "day_idx", 1, 10)).alias("vwap_nx10"),
        over(week).alias("vwap_week"),
        (ratio(F.col("vwap"), F.lag("vwap").over(by)) - 1).alias("pct_prev"),
        F.avg("volume").over(sessions_window("symbol", "day_idx", -10, -1)).alias("vol_10d_mean"),
        F.avg("volume").over(sessions_window("symbol", "day_idx", -19, 0)).alias("vol_ma20"),
    )


def universe(bars: DataFrame, least_rows: int, least_price: float, least_volume: float) -> DataFrame:
    """O-44: symbols with enough rows and high enough median price and volume (exact medians)."""
    return bars.groupBy("symbol").agg(F.count("*").alias("n"), F.median("vwap").alias("median_vwap"), F.median("volume").alias("median_volume")).filter((F.col("n") >= least_rows) & (F.col("median_vwap") >= least_price) & (F.col("median_volume") >= least_volume))


def liquid_universe(bars: DataFrame, sessions: int, least_dollars: float) -> DataFrame:
    """O-45: symbols with exactly `sessions` latest rows and a mean dollar volume of at least least_dollars, with their last close."""
    w = Window.partitionBy("symbol").orderBy(F.desc("day_idx"))
    last = bars.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= sessions)
    out = last.groupBy("symbol").agg(F.count("*").alias("n"), F.avg(F.col("vwap") * F.col("volume")).alias("dollar_volume"), F.max(F.when(F.col("rn") == 1, F.col("close"))).alias("last_close"))
    return out.filter((F.col("n") == sessions) & (F.col("dollar_volume") >= least_dollars)).drop("n")


def session_returns(bars: DataFrame, limit: float = 0.5) -> DataFrame:
    """Returns of the closing VWAP between consecutive sessions, within +-limit; other rows are left out."""
    by = Window.partitionBy("symbol").orderBy("day_idx")
    r = ratio(F.col("vwap"), F.lag("vwap").over(by)) - 1
    marked = bars.withColumns({"__prev": F.lag("day_idx").over(by), "ret": F.greatest(F.lit(-limit), F.least(F.lit(limit), r))})
    return marked.filter((F.col("__prev") == F.col("day_idx") - 1) & F.col("ret").isNotNull()).drop("__prev")


def market_returns(returns: DataFrame, weights: DataFrame, sector: str = "sector") -> DataFrame:
    """O-41: weighted mean return of each date for the market (sector NULL) and for each sector.

    One aggregation over grouping sets; weights (symbol, weight, sector) with a positive weight count.
    """
    joined = returns.join(weights.filter("weight > 0"), "symbol")
    return joined.groupingSets([["date", sector], ["date"]], "date", sector).agg((F.sum(F.col("weight") * F.col("ret")) / F.sum("weight")).alias("ret"), F.count("*").alias("n"), F.grouping(sector).alias("is_market")).select("date", sector, "ret", "n", F.col("is_market").cast("int").alias("is_market"))


def sector_wide(market: DataFrame, sectors: list[str]) -> DataFrame:
    """O-42: sector returns as columns of a date, market beside them."""
    kind = F.when(F.col("is_market") == 1, F.lit("market")).otherwise(F.col("sector"))
    return market.withColumn("__k", kind).groupBy("date").pivot("__k", ["market", *sectors]).agg(F.max("ret"))


def daily_volatility(returns: DataFrame, n: int = 20, least: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """O-66, O-68: sample deviation and mean of the n returns before, by row count; keep: other columns that stay."""
    w = Window.partitionBy("symbol").orderBy("day_idx").rowsBetween(-n, -1)
    return returns.select("symbol", "date", "day_idx", *keep, "ret", with_min(F.stddev_samp("ret").over(w), "ret", w, least).alias("sigma"), with_min(F.avg("ret").over(w), "ret", w, least).alias("mean"), with_min(F.percentile("ret", F.lit(0.5)).over(w), "ret", w, least).alias("median"))


def split_adjusted(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """O-29, O-20a: bars with the product of later split factors, and prices and volumes adjusted by it.

    splits: symbol, split_date, factor (new price / old price).
    """
    from marketloom.operators.asof import range_product

    out = range_product(bars, splits, "symbol", "date", "split_date", "factor", "split_factor")
    f = F.coalesce(F.col("split_factor"), F.lit(1.0))
    return out.withColumns({"split_factor": f, "adj_close": F.col("close") * f, "adj_volume": F.col("volume") / f})


def split_adjusted_by_fetch(bars: DataFrame, splits: DataFrame, today: Column) -> DataFrame:
    """O-29: as split_adjusted, for bars that were fetched at a known date (fetched; NULL: the bar's own): only splits after both the bar and its
    fetch count, since a later fetch has the earlier ones in its prices, and none after today.

    Both lower bounds are one: the later of the two dates, so it stays an as-of lookup of a suffix product.
    """
    rows = bars.withColumn("__after", F.greatest("date", F.coalesce("fetched", "date")))
    out = range_product(rows, splits.filter(F.col("split_date") <= today), "symbol", "__after", "split_date", "factor", "split_factor")
    out = out.withColumn("split_factor", F.coalesce("split_factor", F.lit(1.0))).drop("__after")
    return out.withColumn("adj_close", F.col("close") * F.col("split_factor"))


def announcements(releases: DataFrame, reports: DataFrame, sessions: DataFrame, most_sessions: int = 50) -> DataFrame:
    """O-110: releases snapped to sessions and grouped to the first report within most_sessions; the last of a group is scheduled.

    releases: symbol, accepted_at; reports: symbol, report_idx. After 16:00 a release counts for the next day.
    """
    late = F.hour("accepted_at") >= 16
    day = F.when(late, F.date_add(F.to_date("accepted_at"), 1)).otherwise(F.to_date("accepted_at"))
    snapped = snap_to_session(releases.withColumn("release_date", day), "release_date", sessions).withColumn("timing", F.when(late, F.lit("after")).when(F.hour("accepted_at") < 10, F.lit("before")).otherwise(F.lit("during")))
    snapped = latest(snapped.filter(F.col("day_idx").isNotNull()), ["symbol", "day_idx"], [F.col("accepted_at").asc(), F.col("timing")])
    grouped = asof_join(snapped, reports.select("symbol", "report_idx").distinct(), ["symbol"], "day_idx", "report_idx", "forward")
    grp = F.when(F.col("report_idx") - F.col("day_idx") <= most_sessions, F.col("report_idx"))
    grouped = grouped.withColumn("grp", grp)
    last = F.max("day_idx").over(Window.partitionBy("symbol", "grp"))
    return grouped.withColumn("scheduled", F.col("grp").isNull() | (F.col("day_idx") == last)).select("symbol", "day_idx", "timing", "grp", "scheduled")


def earnings_counters(bars: DataFrame, events: DataFrame) -> DataFrame:
    """O-112: sessions since the last and to the next scheduled event of each bar, and the window's name.

    events: symbol, day_idx.
    """
    e = events.select("symbol", F.col("day_idx").alias("event_idx")).distinct()
    past = asof_join(bars, e, ["symbol"], "day_idx", "event_idx").withColumnRenamed("event_idx", "last_event")
    both = asof_join(past, e, ["symbol"], "day_idx", "event_idx", "forward", strict=True).withColumnRenamed("event_idx", "next_event")
    since, to = F.col("day_idx") - F.col("last_event"), F.col("next_event") - F.col("day_idx")
    window = F.when(since == 0, "Day").when(since <= 2, "Post").when(to <= 1, "Eve").when(to <= 5, "Pre").otherwise("Quiet")
    return both.withColumns({"since": since, "to": to, "window": window}).drop("last_event", "next_event")


def macro_series(sessions: DataFrame, yields: DataFrame, lag: int = 1) -> DataFrame:
    """O-113: a daily series as known `lag` sessions before, its change, and its z-score against the prior 252 (at least 126) values.

    yields: date, value. A date without a value carries the last one.
    """
    days = sessions.select("day_idx", F.col("date")).withColumn("k", F.lit(1))
    used = asof_join(days, yields.withColumn("k", F.lit(1)).withColumnRenamed("date", "y_date"), ["k"], "date", "y_date").select("day_idx", "date", "value")
    w = Window.orderBy("day_idx")
    shifted = used.withColumn("used", F.lag("value", lag).over(w))
    before = w.rowsBetween(-252, -1)
    z = F.when(F.count("used").over(before) >= 126, ratio(F.col("used") - F.avg("used").over(before), F.stddev_pop("used").over(before)))
    return shifted.select("day_idx", "date", "used", (F.col("used") - F.lag("used").over(w)).alias("change"), z.alias("z"))


def lagged(df: DataFrame, keys: str, index: str, columns: list[str], lags: list[int]) -> DataFrame:
    """O-123: columns as they were `lag` sessions before, by index and not by row."""
    out = df
    for k in lags:
        past = df.select(F.col(keys), (F.col(index) + k).alias(index), *[F.col(c).alias(f"{c}_lag{k}") for c in columns])
        out = out.join(past, [keys, index], "left")
    return out


def folds(sessions: DataFrame, first: int, length: int, stop: int, n: int) -> DataFrame:
    """O-117: walk-forward folds: (fold, day_idx, role) with roles train, stop and test."""
    k = sessions.sparkSession.range(1, n + 1).select(F.col("id").alias("fold"), (F.lit(first) + (F.col("id") - 1) * length).alias("test_from"))
    role = F.when(F.col("day_idx") < F.col("test_from") - stop, "train").when(F.col("day_idx") < F.col("test_from"), "stop").when(F.col("day_idx") < F.col("test_from") + length, "test")
    # n folds of a calendar: both sides are small by nature.
    return sessions.select("day_idx").join(F.broadcast(k)).withColumn("role", role).filter("role IS NOT NULL").select("fold", "day_idx", "role")


def true_range(bars: DataFrame, n: int = 14, least: int = 5) -> DataFrame:
    """O-118: true range and its mean over the last n rows (at least `least`), as a share of the close."""
    by = Window.partitionBy("symbol").orderBy("day_idx")
    previous = F.lag("close").over(by)
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - previous), F.abs(F.col("low") - previous))
    marked = bars.withColumn("true_range", tr)
    w = by.rowsBetween(-(n - 1), 0)
    return marked.withColumn("atr_pct", ratio(with_min(F.avg("true_range").over(w), "true_range", w, least), F.col("close")))


def panel(bars: DataFrame, sectors: DataFrame, least_rows: int = 20) -> DataFrame:
    """O-114: one row for each symbol and session with target, features and context; only symbols of the universe."""
    features = forward_vwaps(bars)
    members = universe(bars, least_rows, 0.0, 0.0).select("symbol")
    returns = session_returns(bars)
    market = market_returns(returns, sectors)
    whole = market.filter("is_market = 1").select("date", F.col("ret").alias("market_ret"))
    own = market.filter("is_market = 0").select("date", "sector", F.col("ret").alias("sector_ret"))
    out = features.join(members, "symbol", "left_semi").join(sectors.select("symbol", "sector"), "symbol", "left")
    out = out.join(whole, "date", "left").join(own, ["date", "sector"], "left")
    known = F.when(F.col("sector_ret").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return out.select(
        "symbol", "date", "day_idx", "vwap",
        F.col("vwap_nx1").alias("target"),
        (ratio(F.col("vwap_nx1"), F.col("vwap")) - 1).alias("target_return"),
        F.coalesce("pct_prev", F.lit(0.0)).alias("pct_prev"),
        F.coalesce("vol_10d_mean", F.lit(0.0)).alias("vol_10d_mean"),
        known.alias("sector_known"),
        F.coalesce("sector_ret", "market_ret", F.lit(0.0)).alias("sector_ret"),
    )
