"""Queries over daily bars."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions import expr as X
from marketloom.operators import asof, daily, rolling
from marketloom.plans.base import BARS, bars, query, read, releases, rounded, sectors, sessions


@query(BARS + " SELECT symbol, date, day_idx, f32(open) AS open, f32(high) AS high, f32(low) AS low, f32(close) AS close, f32(volume) AS volume, f32(vwap) AS vwap, trades FROM bars")
def o39_daily_bars(spark, d):
    return rounded(bars(spark, d))


@query(BARS + """ SELECT date, day_idx, dayofweek(date)::INT AS day_of_week, month(date)::INT AS month,
 coalesce(month(lead(date) OVER w) <> month(date), false) AS month_end, coalesce(quarter(lead(date) OVER w) <> quarter(date), false) AS quarter_end,
 (lead(date) OVER w - date)::INT AS days_to_next FROM sessions WINDOW w AS (ORDER BY date)""")
def o90b_calendar(spark, d):
    return sessions(spark, d)


_FORWARD = """ , pv AS (SELECT *, vwap * volume AS pv FROM bars), fwd AS (
 SELECT symbol, date, day_idx, vwap, volume,
  sum(pv) OVER n1 / nullif(sum(volume) OVER n1, 0) AS vwap_nx1, sum(pv) OVER n10 / nullif(sum(volume) OVER n10, 0) AS vwap_nx10,
  sum(pv) OVER wk / sum(volume) OVER wk AS vwap_week, vwap / lag(vwap) OVER o - 1 AS pct_prev,
  avg(volume) OVER p10 AS vol_10d_mean, avg(volume) OVER p20 AS vol_ma20 FROM pv
 WINDOW o AS (PARTITION BY symbol ORDER BY day_idx), n1 AS (PARTITION BY symbol ORDER BY day_idx RANGE BETWEEN 1 FOLLOWING AND 1 FOLLOWING),
  n10 AS (PARTITION BY symbol ORDER BY day_idx RANGE BETWEEN 1 FOLLOWING AND 10 FOLLOWING), p10 AS (PARTITION BY symbol ORDER BY day_idx RANGE BETWEEN 10 PRECEDING AND 1 PRECEDING),
  p20 AS (PARTITION BY symbol ORDER BY day_idx RANGE BETWEEN 19 PRECEDING AND CURRENT ROW),
  wk AS (PARTITION BY symbol, isoyear(date), weekofyear(date) ORDER BY day_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(BARS + _FORWARD + """ SELECT symbol, date, day_idx, f32(vwap) AS vwap, volume, f32(vwap_nx1) AS vwap_nx1, f32(vwap_nx10) AS vwap_nx10,
 f32(vwap_week) AS vwap_week, f32(pct_prev) AS pct_prev, f32(vol_10d_mean) AS vol_10d_mean, f32(vol_ma20) AS vol_ma20 FROM fwd""")
def o61_forward_vwaps(spark, d):
    return rounded(daily.forward_vwaps(bars(spark, d)))


@query(BARS + " SELECT symbol, count(*) AS n, f32(median(vwap)) AS median_vwap, f32(median(volume)) AS median_volume FROM bars GROUP BY symbol HAVING count(*) >= 20 AND median(vwap) >= 1000 AND median(volume) >= 20")
def o44_universe(spark, d):
    return rounded(daily.universe(bars(spark, d), 20, 1000.0, 20.0))


@query(BARS + """ SELECT symbol, f32(avg(vwap * volume)) AS dollar_volume, f32(max(close) FILTER (WHERE rn = 1)) AS last_close FROM (
 SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day_idx DESC) AS rn FROM bars) WHERE rn <= 20 GROUP BY symbol HAVING count(*) = 20 AND avg(vwap * volume) >= 30000""")
def o45_liquid_universe(spark, d):
    return rounded(daily.liquid_universe(bars(spark, d), 20, 30000.0))


_RETURNS = """ , rets AS (SELECT symbol, date, day_idx, vwap, least(0.5, greatest(-0.5, r)) AS ret FROM (
 SELECT *, vwap / lag(vwap) OVER w - 1 AS r, lag(day_idx) OVER w AS p FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY day_idx)) WHERE p = day_idx - 1),
 market AS (SELECT date, sector, sum(weight * ret) / sum(weight) AS ret, count(*) AS n, grouping(sector)::INT AS is_market
  FROM rets JOIN sectors USING (symbol) WHERE weight > 0 GROUP BY GROUPING SETS ((date, sector), (date)))"""


@query(BARS + _RETURNS + " SELECT date, sector, f32(ret) AS ret, n, is_market FROM market")
def o41_market_returns(spark, d):
    return rounded(daily.market_returns(daily.session_returns(bars(spark, d)), sectors(spark, d)))


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query(BARS + _RETURNS + " SELECT date, f32(max(ret) FILTER (WHERE is_market = 1)) AS market, " + ", ".join(f"f32(max(ret) FILTER (WHERE sector = '{r}' AND is_market = 0)) AS \"{r.replace(' ', '_')}\"" for r in _REGIONS) + " FROM market GROUP BY date")
def o42_sector_wide(spark, d):
    wide = daily.sector_wide(daily.market_returns(daily.session_returns(bars(spark, d)), sectors(spark, d)), _REGIONS)
    return rounded(wide.withColumnsRenamed({r: r.replace(" ", "_") for r in _REGIONS}))


@query(BARS + _RETURNS + """ SELECT symbol, date, day_idx, f32(ret) AS ret, f32(CASE WHEN count(ret) OVER w >= 5 THEN stddev_samp(ret) OVER w END) AS sigma,
 f32(CASE WHEN count(ret) OVER w >= 5 THEN avg(ret) OVER w END) AS mean, f32(CASE WHEN count(ret) OVER w >= 5 THEN quantile_cont(ret, 0.5) OVER w END) AS median
 FROM rets WINDOW w AS (PARTITION BY symbol ORDER BY day_idx ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)""")
def o66_prior_statistics(spark, d):
    return rounded(daily.daily_volatility(daily.session_returns(bars(spark, d)), 20, 5))


@query(BARS + _RETURNS + """ , j AS (SELECT r.symbol, r.day_idx, r.ret, m.ret AS m FROM rets r JOIN market m ON r.date = m.date AND m.is_market = 1)
 SELECT symbol, day_idx, f32(CASE WHEN count(ret * m) OVER w >= 10 THEN avg(ret * m) OVER w / nullif(avg(m * m) OVER w, 0) END) AS beta
 FROM j WINDOW w AS (PARTITION BY symbol ORDER BY day_idx ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)""")
def o68_beta(spark, d):
    r = daily.session_returns(bars(spark, d))
    m = daily.market_returns(r, sectors(spark, d)).filter("is_market = 1").select("date", F.col("ret").alias("m"))
    return rounded(r.join(m, "date").select("symbol", "day_idx", rolling.beta("ret", "m", rolling.prior("symbol", "day_idx", 60), 10).alias("beta")))


@query(BARS + """ , j AS (SELECT b.date, b.symbol, s.sector, b.vwap FROM bars b JOIN sectors s USING (symbol))
 SELECT date, symbol, sector, f32((sum(vwap) OVER w - vwap) / nullif(count(vwap) OVER w - 1, 0)) AS others,
 f32((rank() OVER (PARTITION BY date, sector ORDER BY vwap) + (count(*) OVER (PARTITION BY date, sector, vwap) - 1) / 2.0)::DOUBLE) AS avg_rank,
 f32((rank() OVER (PARTITION BY date, sector ORDER BY vwap) + (count(*) OVER (PARTITION BY date, sector, vwap) - 1) / 2.0)::DOUBLE / count(*) OVER w) AS pct_rank
 FROM j WINDOW w AS (PARTITION BY date, sector)""")
def o50_o69_cross_section(spark, d):
    j = bars(spark, d).join(sectors(spark, d), "symbol")
    by = ["date", "sector"]
    return rounded(j.select("date", "symbol", "sector", rolling.loo_mean("vwap", by).alias("others"), rolling.average_rank("vwap", by).alias("avg_rank"), rolling.percentile_rank("vwap", by).alias("pct_rank")))


_REL = " , rel AS (SELECT symbol, date AS rel_date, max(order_key) AS order_key, max(form) AS form FROM releases GROUP BY symbol, date)"


def _daily_releases(spark, d):
    return releases(spark, d).groupBy("symbol", F.col("date").alias("rel_date")).agg(F.max("order_key").alias("order_key"), F.max("form").alias("form"))


@query(BARS + _REL + " SELECT b.symbol, b.date, r.rel_date, r.order_key, r.form FROM bars b ASOF LEFT JOIN rel r ON b.symbol = r.symbol AND b.date >= r.rel_date")
def o22_asof_backward(spark, d):
    return asof.asof_join(bars(spark, d).select("symbol", "date"), _daily_releases(spark, d), ["symbol"], "date", "rel_date")


@query(BARS + _REL + " SELECT b.symbol, b.date, r.rel_date, r.order_key, r.form FROM bars b ASOF LEFT JOIN rel r ON b.symbol = r.symbol AND b.date <= r.rel_date")
def o23_asof_forward(spark, d):
    return asof.asof_join(bars(spark, d).select("symbol", "date"), _daily_releases(spark, d), ["symbol"], "date", "rel_date", "forward")


@query(BARS + _REL + """ , f AS (SELECT symbol, arg_min(close, date) AS first_close FROM bars GROUP BY symbol)
 SELECT r.symbol, r.rel_date, f32(coalesce(b.close, f.first_close)) AS close_at FROM rel r ASOF LEFT JOIN (SELECT symbol, date, close FROM bars) b ON r.symbol = b.symbol AND r.rel_date >= b.date LEFT JOIN f ON r.symbol = f.symbol""")
def o24_asof_with_fallback(spark, d):
    b = bars(spark, d)
    first = b.groupBy("symbol").agg(F.min_by("close", "date").alias("first_close"))
    hit = asof.asof_join(_daily_releases(spark, d).select("symbol", "rel_date"), b.select("symbol", "date", "close"), ["symbol"], "rel_date", "date")
    return rounded(hit.join(first, "symbol", "left").select("symbol", "rel_date", F.coalesce("close", "first_close").alias("close_at")))


@query(BARS + _REL + """ SELECT b.symbol, b.date, f32(r.order_key * l.prev) AS cap FROM bars b
 ASOF LEFT JOIN rel r ON b.symbol = r.symbol AND b.date > r.rel_date
 JOIN (SELECT symbol, date, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev FROM bars) l ON l.symbol = b.symbol AND l.date = b.date""")
def o25_market_cap_strict(spark, d):
    b = bars(spark, d).withColumn("prev", F.lag("close").over(Window.partitionBy("symbol").orderBy("date"))).select("symbol", "date", "prev")
    hit = asof.asof_join(b, _daily_releases(spark, d).select("symbol", "rel_date", "order_key"), ["symbol"], "date", "rel_date", strict=True)
    return rounded(hit.select("symbol", "date", (F.col("order_key") * F.col("prev")).alias("cap")))


@query(BARS + """ SELECT r.order_key, r.symbol, (SELECT min(s.day_idx) FROM sessions s WHERE s.date >= r.date) AS day_idx, r.form LIKE '1-%' AS is_urgent FROM releases r""")
def o28_snap_to_session(spark, d):
    r = releases(spark, d).select("order_key", "symbol", "date", F.col("form").startswith("1-").alias("is_urgent"))
    return asof.snap_to_session(r, "date", sessions(spark, d)).drop("date")


_SPLITS = " , splits AS (SELECT symbol, date AS split_date, 0.5::DOUBLE AS factor FROM releases WHERE form = '1-URGENT' AND order_key % 7 = 0)"


def _splits(spark, d):
    return releases(spark, d).filter("form = '1-URGENT' AND order_key % 7 = 0").select("symbol", F.col("date").alias("split_date"), F.lit(0.5).alias("factor"))


@query(BARS + _SPLITS + """ , p AS (SELECT b.symbol, b.date, b.close, b.volume, coalesce(exp(sum(ln(s.factor))), 1.0) AS split_factor FROM bars b LEFT JOIN splits s ON b.symbol = s.symbol AND s.split_date > b.date GROUP BY ALL)
 SELECT symbol, date, f32(split_factor) AS split_factor, f32(close * split_factor) AS adj_close FROM p""")
def o29_split_adjusted(spark, d):
    out = daily.split_adjusted(bars(spark, d).select("symbol", "date", "close", "volume"), _splits(spark, d))
    return rounded(out.select("symbol", "date", "split_factor", "adj_close"))


@query(BARS + """ , c AS (SELECT *, sum(vwap * volume) OVER w AS pv, sum(volume) OVER w AS v FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date))
 , n AS (SELECT c.symbol, c.date, c.pv, c.v, r.rel_date FROM c ASOF LEFT JOIN (SELECT DISTINCT symbol, date AS rel_date FROM releases) r ON c.symbol = r.symbol AND c.date < r.rel_date)
 SELECT n.symbol, n.date, n.rel_date, f32((e.pv - n.pv) / nullif(e.v - n.v, 0)) AS vwap_to_release FROM n ASOF LEFT JOIN (SELECT symbol, date, pv, v FROM c) e ON n.symbol = e.symbol AND n.rel_date >= e.date""")
def o30_vwap_to_next_release(spark, d):
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    c = bars(spark, d).select("symbol", "date", F.sum(F.col("vwap") * F.col("volume")).over(w).alias("pv"), F.sum("volume").over(w).alias("v"))
    days = releases(spark, d).select("symbol", F.col("date").alias("rel_date")).distinct()
    n = asof.asof_join(c, days, ["symbol"], "date", "rel_date", "forward", strict=True)
    known = asof.asof_join(n.filter("rel_date IS NOT NULL"), c.select("symbol", F.col("date").alias("e_date"), F.col("pv").alias("e_pv"), F.col("v").alias("e_v")), ["symbol"], "rel_date", "e_date")
    none = n.filter("rel_date IS NULL").withColumns({"e_date": F.lit(None).cast("date"), "e_pv": F.lit(None).cast("double"), "e_v": F.lit(None).cast("double")})
    return rounded(known.unionByName(none).select("symbol", "date", "rel_date", X.ratio(F.col("e_pv") - F.col("pv"), F.col("e_v") - F.col("v")).alias("vwap_to_release")))


@query(BARS + " SELECT b.symbol, b.date FROM bars b WHERE NOT EXISTS (SELECT 1 FROM releases r WHERE r.symbol = b.symbol AND r.date = b.date) AND b.symbol IN (SELECT symbol FROM sectors WHERE weight > 0)")
def o34_semi_and_anti(spark, d):
    b = bars(spark, d).select("symbol", "date")
    return b.join(releases(spark, d).select("symbol", "date"), ["symbol", "date"], "left_anti").join(sectors(spark, d).filter("weight > 0"), "symbol", "left_semi")


@query(BARS + """ , e AS (SELECT DISTINCT symbol, day_idx FROM bars WHERE trades >= 2), a AS (
 SELECT b.symbol, b.day_idx, b.day_idx - p.day_idx AS since, n.day_idx - b.day_idx AS to FROM (SELECT symbol, day_idx FROM bars) b
 ASOF LEFT JOIN e p ON b.symbol = p.symbol AND b.day_idx >= p.day_idx ASOF LEFT JOIN e n ON b.symbol = n.symbol AND b.day_idx < n.day_idx)
 SELECT symbol, day_idx, since, "to", CASE WHEN since = 0 THEN 'Day' WHEN since <= 2 THEN 'Post' WHEN "to" <= 1 THEN 'Eve' WHEN "to" <= 5 THEN 'Pre' ELSE 'Quiet' END AS "window" FROM a""")
def o112_earnings_windows(spark, d):
    b = bars(spark, d)
    return daily.earnings_counters(b.select("symbol", "day_idx"), b.filter("trades >= 2").select("symbol", "day_idx"))


@query(BARS + """ , snap AS (SELECT r.symbol, r.rel_at, (SELECT min(s.day_idx) FROM sessions s WHERE s.date >= r.date + (hour(r.rel_at) >= 16)::INT) AS day_idx,
   CASE WHEN hour(r.rel_at) >= 16 THEN 'after' WHEN hour(r.rel_at) < 10 THEN 'before' ELSE 'during' END AS timing FROM releases r)
 , one AS (SELECT symbol, day_idx, arg_min(timing, (rel_at, timing)) AS timing FROM snap WHERE day_idx IS NOT NULL GROUP BY symbol, day_idx)
 , rep AS (SELECT DISTINCT symbol, day_idx AS report_idx FROM bars WHERE trades >= 2)
 , g AS (SELECT o.symbol, o.day_idx, o.timing, CASE WHEN r.report_idx - o.day_idx <= 50 THEN r.report_idx END AS grp FROM one o ASOF LEFT JOIN rep r ON o.symbol = r.symbol AND o.day_idx <= r.report_idx)
 SELECT symbol, day_idx, timing, grp, grp IS NULL OR day_idx = max(day_idx) OVER (PARTITION BY symbol, grp) AS scheduled FROM g""")
def o110_announcements(spark, d):
    reports = bars(spark, d).filter("trades >= 2").select("symbol", F.col("day_idx").alias("report_idx"))
    return daily.announcements(releases(spark, d).select("symbol", F.col("at").alias("accepted_at")), reports, sessions(spark, d))


@query(BARS + """ , y AS (SELECT o_orderdate::DATE AS date, avg(o_totalprice) AS value FROM orders GROUP BY ALL), u AS (
 SELECT s.day_idx, s.date, y.value FROM sessions s ASOF LEFT JOIN y ON s.date >= y.date), v AS (SELECT *, lag(value, 1) OVER (ORDER BY day_idx) AS used FROM u)
 SELECT day_idx, date, f32(used) AS used, f32(used - lag(used) OVER (ORDER BY day_idx)) AS change,
 f32(CASE WHEN count(used) OVER w >= 126 THEN (used - avg(used) OVER w) / nullif(stddev_pop(used) OVER w, 0) END) AS z FROM v WINDOW w AS (ORDER BY day_idx ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)""")
def o113_macro_series(spark, d):
    y = read(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.avg("o_totalprice").alias("value"))
    return rounded(daily.macro_series(sessions(spark, d).select("date", "day_idx"), y))


@query(BARS + _RETURNS + _FORWARD + """ SELECT f.symbol, f.date, f.day_idx, f32(f.vwap) AS vwap, f32(vwap_nx1) AS target, f32(vwap_nx1 / f.vwap - 1) AS target_return,
 f32(coalesce(pct_prev, 0)) AS pct_prev, f32(coalesce(vol_10d_mean, 0)) AS vol_10d_mean, (o.ret IS NOT NULL)::INT AS sector_known, f32(coalesce(o.ret, m.ret, 0)) AS sector_ret
 FROM fwd f LEFT JOIN sectors s ON f.symbol = s.symbol LEFT JOIN market m ON f.date = m.date AND m.is_market = 1 LEFT JOIN market o ON f.date = o.date AND o.is_market = 0 AND o.sector = s.sector
 WHERE f.symbol IN (SELECT symbol FROM bars GROUP BY symbol HAVING count(*) >= 20)""")
def o114_panel(spark, d):
    return rounded(daily.panel(bars(spark, d), sectors(spark, d)))


@query(BARS + """ SELECT b.symbol, b.day_idx, f32(b.vwap) AS vwap, """ + ", ".join(f"f32(l{k}.vwap) AS vwap_lag{k}" for k in (1, 2, 5, 20)) + " FROM bars b " + " ".join(f"LEFT JOIN bars l{k} ON l{k}.symbol = b.symbol AND l{k}.day_idx = b.day_idx - {k}" for k in (1, 2, 5, 20)))
def o123_lagged_table(spark, d):
    return rounded(daily.lagged(bars(spark, d).select("symbol", "day_idx", "vwap"), "symbol", "day_idx", ["vwap"], [1, 2, 5, 20]))


@query(BARS + """ SELECT f.fold, s.day_idx, CASE WHEN s.day_idx < f.t - 40 THEN 'train' WHEN s.day_idx < f.t THEN 'stop' WHEN s.day_idx < f.t + 200 THEN 'test' END AS role
 FROM sessions s, (SELECT unnest(range(1, 6)) AS fold, 800 + (unnest(range(1, 6)) - 1) * 200 AS t) f WHERE s.day_idx < f.t + 200""")
def o117_walk_forward_folds(spark, d):
    return daily.folds(sessions(spark, d), 800, 200, 40, 5)


@query(BARS + """ , p AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY day_idx) AS pc FROM bars), r AS (SELECT *, greatest(high - low, abs(high - pc), abs(low - pc)) AS true_range FROM p)
 SELECT symbol, day_idx, f32(true_range) AS true_range, f32(CASE WHEN count(true_range) OVER w >= 5 THEN avg(true_range) OVER w END / close) AS atr_pct FROM r
 WINDOW w AS (PARTITION BY symbol ORDER BY day_idx ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""")
def o118_true_range(spark, d):
    return rounded(daily.true_range(bars(spark, d)).select("symbol", "day_idx", "true_range", "atr_pct"))


@query(BARS + """ , p AS (SELECT *, lag(vwap) OVER w AS pv, lag(day_idx) OVER w AS pd FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY day_idx))
 , c AS (SELECT *, sum(coalesce((day_idx - pd > 60 OR vwap / pv > 10 OR vwap / pv < 0.1)::INT, 0)) OVER (PARTITION BY symbol ORDER BY day_idx) AS part FROM p)
 SELECT symbol, day_idx, symbol::VARCHAR || CASE WHEN max(part) OVER (PARTITION BY symbol) > part THEN '~' || (max(part) OVER (PARTITION BY symbol) - part)::BIGINT::VARCHAR ELSE '' END AS series FROM c""")
def o77_series_breaks(spark, d):
    return rolling.split_series(bars(spark, d).select("symbol", "day_idx", "vwap"), "symbol", "day_idx", "vwap", 60, 10.0).select("symbol", "day_idx", "series")


@query(BARS + """ , m AS (SELECT symbol, day_idx, close > open AS up FROM bars), g AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day_idx) - row_number() OVER (PARTITION BY symbol, up ORDER BY day_idx) AS k FROM m)
 SELECT symbol, min(day_idx) AS start, count(*) AS length FROM g WHERE up GROUP BY symbol, k""")
def o75_runs(spark, d):
    return rolling.runs(bars(spark, d).select("symbol", "day_idx", "open", "close"), ["symbol"], "day_idx", F.col("close") > F.col("open"))


@query(BARS + " SELECT date, symbol, f32(vwap) AS vwap, place FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY vwap DESC, symbol)::INT AS place FROM bars) WHERE place <= 3")
def o81_top_per_day(spark, d):
    return rounded(rolling.top_n(bars(spark, d).select("date", "symbol", "vwap"), ["date"], "vwap", "symbol", 3))


@query(BARS + """ , c AS (SELECT s.symbol, d.date FROM (SELECT DISTINCT symbol FROM bars) s, sessions d) SELECT c.symbol, c.date FROM c ANTI JOIN bars b ON b.symbol = c.symbol AND b.date = c.date
 QUALIFY row_number() OVER (PARTITION BY c.symbol ORDER BY c.date DESC) <= 10""")
def o86_missing_sessions(spark, d):
    return rolling.missing_sessions(bars(spark, d).select("symbol", "date"), sessions(spark, d), 10)


@query(BARS + """ SELECT symbol, f32(last(close ORDER BY day_idx) * max(weight)) AS cap FROM bars JOIN sectors USING (symbol) WHERE weight > 0 GROUP BY symbol HAVING last(close ORDER BY day_idx) * max(weight) > 1000000""")
def o45b_market_cap_selection(spark, d):
    last = bars(spark, d).groupBy("symbol").agg(F.max_by("close", "day_idx").alias("close"))
    return rounded(last.join(sectors(spark, d).filter("weight > 0"), "symbol").select("symbol", (F.col("close") * F.col("weight")).alias("cap")).filter("cap > 1000000"))


@query(BARS + """ SELECT symbol, count(*) AS n, count(DISTINCT date) AS dates, f32(min(vwap)) AS least, f32(max(vwap)) AS most, arg_min(date, (vwap, date)) AS cheapest, f32(quantile_cont(vwap, 0.25)) AS q25, f32(median(vwap)) AS q50,
 f32(quantile_cont(vwap, 0.75)) AS q75, f32(avg((close > open)::INT)) AS up_share, count(*) FILTER (WHERE trades > 1) AS busy FROM bars GROUP BY symbol""")
def o43_o46_o55_summaries(spark, d):
    q = F.percentile("vwap", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = bars(spark, d).groupBy("symbol").agg(F.count("*").alias("n"), F.count_distinct("date").alias("dates"), F.min("vwap").alias("least"), F.max("vwap").alias("most"), F.min_by("date", F.struct("vwap", "date")).alias("cheapest"), q.alias("q"), F.avg((F.col("close") > F.col("open")).cast("int")).alias("up_share"), F.count_if(F.col("trades") > 1).alias("busy"))
    return rounded(out.select("symbol", "n", "dates", "least", "most", "cheapest", F.get("q", F.lit(0)).alias("q25"), F.get("q", F.lit(1)).alias("q50"), F.get("q", F.lit(2)).alias("q75"), "up_share", "busy"))


@query("SELECT s_suppkey AS symbol, CASE WHEN s_acctbal * 1e7 >= 200e9 THEN 'mega' WHEN s_acctbal * 1e7 >= 10e9 THEN 'large' WHEN s_acctbal * 1e7 >= 2e9 THEN 'mid' WHEN s_acctbal * 1e7 >= 250e6 THEN 'small' ELSE 'micro' END AS band FROM supplier")
def o20l_cap_bands(spark, d):
    return read(spark, d, "supplier").select(F.col("s_suppkey").alias("symbol"), X.cap_band(F.col("s_acctbal") * 1e7).alias("band"))
