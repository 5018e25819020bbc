"""Queries of the full training panel. Trades of a line number 1 stand for pre-market prints, those from 6 on for after-hours ones; orders stand for releases, articles, yields and prices."""

from pyspark.sql import functions as F

from marketloom.operators import asof, daily, panel
from marketloom.plans.base import BARS, bars, query, read, releases, rounded, sectors, sessions, trades
from marketloom.plans.daily import _RETURNS, _SPLITS, _splits

TRADES_A_TASK = 150_000
SECTORS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE_EAST"]
_ANN = """ , an AS (SELECT symbol, day_idx, bool_or(form <= '2') AS scheduled FROM (SELECT r.symbol, r.form, (SELECT min(s.day_idx) FROM sessions s WHERE s.date >= r.date) AS day_idx FROM releases r WHERE r.form < '4') WHERE day_idx IS NOT NULL GROUP BY ALL)
 , av AS (SELECT a.symbol, a.day_idx, (SELECT min(c.day_idx) FROM sessions c WHERE c.date >= s.date + INTERVAL 364 DAYS) AS aday FROM an a JOIN sessions s USING (day_idx))
 , pt AS (SELECT a.symbol, a.day_idx AS last_idx, min(p.aday) AS exp_idx FROM an a LEFT JOIN av p ON p.symbol = a.symbol AND p.day_idx <= a.day_idx AND p.aday > a.day_idx + 20 GROUP BY ALL)
 , ew0 AS (SELECT b.symbol, b.day_idx, b.day_idx - p.last_idx AS since, n.day_idx - b.day_idx AS exact, p.exp_idx - b.day_idx AS to_est FROM (SELECT symbol, day_idx FROM bars) b ASOF LEFT JOIN pt p ON p.symbol = b.symbol AND b.day_idx >= p.last_idx ASOF LEFT JOIN (SELECT symbol, day_idx FROM an WHERE scheduled) n ON n.symbol = b.symbol AND b.day_idx <= n.day_idx)
 , ew AS (SELECT symbol, day_idx, since, coalesce(exact, to_est) AS till, CASE WHEN exact IS NOT NULL THEN 0 WHEN to_est IS NOT NULL THEN 1 END AS to_is_est, to_est, {0} AS win, {1} AS win_pit FROM ew0)""".format(
    *[f"CASE WHEN since = 0 THEN 'Earnings_Day' WHEN since BETWEEN 1 AND 3 THEN 'Post_Earnings_Reaction' WHEN since BETWEEN 4 AND 15 THEN 'Post_Earnings_Drift' WHEN {t} BETWEEN 2 AND 10 THEN 'Pre_Earnings_Runup' WHEN {t} BETWEEN -10 AND 1 THEN 'Earnings_Eve' ELSE 'Normal_Trading' END" for t in ("coalesce(exact, to_est)", "to_est")]
)
_MACRO = """ , ye AS (SELECT o_orderdate::DATE AS date, avg(o_totalprice) FILTER (WHERE o_orderpriority < '2') / 1e4 AS short, avg(o_totalprice) FILTER (WHERE o_orderpriority LIKE '3%') / 1e4 AS middle, avg(o_totalprice) FILTER (WHERE o_orderpriority > '5') / 1e4 AS long FROM orders GROUP BY ALL)
 , mp AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, avg(o_totalprice) AS p, avg(o_totalprice) FILTER (WHERE o_orderpriority < '3') AS c FROM orders GROUP BY ALL)
 , cp AS (SELECT (a.month + INTERVAL 1 MONTH)::DATE + 12 AS published, a.p / b.p - 1 AS yoy, a.c / b.c - 1 AS core_yoy FROM mp a JOIN mp b ON b.month = a.month - INTERVAL 1 YEAR)
 , ud AS (SELECT s.day_idx, s.date, y.short, y.middle, y.long, c.yoy, c.core_yoy FROM sessions s ASOF LEFT JOIN ye y ON s.date >= y.date ASOF LEFT JOIN cp c ON s.date >= c.published)
 , ul AS (SELECT day_idx, date, yoy, core_yoy, lag(short) OVER (ORDER BY day_idx) AS short, lag(middle) OVER (ORDER BY day_idx) AS middle, lag(long) OVER (ORDER BY day_idx) AS long FROM ud)
 , md AS (SELECT date, 100 * (short - lag(short) OVER o) AS short_chg, 100 * (middle - lag(middle) OVER o) AS middle_chg, 100 * (long - lag(long) OVER o) AS long_chg, long - middle AS long_middle, long - short AS long_short,
  CASE WHEN count(long) OVER w >= 126 THEN (long - avg(long) OVER w) / nullif(stddev_pop(long) OVER w, 0) END AS long_z252, yoy AS cpi_yoy, core_yoy AS core_cpi_yoy FROM ul WINDOW o AS (ORDER BY day_idx), w AS (ORDER BY day_idx ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING))"""


def announcements(spark, d):
    r = asof.snap_to_session(releases(spark, d).filter("form < '4'").select("symbol", "date", "form"), "date", sessions(spark, d))
    return r.filter("day_idx IS NOT NULL").groupBy("symbol", "day_idx").agg(F.bool_or(F.col("form") <= "2").alias("scheduled"))


@query(BARS + _ANN + ' SELECT symbol, day_idx, since, till AS "to", to_is_est, to_est, win AS "window", win_pit AS window_pit FROM ew')
def o112_point_in_time(spark, d):
    return panel.earnings_windows(bars(spark, d), announcements(spark, d), sessions(spark, d).select("date", "day_idx"))


def macro(spark, d):
    o = read(spark, d, "orders").withColumn("date", F.to_date("o_orderdate"))
    at = lambda c: F.avg(F.when(c, F.col("o_totalprice"))) / 1e4
    p = F.col("o_orderpriority")
    yields = o.groupBy("date").agg(at(p < "2").alias("short"), at(p.startswith("3")).alias("middle"), at(p > "5").alias("long"))
    month = o.groupBy(F.trunc("date", "month").alias("month")).agg(F.avg("o_totalprice").alias("p"), F.avg(F.when(p < "3", F.col("o_totalprice"))).alias("c"))
    ago = month.select(F.add_months("month", 12).alias("month"), F.col("p").alias("p0"), F.col("c").alias("c0"))
    prices = month.join(ago, "month").select(F.date_add(F.add_months("month", 1), 12).alias("published"), (F.col("p") / F.col("p0") - 1).alias("yoy"), (F.col("c") / F.col("c0") - 1).alias("core_yoy"))
    return panel.macro_daily(sessions(spark, d), yields, prices)


@query(BARS + _MACRO + f" SELECT date, {', '.join(f'f32({c}) AS {c}' for c in panel.MACRO)} FROM md")
def o113_macro_daily(spark, d):
    return rounded(macro(spark, d))


_EXT = """ , ex AS (SELECT symbol, date, sum(price * volume) FILTER (WHERE seq2 BETWEEN 2 AND 5) / sum(volume) FILTER (WHERE seq2 BETWEEN 2 AND 5) AS rth_vwap, sum(price * volume) FILTER (WHERE seq2 >= 6) / sum(volume) FILTER (WHERE seq2 >= 6) AS ah_vwap, sum(volume) FILTER (WHERE seq2 >= 6) AS ah_volume,
  sum(price * volume) FILTER (WHERE seq2 = 1) / sum(volume) FILTER (WHERE seq2 = 1) AS pm_vwap, sum(volume) FILTER (WHERE seq2 = 1) AS pm_volume, arg_max(price, seq1) FILTER (WHERE seq2 = 1) AS pm_last, max(price) FILTER (WHERE seq2 = 1) AS pm_high, min(price) FILTER (WHERE seq2 = 1) AS pm_low FROM t GROUP BY ALL)"""


def adjusted(spark, d):
    return daily.split_adjusted(bars(spark, d), _splits(spark, d)).drop("adj_close", "adj_volume")


def whole(spark, d, inference=False):
    cal = sessions(spark, d)
    # As many tasks as the rows need, so that none has to spill.
    tasks = max(1, -(-read(spark, d, "lineitem").count() // TRADES_A_TASK))
    # A day's sums are hardly fewer than its trades: they are dealt by symbol as they are.
    by_symbol = trades(spark, d).select("symbol", "date", "price", "volume").filter("symbol IS NOT NULL").repartition(tasks, "symbol")
    vwaps = by_symbol.groupBy("symbol", "date").agg((F.sum(F.col("price") * F.col("volume")) / F.sum("volume")).alias("vwap")).join(F.broadcast(cal.select("date", "day_idx")), "date")
    wide = daily.sector_wide(daily.market_returns(daily.session_returns(vwaps), sectors(spark, d)), [x.replace("_", " ") for x in SECTORS]).withColumnsRenamed({x.replace("_", " "): x for x in SECTORS})
    groups = sectors(spark, d).select("symbol", F.regexp_replace("sector", " ", "_").alias("sector"), "industry")
    form = F.col("form")
    split = F.when((form == "1-URGENT") & (F.col("order_key") % 7 == 0), 0.5)
    known = releases(spark, d).select("symbol", "date", "form", ((F.substring("form", 1, 1).cast("int") - 3) / 2).alias("score"), split.alias("factor"))
    return panel.full_panel(panel.symbol_days(trades(spark, d), known, cal, tasks), groups, cal, wide, SECTORS, macro(spark, d), 20, inference)


_PX = ("open", "high", "low", "close", "vwap", "rth_vwap", "ah_vwap", "pm_vwap", "pm_last", "pm_high", "pm_low")
_OK = "pv IS NOT NULL AND NOT split"
_PXK = f"(pm_last IS NOT NULL AND open IS NOT NULL AND pv > 0 AND {_OK})"
_FUK = f"(pm_vwap IS NOT NULL AND pm_volume IS NOT NULL AND pm_high IS NOT NULL AND pm_low IS NOT NULL AND vol_10d_mean > 0 AND pv > 0 AND {_OK})"
PANEL = BARS + _RETURNS + _SPLITS + _ANN + _MACRO + _EXT + f""" , sf AS (SELECT b.symbol, b.date, coalesce(exp(sum(ln(s.factor))), 1.0) AS f FROM bars b LEFT JOIN splits s ON b.symbol = s.symbol AND s.split_date > b.date GROUP BY ALL)
 , ca AS (SELECT date, dayofweek(date)::INT AS day_of_week, month(date)::INT AS month, coalesce(month(lead(date) OVER o) <> month(date), false) AS month_end, coalesce(quarter(lead(date) OVER o) <> quarter(date), false) AS quarter_end, date_diff('day', date, lead(date) OVER o)::INT AS days_to_next FROM sessions WINDOW o AS (ORDER BY date))
 , mw AS (SELECT date, max(ret) FILTER (WHERE is_market = 1) AS market, {", ".join(f"max(ret) FILTER (WHERE is_market = 0 AND sector = '{s.replace('_', ' ')}') AS {s}" for s in SECTORS)} FROM market GROUP BY date)
 , fl AS (SELECT symbol, (SELECT min(s.day_idx) FROM sessions s WHERE s.date >= r.date) AS day_idx, max((form = '1-URGENT')::INT) AS is_10k, max((form = '2-HIGH')::INT) AS is_10q FROM releases r GROUP BY ALL)
 , mo AS (SELECT symbol, date, count(*) AS n_articles, avg((substr(form, 1, 1)::INT - 3) / 2) AS mean_score FROM releases GROUP BY ALL)
 , ad AS (SELECT b.symbol, b.date, b.day_idx, replace(s.sector, ' ', '_') AS sector, s.industry, b.trades, EXISTS (SELECT 1 FROM splits p WHERE p.symbol = b.symbol AND p.split_date = b.date) AS split, {", ".join(f"{c} * f AS {c}" for c in _PX)}, volume / f AS volume, ah_volume / f AS ah_volume, pm_volume / f AS pm_volume
  FROM bars b JOIN sf USING (symbol, date) LEFT JOIN ex USING (symbol, date) LEFT JOIN sectors s USING (symbol) WHERE b.symbol IN (SELECT symbol FROM bars GROUP BY symbol HAVING count(*) >= 20))
 , wi AS (SELECT *, CASE WHEN lead(day_idx) OVER o = day_idx + 1 THEN lead(vwap) OVER o END AS target, vwap / nullif(lag(vwap) OVER o, 0) - 1 AS pct_prev, CASE WHEN lag(day_idx) OVER o = day_idx - 1 THEN lag(close) OVER o END AS pc, CASE WHEN lag(day_idx) OVER o = day_idx - 1 THEN lag(vwap) OVER o END AS pv,
  avg(volume) OVER (PARTITION BY symbol ORDER BY day_idx RANGE BETWEEN 19 PRECEDING AND CURRENT ROW) AS vol_ma20, avg(volume) OVER (PARTITION BY symbol ORDER BY day_idx RANGE BETWEEN 10 PRECEDING AND 1 PRECEDING) AS vol_10d_mean FROM ad WINDOW o AS (PARTITION BY symbol ORDER BY day_idx))
 , pa AS (SELECT w.symbol, w.date, w.day_idx, coalesce(w.sector, 'unknown') AS sector, coalesce(industry, 'unknown') AS industry, f32(target) AS target, f32(target / nullif(vwap, 0) - 1) AS target_return, day_of_week, ca.month, month_end, quarter_end, days_to_next, f32(vwap) AS today_vwap, f32(pct_prev) AS pct_prev,
  f32((high - low) / nullif(vwap, 0)) AS spread_pct, f32((close - vwap) / nullif(vwap, 0)) AS close_pos, f32((open - vwap) / nullif(vwap, 0)) AS open_pos, f32((high - vwap) / nullif(vwap, 0)) AS high_pos, f32((low - vwap) / nullif(vwap, 0)) AS low_pos, f32(volume / nullif(vol_ma20, 0)) AS volume_velocity, f32(trades / nullif(volume, 0)) AS trades_per_volume,
  f32(coalesce(mean_score, 0)) AS sentiment, coalesce(n_articles, 0)::INT AS n_articles, (coalesce(n_articles, 0) > 0)::INT AS has_news, coalesce(is_10k, 0) AS is_10k, coalesce(is_10q, 0) AS is_10q, win AS "window", since, till AS "to", to_is_est, win_pit AS window_pit, to_est, f32(coalesce(market, 0)) AS market_ret,
  f32(coalesce({", ".join(f"CASE WHEN w.sector = '{s}' THEN {s} END" for s in SECTORS)}, market, 0)) AS own_sector_ret, {", ".join(f"f32(coalesce({s}, market, 0)) AS sec_{s}" for s in SECTORS)}, {", ".join(f"f32(coalesce({c}, 0)) AS {c}" for c in panel.MACRO)},
  f32(coalesce(open / nullif(pc, 0) - 1, 0)) AS gap_open, f32(coalesce(open / nullif(pv, 0) - 1, 0)) AS gap_open_vwap, f32(coalesce(ah_vwap / nullif(rth_vwap, 0) - 1, 0)) AS ah_vwap_pct, f32(coalesce(ln(1 + 100 * ah_volume / nullif(vol_10d_mean, 0)), 0)) AS ah_vol_pct, f32(coalesce(close / nullif(rth_vwap, 0) - 1, 0)) AS close_pct_rth,
  (ah_vwap IS NOT NULL AND rth_vwap IS NOT NULL)::INT AS ah_known, f32(coalesce(vol_10d_mean, 0)) AS vol_10d_mean, f32(volume) AS volume,
  f32(CASE WHEN {_PXK} THEN greatest(-0.3, least(0.3, pm_last / pv - 1)) ELSE 0 END) AS pm_last_pct, f32(CASE WHEN {_PXK} THEN greatest(-0.3, least(0.3, open / pv - 1)) ELSE 0 END) AS open_pct, coalesce({_PXK}, false)::INT AS pm_px_known,
  f32(CASE WHEN {_FUK} THEN greatest(-0.3, least(0.3, pm_vwap / pv - 1)) ELSE 0 END) AS pm_vwap_pct, f32(CASE WHEN {_FUK} THEN greatest(0.0, least(6.0, ln(1 + 100 * pm_volume / vol_10d_mean))) ELSE 0 END) AS pm_vol_pct, f32(CASE WHEN {_FUK} THEN greatest(0.0, least(1.0, (pm_high - pm_low) / pv)) ELSE 0 END) AS pm_range_pct, coalesce({_FUK}, false)::INT AS pm_full_known
  FROM wi w JOIN ca USING (date) LEFT JOIN mw USING (date) LEFT JOIN md USING (date) LEFT JOIN ew ON ew.symbol = w.symbol AND ew.day_idx = w.day_idx LEFT JOIN fl ON fl.symbol = w.symbol AND fl.day_idx = w.day_idx LEFT JOIN mo ON mo.symbol = w.symbol AND mo.date = w.date WHERE target IS NOT NULL)"""


@query(PANEL + " SELECT * FROM pa")
def o114_full_panel(spark, d):
    """All column groups: target, calendar, bar shape, sentiment, filings, earnings, market and sectors, macro, extended hours, morning."""
    return rounded(whole(spark, d))


@query(BARS + _SPLITS + f""" , sf AS (SELECT b.*, coalesce((SELECT exp(sum(ln(s.factor))) FROM splits s WHERE b.symbol = s.symbol AND s.split_date > b.date), 1.0) AS f FROM bars b), nx AS (SELECT max(day_idx) + 1 AS n FROM sessions),
 la AS (SELECT symbol, avg(volume / f) AS vol_10d_mean, max(CASE WHEN day_idx = n - 1 THEN vwap * f END) AS pv FROM sf, nx WHERE day_idx BETWEEN n - 10 AND n - 1 GROUP BY symbol),
 un AS (SELECT symbol FROM bars GROUP BY symbol HAVING count(*) >= 20),
 mr AS (SELECT s_suppkey AS symbol, 900 + s_suppkey % 700 AS last, CASE WHEN s_suppkey % 3 > 0 THEN 1000 + s_suppkey % 500 END AS open, 950.0 + s_suppkey % 600 AS v, (s_suppkey % 40)::DOUBLE AS vol, s_suppkey % 5 > 0 AS complete FROM supplier),
 jn AS (SELECT un.symbol, la.*  EXCLUDE (symbol), mr.* EXCLUDE (symbol) FROM un LEFT JOIN la USING (symbol) LEFT JOIN mr USING (symbol)),
 kn AS (SELECT *, coalesce(last IS NOT NULL AND open IS NOT NULL AND pv > 0, false) AS px, coalesce(complete AND vol_10d_mean > 0 AND pv > 0, false) AS fu FROM jn)
 SELECT symbol, n::BIGINT AS day_idx, f32(vol_10d_mean) AS vol_10d_mean, f32(CASE WHEN px THEN greatest(-0.3, least(0.3, last / pv - 1)) ELSE 0 END) AS pm_last_pct, f32(CASE WHEN px THEN greatest(-0.3, least(0.3, open / pv - 1)) ELSE 0 END) AS open_pct, px::INT AS pm_px_known,
 f32(CASE WHEN fu THEN greatest(-0.3, least(0.3, v / pv - 1)) ELSE 0 END) AS pm_vwap_pct, f32(CASE WHEN fu THEN greatest(0.0, least(6.0, ln(1 + 100 * vol / vol_10d_mean))) ELSE 0 END) AS pm_vol_pct, f32(CASE WHEN fu THEN greatest(0.0, least(1.0, 20 / pv)) ELSE 0 END) AS pm_range_pct, fu::INT AS pm_full_known, 'x1' AS export_id FROM kn, nx""")
def o115_next_session(spark, d):
    """Next-session rows filled from morning records, one a supplier."""
    cal = sessions(spark, d)
    end = cal.agg(F.max("day_idx").alias("n"), F.date_add(F.max("date"), 1).alias("date")).first()
    members = daily.universe(bars(spark, d), 20, 0.0, 0.0).select("symbol")
    s, k = read(spark, d, "supplier"), F.col("s_suppkey")
    day = F.lit(end.date)
    prices = s.select(k.alias("symbol"), day.alias("date"), (900.0 + k % 700).alias("last"), F.when(k % 3 > 0, 1000.0 + k % 500).alias("open"))
    full = s.select(k.alias("symbol"), day.alias("date"), F.lit("09:15").alias("cutoff"), (950.0 + k % 600).alias("pm_vwap"), (k % 40).cast("double").alias("pm_volume"), (960.0 + k % 600).alias("pm_high"), (940.0 + k % 600).alias("pm_low"), (k % 5 > 0).alias("complete"))
    rows = panel.next_rows(members, adjusted(spark, d), end.n + 1, "x1")
    splits = _splits(spark, d).select("symbol", F.col("split_date").alias("date"))
    return rounded(panel.fill_next(rows, prices, full, {"date": end.date, "cutoff": "09:15", "export_id": "x1"}, splits))
