"""Queries of feed work."""

from pyspark.sql import functions as F

from marketloom.operators import asof, feeds, rolling
from marketloom.plans.base import BARS, bars, query, read, releases, rounded, sectors, sessions
from marketloom.plans.intraday import POLLS, polls, series


@query("SELECT event_type AS symbol, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ms, f32(value) AS price FROM events")
def o09_aggregate_messages(spark, d):
    e = read(spark, d, "events")
    raw = e.select(F.to_json(F.struct(F.lit("A").alias("ev"), F.col("event_type").alias("sym"), F.unix_millis(F.col("ts").cast("timestamp")).alias("s"), F.col("value").alias("c"))).alias("value"))
    return rounded(feeds.aggregate_messages(raw)[0].select("symbol", F.col("ts").cast("timestamp_ntz").alias("ms"), "price"))


@query("SELECT l_partkey AS ticker, f32(l_extendedprice) AS open, f32(l_extendedprice) AS close, l_quantity AS volume, l_linenumber AS trades, f32(floor(l_quantity / l_linenumber + 0.5)) AS avg_trade_size FROM lineitem WHERE l_partkey IS NOT NULL")
def o10_rest_bars(spark, d):
    t = read(spark, d, "lineitem").select(F.col("l_partkey").alias("t"), F.col("l_extendedprice").alias("o"), F.col("l_extendedprice").alias("c"), F.col("l_quantity").alias("v"), F.col("l_linenumber").alias("n"))
    return rounded(feeds.rest_bars(t))


@query("SELECT count(*) FILTER (WHERE k IS NOT NULL) AS matched, count(*) FILTER (WHERE k IS NULL) AS unmatched FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT') o ON c.c_custkey = o.k")
def o19c_memberships(spark, d):
    pairs = read(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k"), "o_orderpriority")
    return feeds.memberships(pairs, read(spark, d, "customer").select(F.col("c_custkey").alias("k")), "k", "o_orderpriority")[1]


@query("""WITH l AS (SELECT p_partkey % 50 AS ticker, CASE WHEN p_size % 3 = 0 THEN 'ADR' ELSE 'CS' END AS kind, p_type AS name, p_size > 20 AS active FROM part), o AS (SELECT ticker, arg_min(name, CASE WHEN kind = 'CS' AND NOT regexp_matches(name, '(?i)note|preferred|fund|rights') THEN (NOT active, name) END) FILTER (WHERE kind = 'CS' AND NOT regexp_matches(name, '(?i)note|preferred|fund|rights')) AS best, bool_or(kind = 'ADR') AS adr FROM l GROUP BY ticker)
 SELECT b.ticker, o.best AS name, CASE WHEN o.best IS NOT NULL THEN 'kept' WHEN o.adr THEN 'adr' ELSE 'no row' END AS reason FROM (SELECT DISTINCT l_suppkey AS ticker FROM lineitem) b LEFT JOIN o USING (ticker)""")
def o20d_universe_from_bars(spark, d):
    p = read(spark, d, "part").select((F.col("p_partkey") % 50).alias("ticker"), F.when(F.col("p_size") % 3 == 0, "ADR").otherwise("CS").alias("kind"), F.col("p_type").alias("name"), (F.col("p_size") > 20).alias("active"))
    return feeds.universe_from_bars(read(spark, d, "lineitem").select(F.col("l_suppkey").alias("ticker")), p)


@query(BARS + " SELECT max(date) AS date, year(date)::INT AS year, quarter(date)::INT AS quarter FROM sessions GROUP BY 2, 3 HAVING max(date) NOT IN (SELECT max(date) FROM sessions GROUP BY year(date))")
def o20m_snapshot_dates(spark, d):
    s = sessions(spark, d)
    return feeds.snapshot_dates(s, s.groupBy(F.year("date").alias("y")).agg(F.max("date").alias("date")))


@query(POLLS + """, b AS (SELECT symbol, date, cum_v AS bar_v, min(ts) AS bar_ts FROM series WHERE n % 2 = 0 GROUP BY ALL) SELECT p.symbol, p.date, p.ts, b.bar_ts FROM (SELECT symbol, date, ts, cum_v FROM series WHERE n % 2 = 1) p ASOF LEFT JOIN b ON p.symbol = b.symbol AND p.date = b.date AND p.cum_v <= b.bar_v""")
def o27_value_crossing(spark, d):
    s = series(spark, d).select("symbol", "date", "ts", "cum_v", "n")
    right = s.filter("n % 2 = 0").select("symbol", "date", F.col("cum_v").alias("bar_v"), F.col("ts").alias("bar_ts"))
    return feeds.cross_volume(s.filter("n % 2 = 1").drop("n"), right).select("symbol", "date", "ts", "bar_ts")


@query(POLLS + """, x AS (SELECT *, lag(cum_v) OVER w AS v0, lag(cum_pv) OVER w AS p0 FROM series WINDOW w AS (PARTITION BY symbol, date ORDER BY ts)) SELECT symbol, f32(avg((abs((p0 + price * volume) / (v0 + volume) - cum_pv / cum_v) < 1e-6)::INT)) AS follows, f32(sum(CASE WHEN hour(ts) BETWEEN 9 AND 15 THEN 0 ELSE volume END) / sum(volume)) AS outside_share, count(*) AS n FROM x GROUP BY symbol""")
def o47_feed_semantics(spark, d):
    return rounded(feeds.semantics(series(spark, d)))


@query(BARS + """ , f AS (SELECT r.symbol, (SELECT min(s.day_idx) FROM sessions s WHERE s.date >= r.date) AS day_idx, bool_or(form LIKE '1%') AS k, bool_or(form LIKE '2%') AS q FROM releases r GROUP BY ALL), g AS (SELECT symbol, day_idx, bool_or(k) AS k, bool_or(q) AS q FROM f GROUP BY ALL)
 SELECT b.symbol, b.day_idx, coalesce(g.k, false) AS is_10k, coalesce(g.q, false) AS is_10q FROM bars b LEFT JOIN g ON b.symbol = g.symbol AND b.day_idx = g.day_idx""")
def o111_filing_flags(spark, d):
    f = asof.snap_to_session(releases(spark, d), "date", sessions(spark, d))
    return feeds.filing_flags(bars(spark, d).select("symbol", "day_idx"), f)


@query(BARS + """ , j AS (SELECT symbol, abs(vwap / ((open + close) / 2) - 1) * 10000 AS bp FROM bars) SELECT symbol, count(*) AS n, f32(quantile_cont(bp, 0.5)) AS median_bp, f32(quantile_cont(bp, 0.95)) AS p95_bp FROM j GROUP BY symbol""")
def o136_vwap_check(spark, d):
    b = bars(spark, d)
    return rounded(feeds.vwap_check(b.select("symbol", "date", F.col("vwap").alias("feed_vwap")), b.select("symbol", "date", ((F.col("open") + F.col("close")) / 2).alias("daily_vwap"))))


@query("""SELECT event_id, f32(coalesce(CASE WHEN user_id % 4 = 0 THEN value END, CASE WHEN value + user_id % 3 - 1 >= value THEN (value + user_id % 3 - 1 + value) / 2 END, CASE WHEN user_id % 2 = 0 THEN value * 1.01 END)) AS chosen, ts - INTERVAL 15 MINUTES >= date_trunc('hour', ts) AS complete FROM events""")
def o124_o126b_price_selection(spark, d):
    e = read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = e.select("event_id", F.when(F.col("user_id") % 4 == 0, F.col("value")).alias("live"), F.col("value").alias("bid"), (F.col("value") + F.col("user_id") % 3 - 1).alias("ask"), F.when(F.col("user_id") % 2 == 0, F.lit(1.0)).alias("day_open"), (F.col("value") * 1.01).alias("price"), F.col("ts").alias("fetched_at"), F.date_trunc("hour", "ts").alias("cut"))
    return rounded(feeds.complete(feeds.selected_price(rows), "cut", 15).select("event_id", "chosen", "complete"))


@query(POLLS + """, u AS (SELECT DISTINCT symbol, ts FROM polls), g AS (SELECT * FROM (SELECT symbol, ts AS a, lead(ts) OVER (PARTITION BY symbol ORDER BY ts) AS b FROM u) WHERE epoch_us(b) - epoch_us(a) > 3600000000)
 SELECT p.symbol, p.at_ts AS at, NOT EXISTS (SELECT 1 FROM g WHERE g.symbol = p.symbol AND g.b > p.at_ts - INTERVAL 120 MINUTES AND g.a < p.at_ts) AS gap_free FROM grid p""")
def o132_gap_free(spark, d):
    from marketloom.operators import intraday

    p = polls(spark, d).select("symbol", "ts")
    points = intraday.grid(series(spark, d), 60, 9, 16).select("symbol", "at")
    return feeds.gap_free(points, rolling.gaps(p, ["symbol"], "ts", 3600), 120).select("symbol", "at", "gap_free")


@query(BARS + " SELECT symbol, day_idx, f32(lag(vwap) OVER (PARTITION BY symbol ORDER BY day_idx)) AS vwap, false AS padding FROM bars UNION ALL SELECT symbol, max(day_idx) + 1, f32(arg_max(vwap, day_idx)), true FROM bars GROUP BY symbol")
def o162_model_frame(spark, d):
    return rounded(feeds.model_frame(bars(spark, d).select("symbol", "day_idx", "vwap"), "vwap"))


@query(BARS + " SELECT sector, count(DISTINCT b.symbol) AS members, f32(sum(vwap * volume)) AS dollars FROM bars b JOIN sectors USING (symbol) GROUP BY sector")
def o21_dimension_joins(spark, d):
    j = bars(spark, d).join(sectors(spark, d), "symbol")
    return rounded(j.groupBy("sector").agg(F.count_distinct("symbol").alias("members"), F.sum(F.col("vwap") * F.col("volume")).alias("dollars")))
