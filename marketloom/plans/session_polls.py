"""Queries over events as a feed of regular sessions: volumes so far as reported (some are missing, some fall back), prices that are missing at times, opens and previous closes."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.operators import feeds, intraday
from marketloom.operators import session_polls as sp
from marketloom.plans.base import query, read, rounded
from marketloom.plans.intraday import POLLS, polls

OPENS, CLOSES, GRACE, LEAST, LONG = 570, 960, 30, 900.0, 5400.0
HORIZONS, POLLS_NEEDED = {"r_15m": 900, "r_60m": 3600, "r_120m": 7200}, {"r_15m": 2}

FEED = """
WITH raw AS (
  SELECT event_type AS symbol, ts::DATE AS date, ts, event_id, CASE WHEN event_id % 17 <> 0 AND value > 0 THEN value END AS price, regexp_extract(props, '(\\d+)', 1)::DOUBLE + 1 AS size, value FROM events
), feed AS (
  SELECT symbol, date, ts, price, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN v / 2 ELSE v END AS volume, CASE WHEN event_id % 5 = 0 THEN value + 1 END AS day_open, CASE WHEN event_id % 7 = 0 THEN value + 2 END AS prev_close
  FROM (SELECT *, sum(size) OVER (PARTITION BY symbol, date ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS v FROM raw)
), one AS (
  SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY symbol, date, ts ORDER BY volume DESC NULLS LAST, price DESC NULLS LAST, day_open DESC NULLS LAST, prev_close DESC NULLS LAST) = 1
), m1 AS (
  SELECT *, last_value(price IGNORE NULLS) OVER u AS p, coalesce(max(volume) OVER u, 0) AS v, max(CASE WHEN ts <= date + INTERVAL 570 MINUTES THEN ts END) OVER d AS base,
    min(CASE WHEN ts >= date + INTERVAL 57630 SECONDS THEN ts END) OVER d AS aft, max(ts) OVER d AS fin, arg_min(prev_close, ts) FILTER (WHERE prev_close IS NOT NULL) OVER d AS prev
  FROM one WINDOW u AS (PARTITION BY symbol, date ORDER BY ts ROWS UNBOUNDED PRECEDING), d AS (PARTITION BY symbol, date)
), m2 AS (
  SELECT *, coalesce(aft, fin) AS tail, coalesce(ts BETWEEN base AND coalesce(aft, fin), false) AS inside FROM m1
), m3 AS (
  SELECT *, CASE WHEN base IS NULL THEN 'no_premarket' WHEN tail <= base OR max(CASE WHEN inside THEN p END) OVER (PARTITION BY symbol, date) IS NULL THEN 'no_rth' END AS reason FROM m2
), s1 AS (
  SELECT symbol, date, ts, v, aft, tail, coalesce(p, arg_min(p, ts) FILTER (WHERE p IS NOT NULL) OVER d) AS price, coalesce(prev, first_value(p) OVER o) AS prev_close,
    arg_min(day_open, ts) FILTER (WHERE day_open IS NOT NULL) OVER d AS day_open, coalesce(v - lag(v) OVER o, 0) AS traded, (epoch_us(ts) - epoch_us(lag(ts) OVER o)) / 1e6 AS gap
  FROM m3 WHERE inside AND reason IS NULL WINDOW o AS (PARTITION BY symbol, date ORDER BY ts), d AS (PARTITION BY symbol, date)
), s2 AS (
  SELECT *, (price + lag(price) OVER o) / 2 AS mid, coalesce(ln(price / lag(price) OVER o), 0) AS r, nullif(sign(price - lag(price) OVER o), 0) AS sg, min(CASE WHEN traded > 0 THEN ts END) OVER d AS ft,
    greatest(900.0, 2.5 * quantile_cont(gap, 0.5) OVER d) AS gap_short FROM s1 WINDOW o AS (PARTITION BY symbol, date ORDER BY ts), d AS (PARTITION BY symbol, date)
), s3 AS (
  SELECT *, coalesce(last_value(sg IGNORE NULLS) OVER (PARTITION BY symbol, date ORDER BY ts ROWS UNBOUNDED PRECEDING), 0) AS side, CASE WHEN ts = ft AND day_open IS NOT NULL THEN day_open ELSE coalesce(mid, 0) END AS px FROM s2
), series AS (
  SELECT symbol, date, ts, price, traded, side, day_open, prev_close, gap_short, aft IS NOT NULL AS covered_close, tail AS last_poll, CASE WHEN aft IS NOT NULL THEN tail ELSE date + INTERVAL 57630 SECONDS END AS end_time,
    sum(traded) OVER u AS cum_v, sum(traded * px) OVER u AS cum_pv, sum(traded * side) OVER u AS cum_sv, sum(r * r) OVER u AS cum_rv, coalesce(max(CASE WHEN traded > 0 THEN ts END) OVER u, min(ts) OVER d) AS traded_at,
    count(*) OVER u AS n, sum((coalesce(gap, 0) > 5400)::INT) OVER u AS long_gaps, sum((coalesce(gap, 0) > gap_short)::INT) OVER u AS short_gaps
  FROM s3 WINDOW u AS (PARTITION BY symbol, date ORDER BY ts ROWS UNBOUNDED PRECEDING), d AS (PARTITION BY symbol, date)
)"""
GRID = """, days AS (SELECT DISTINCT symbol, date, gap_short, covered_close, last_poll, end_time FROM series), grid AS (
  SELECT *, unnest(generate_series(date + INTERVAL 570 MINUTES, date + INTERVAL 57599 SECONDS, INTERVAL 30 MINUTES)) AS at_ts FROM days)"""


def feed(spark, d):
    e = read(spark, d, "events")
    size = F.get_json_object("props", "$.k").cast("double") + 1
    raw = e.select(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value", size.alias("size"))
    so_far = F.sum("size").over(Window.partitionBy("symbol", "date").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0))
    every = lambda k: F.col("event_id") % k == 0
    return raw.withColumn("v", so_far).select(
        "symbol", "date", "ts", F.when(~every(17) & (F.col("value") > 0), F.col("value")).alias("price"),
        F.when(every(11), None).when(every(13), F.col("v") / 2).otherwise(F.col("v")).alias("volume"),
        F.when(every(5), F.col("value") + 1).alias("day_open"), F.when(every(7), F.col("value") + 2).alias("prev_close"), "size",
    )


def regular(spark, d):
    return sp.session_series(feed(spark, d), OPENS, CLOSES, GRACE, LEAST, LONG)


def points(spark, d):
    return sp.session_grid(regular(spark, d), OPENS, CLOSES, 1800)


@query(FEED + """ SELECT symbol, date, ts, f32(price) AS price, f32(traded) AS traded, side::DOUBLE AS side, f32(day_open) AS day_open, f32(prev_close) AS prev_close, f32(gap_short) AS gap_short, covered_close, last_poll, end_time,
 f32(cum_v) AS cum_v, f32(cum_pv) AS cum_pv, f32(cum_sv) AS cum_sv, f32(cum_rv) AS cum_rv, traded_at, n, long_gaps::BIGINT AS long_gaps, short_gaps::BIGINT AS short_gaps FROM series""")
def o130_session_series(spark, d):
    return rounded(regular(spark, d))


@query(FEED + " SELECT reason, count(*) AS n FROM (SELECT symbol, date, coalesce(max(reason), 'kept') AS reason FROM m3 GROUP BY symbol, date) GROUP BY reason")
def o130_series_drops(spark, d):
    return sp.series_drops(feed(spark, d), OPENS, CLOSES, GRACE).groupBy("reason").agg(F.count("*").alias("n"))


@query(FEED + GRID + """ SELECT g.symbol, g.date, g.at_ts AS at, f32(s.price) AS price, f32(least((epoch_us(g.at_ts) - epoch_us(s.ts)) / 1e6, 600)) AS staleness, f32(least((epoch_us(g.at_ts) - epoch_us(s.traded_at)) / 1e6, 600)) AS since_trade
 FROM grid g ASOF LEFT JOIN series s ON g.symbol = s.symbol AND g.date = s.date AND g.at_ts >= s.ts""")
def o37_held_prices(spark, d):
    return rounded(sp.held_prices(points(spark, d), regular(spark, d)))


def _window_sql(name: str, seconds: int | None) -> str:
    gaps = "short" if seconds is not None and seconds < 3600 else "long"
    ok = f"{name}.cum_v - b.cum_v > 0 AND {name}.until_{gaps} = b.{gaps}_gaps AND " + ("b.covered_close" if seconds is None else f"{name}.t <= b.last_poll AND {name}.t > b.at_ts")
    return ok + (f" AND {name}.n - b.n >= {POLLS_NEEDED[name]}" if name in POLLS_NEEDED else "")


_WINDOWS = HORIZONS | {"r_rod": None}
_VALID = {n: _window_sql(n, k) for n, k in _WINDOWS.items()} | {"r_close": "w.day_vwap IS NOT NULL"}
_MOVE = {n: f"ln((({n}.cum_pv - b.cum_pv) / nullif({n}.cum_v - b.cum_v, 0)) / b.price)" for n in _WINDOWS} | {"r_close": "ln(w.day_vwap / b.price)"}


@query(FEED + GRID + """, ahead AS (SELECT *, coalesce(lead(long_gaps) OVER o, long_gaps) AS next_long, coalesce(lead(short_gaps) OVER o, short_gaps) AS next_short FROM series WINDOW o AS (PARTITION BY symbol, date ORDER BY ts))
 , asked AS (SELECT *, at_ts AS t, 'b' AS w FROM grid""" + "".join(f" UNION ALL SELECT *, {'end_time' if k is None else f'least(at_ts + INTERVAL {k} SECONDS, end_time)'}, '{n}' FROM grid" for n, k in _WINDOWS.items()) + """)
 , hit AS (SELECT a.symbol, a.date, a.at_ts, a.covered_close, a.last_poll, a.t, a.w, s.price, s.cum_v, s.cum_pv, s.n, s.long_gaps, s.short_gaps, CASE WHEN s.ts = a.t THEN s.long_gaps ELSE s.next_long END AS until_long, CASE WHEN s.ts = a.t THEN s.short_gaps ELSE s.next_short END AS until_short
   FROM asked a ASOF LEFT JOIN ahead s ON a.symbol = s.symbol AND a.date = s.date AND a.t >= s.ts)
 , w AS (SELECT symbol, date, sum(price * size) / sum(size) AS day_vwap FROM raw WHERE price IS NOT NULL GROUP BY symbol, date HAVING count(*) % 4 <> 0)
 SELECT b.symbol, b.date, b.at_ts AS at, f32(b.price) AS last, """ + ", ".join(f"f32(CASE WHEN {v} THEN {_MOVE[n]} END) AS {n}" for n, v in _VALID.items()) + ", (" + " + ".join(f"{1 << i} * coalesce({v}, false)::INT" for i, v in enumerate(_VALID.values())) + ")::INT AS tmask FROM (SELECT * FROM hit WHERE w = 'b') b "
 + " ".join(f"JOIN (SELECT * FROM hit WHERE w = '{n}') {n} ON b.symbol = {n}.symbol AND b.date = {n}.date AND b.at_ts = {n}.at_ts" for n in _WINDOWS) + " LEFT JOIN w ON b.symbol = w.symbol AND b.date = w.date")
def o135_session_targets(spark, d):
    f = feed(spark, d).filter("price IS NOT NULL").groupBy("symbol", "date")
    vwap = f.agg((F.sum(F.col("price") * F.col("size")) / F.sum("size")).alias("day_vwap"), F.count("*").alias("k")).filter("k % 4 <> 0").drop("k")
    return rounded(sp.session_targets(points(spark, d).join(vwap, ["symbol", "date"], "left"), regular(spark, d), HORIZONS, 3600, POLLS_NEEDED))


SEEN = POLLS + """, q AS (SELECT symbol, date, event_id AS poll_id, ts - INTERVAL 15 MINUTES AS at_ts, price FROM polls)
, b AS (SELECT symbol, time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS bar_end, min(price) AS low, max(price) AS high, arg_max(price, (ts, price)) AS close FROM polls GROUP BY ALL)
, pv AS (SELECT symbol, date, lag(c) OVER (PARTITION BY symbol ORDER BY date) AS previous_close FROM (SELECT symbol, date, arg_max(price, (ts, price)) AS c FROM polls GROUP BY ALL))
, pr AS (SELECT q.symbol, q.poll_id, q.price, (epoch_us(b.bar_end) - epoch_us(q.at_ts)) / 1e6 AS off, q.price BETWEEN b.low - 0.5 AND b.high + 0.5 AS inside, abs(q.price - b.close) < 0.5 AS closes FROM q JOIN b ON q.symbol = b.symbol AND b.bar_end BETWEEN q.at_ts - INTERVAL 7200 SECONDS AND q.at_ts + INTERVAL 7200 SECONDS)
, sn AS (SELECT symbol, poll_id, arg_min(off, (abs(off), off)) FILTER (WHERE abs(off) <= 1800 AND closes) AS off_close, min(abs(off)) FILTER (WHERE abs(off) <= 1800 AND inside) AS n, min(abs(off)) FILTER (WHERE inside) AS f FROM pr GROUP BY ALL)
, si AS (SELECT q.*, off_close, coalesce(n, f) AS off_range, CASE WHEN off_close > 0 AND off_close <= 600 THEN 'close shortly after' WHEN off_close BETWEEN -600 AND 0 THEN 'close shortly before' WHEN n <= 600 THEN 'inside a bar close by' WHEN n IS NOT NULL THEN 'printed near' WHEN f IS NOT NULL THEN 'printed far'
  WHEN abs(price - previous_close) < 0.5 THEN 'previous close' ELSE 'not printed' END AS sighting FROM q LEFT JOIN sn USING (symbol, poll_id) LEFT JOIN pv USING (symbol, date))"""


def seen(spark, d):
    p = polls(spark, d)
    bars = intraday.minute_bars(p, 5).select("symbol", F.timestamp_add("MINUTE", F.lit(5), "minute").alias("bar_end"), "low", "high", "close")
    close = p.groupBy("symbol", "date").agg(F.max_by("price", F.struct("ts", "price")).alias("c"))
    previous = close.select("symbol", "date", F.lag("c").over(Window.partitionBy("symbol").orderBy("date")).alias("previous_close"))
    asked = p.select("symbol", "date", F.col("event_id").alias("poll_id"), F.timestamp_add("MINUTE", F.lit(-15), "ts").alias("at"), "price")
    return feeds.sightings(asked, bars, previous, 600, 1800, 7200, 0.5)


@query(SEEN + " SELECT symbol, date, poll_id, at_ts AS at, f32(price) AS price, f32(off_close) AS off_close, f32(off_range) AS off_range, sighting FROM si")
def o31_sightings(spark, d):
    return rounded(seen(spark, d))
