"""Queries over events as a poll feed: event_type is the symbol, value the price and the number in props the volume."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.operators import asof, intraday, rolling
from marketloom.plans.base import query, read, rounded

POLLS = r"""
WITH polls AS (
  SELECT event_type AS symbol, ts::DATE AS date, ts, value AS price, regexp_extract(props, '(\d+)', 1)::DOUBLE + 1 AS volume, user_id, event_id FROM events
), one AS (
  SELECT symbol, date, ts, arg_max(price, (volume, price)) AS price, max(volume) AS volume FROM polls GROUP BY ALL
), sg AS (
  SELECT *, sign(price - lag(price) OVER w) AS s, lnp(price / lag(price) OVER w) AS r FROM one WINDOW w AS (PARTITION BY symbol, date ORDER BY ts)
), sd AS (
  SELECT *, coalesce(last_value(CASE WHEN s <> 0 THEN s END IGNORE NULLS) OVER w, 0) AS side FROM sg WINDOW w AS (PARTITION BY symbol, date ORDER BY ts ROWS UNBOUNDED PRECEDING)
), series AS (
  SELECT symbol, date, ts, price, volume, side, sum(volume) OVER w AS cum_v, sum(price * volume) OVER w AS cum_pv, sum(side * volume) OVER w AS cum_sv,
    sum(coalesce(r * r, 0)) OVER w AS cum_rv, max(price) OVER w AS high, min(price) OVER w AS low, count(*) OVER w AS n
  FROM sd WINDOW w AS (PARTITION BY symbol, date ORDER BY ts ROWS UNBOUNDED PRECEDING)
), mins AS (
  SELECT symbol, date, time_bucket(INTERVAL 30 MINUTES, ts) AS minute, arg_min(price, (ts, price)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, price)) AS close,
    sum(volume) AS volume, sum(price * volume) / sum(volume) AS vwap FROM polls GROUP BY ALL
), span AS (
  SELECT symbol, date, unnest(generate_series(min(minute), max(minute), INTERVAL 30 MINUTES)) AS minute FROM mins GROUP BY symbol, date
), dense AS (
  SELECT symbol, date, minute, open, coalesce(high, c) AS high, coalesce(low, c) AS low, coalesce(vwap, c) AS vwap, c AS close, coalesce(volume, 0) AS volume FROM (
    SELECT s.*, m.open, m.high, m.low, m.vwap, m.volume, last_value(m.close IGNORE NULLS) OVER (PARTITION BY s.symbol, s.date ORDER BY s.minute ROWS UNBOUNDED PRECEDING) AS c
    FROM span s LEFT JOIN mins m USING (symbol, date, minute))
), grid AS (
  SELECT symbol, date, unnest(generate_series(date + INTERVAL 9 HOURS, date + INTERVAL 16 HOURS, INTERVAL 60 MINUTES)) AS at_ts FROM (SELECT DISTINCT symbol, date FROM series)
)"""


def polls(spark, d):
    e = read(spark, d, "events")
    return e.select(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("volume"), "user_id", "event_id")


def series(spark, d):
    return intraday.poll_series(polls(spark, d))


def dense(spark, d):
    return intraday.dense(intraday.minute_bars(polls(spark, d), 30), 30)


def entries(spark, d):
    m = dense(spark, d)
    return m.filter(F.hour("minute").isin(10, 13) & (F.minute("minute") == 0)).select("symbol", "date", F.col("minute").alias("at"), F.col("close").alias("entry"))


@query(POLLS + " SELECT symbol, date, ts, f32(price) AS price, volume, side::DOUBLE AS side, f32(cum_v) AS cum_v, f32(cum_pv) AS cum_pv, f32(cum_sv) AS cum_sv, f32(cum_rv) AS cum_rv, f32(high) AS high, f32(low) AS low, n FROM series")
def o130_o142_poll_series(spark, d):
    return rounded(series(spark, d))


@query(POLLS + " SELECT symbol, date, minute, f32(open) AS open, f32(high) AS high, f32(low) AS low, f32(close) AS close, volume, f32(vwap) AS vwap FROM dense")
def o38_dense_minutes(spark, d):
    return rounded(dense(spark, d))


@query(POLLS + """, lk AS (SELECT g.*, m, g.at_ts - to_minutes(m) AS t FROM grid g, (SELECT unnest([0, 60, 240]) AS m)), hit AS (
 SELECT l.symbol, l.date, l.at_ts, l.m, coalesce(s.cum_v, 0) AS v, coalesce(s.cum_pv, 0) AS pv FROM lk l ASOF LEFT JOIN (SELECT symbol, date, ts, cum_v, cum_pv FROM series) s ON l.symbol = s.symbol AND l.date = s.date AND l.t >= s.ts),
 w AS (SELECT symbol, date, at_ts, max(v) FILTER (WHERE m = 0) AS v0, max(pv) FILTER (WHERE m = 0) AS p0, max(v) FILTER (WHERE m = 60) AS v1, max(pv) FILTER (WHERE m = 60) AS p1, max(v) FILTER (WHERE m = 240) AS v2, max(pv) FILTER (WHERE m = 240) AS p2 FROM hit GROUP BY ALL)
 SELECT symbol, date, at_ts AS at, f32(v0 - v1) AS volume_60m, f32((p0 - p1) / nullif(v0 - v1, 0)) AS vwap_60m, f32(v0 - v2) AS volume_240m, f32((p0 - p2) / nullif(v0 - v2, 0)) AS vwap_240m, f32(p0 / nullif(v0, 0)) AS session_vwap FROM w""")
def o131_o134_grid_windows(spark, d):
    s = series(spark, d)
    return rounded(intraday.windows_at(intraday.grid(s, 60, 9, 16), s, [60, 240]))


@query(POLLS + """, lk AS (SELECT g.*, m, g.at_ts + to_minutes(m) AS t FROM grid g, (SELECT unnest([0, 60, 240]) AS m)), hit AS (
 SELECT l.symbol, l.date, l.at_ts, l.m, s.price AS p, s.n FROM lk l ASOF LEFT JOIN (SELECT symbol, date, ts, price, n FROM series) s ON l.symbol = s.symbol AND l.date = s.date AND l.t >= s.ts),
 w AS (SELECT symbol, date, at_ts, max(p) FILTER (WHERE m = 0) AS p0, max(n) FILTER (WHERE m = 0) AS n0, max(p) FILTER (WHERE m = 60) AS p1, max(n) FILTER (WHERE m = 60) AS n1, max(p) FILTER (WHERE m = 240) AS p2, max(n) FILTER (WHERE m = 240) AS n2 FROM hit GROUP BY ALL)
 SELECT symbol, date, at_ts AS at, f32(CASE WHEN n1 > n0 THEN ln(p1 / p0) END) AS r_60m, f32(CASE WHEN n2 > n0 THEN ln(p2 / p0) END) AS r_240m, (coalesce(n1 > n0, false)::INT + 2 * coalesce(n2 > n0, false)::INT)::INT AS tmask FROM w""")
def o135_o105_targets(spark, d):
    s = series(spark, d)
    return rounded(intraday.target_mask(intraday.grid(s, 60, 9, 16), s, [60, 240]))


@query(POLLS + """, x AS (SELECT *, max(high) OVER u AS hs, min(low) OVER u AS ls, max(high) OVER f AS hc, min(low) OVER f AS lc FROM dense WINDOW u AS (PARTITION BY symbol, date ORDER BY minute ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY symbol, date ORDER BY minute ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
 y AS (SELECT *, last_value(CASE WHEN high = hs THEN minute END IGNORE NULLS) OVER u AS ht, last_value(CASE WHEN low = ls THEN minute END IGNORE NULLS) OVER u AS lt FROM x WINDOW u AS (PARTITION BY symbol, date ORDER BY minute ROWS UNBOUNDED PRECEDING))
 SELECT symbol, date, minute, f32(hs) AS high_so_far, f32(ls) AS low_so_far, date_diff('minute', ht, minute) AS since_high, date_diff('minute', lt, minute) AS since_low, f32((close - ls) / nullif(hs - ls, 0)) AS in_range, f32(hc) AS high_to_come, f32(lc) AS low_to_come FROM y""")
def o73_o74_running_extremes(spark, d):
    return rounded(intraday.running_extremes(dense(spark, d)))


@query(POLLS + """ SELECT (hour(minute) * 60 + minute(minute))::INT AS minute_of_day, f32(avg(share)) AS share, count(*) AS n FROM (
 SELECT minute, sum(volume) OVER (PARTITION BY symbol, date ORDER BY minute ROWS UNBOUNDED PRECEDING) / sum(volume) OVER (PARTITION BY symbol, date) AS share FROM dense) GROUP BY ALL""")
def o49_volume_curve(spark, d):
    return rounded(intraday.typical_curve(dense(spark, d)))


_ENTRIES = ", entries AS (SELECT symbol, date, minute AS at_ts, close AS entry FROM dense WHERE hour(minute) IN (10, 13) AND minute(minute) = 0), j AS (SELECT e.symbol, e.date, e.at_ts, m.minute, m.high, m.low, ln(m.vwap / e.entry) AS x, m.volume AS v FROM entries e JOIN dense m ON e.symbol = m.symbol AND e.date = m.date AND m.minute > e.at_ts AND m.minute <= e.at_ts + INTERVAL 240 MINUTES)"


@query(POLLS + _ENTRIES + """ SELECT symbol, date, at_ts AS at, f32(coalesce(sum(x * v) FILTER (WHERE x > 0) / nullif(sum(v), 0), 0)) AS bulge, f32(coalesce(sum(-x * v) FILTER (WHERE x < 0) / nullif(sum(v), 0), 0)) AS sag,
 f32(coalesce(sum(v) FILTER (WHERE x > 0) / nullif(sum(v), 0), 0)) AS mass_up, f32(coalesce(sum(v) FILTER (WHERE x < 0) / nullif(sum(v), 0), 0)) AS mass_down,
 f32(CASE WHEN sum(v) FILTER (WHERE x > 0) >= 0.05 * sum(v) THEN sum(x * v) FILTER (WHERE x > 0) / nullif(sum(v) FILTER (WHERE x > 0), 0) END) AS centre_up, f32(sum(x * v) / nullif(sum(v), 0)) AS net FROM j GROUP BY ALL""")
def o148_o149_pockets(spark, d):
    return rounded(intraday.pockets(dense(spark, d), entries(spark, d), 240))


@query(POLLS + _ENTRIES + " SELECT symbol, date, at_ts AS at, f32(max(high)) AS high, f32(min(low)) AS low, arg_min(minute, (-high, minute)) AS high_at, arg_min(minute, (low, minute)) AS low_at FROM j GROUP BY ALL")
def o153_excursions(spark, d):
    return rounded(intraday.excursions(dense(spark, d), entries(spark, d), 240))


@query(POLLS + """, h AS (SELECT *, coalesce(epoch_us(lead(ts) OVER (PARTITION BY symbol, date ORDER BY ts)) - epoch_us(ts), 0) / 1e6 AS held, floor(price / 10.0)::BIGINT AS bin FROM series),
 b AS (SELECT symbol, date, bin, sum(held) AS seconds, sum(volume) AS volume FROM h GROUP BY ALL)
 SELECT symbol, date, bin, f32(seconds) AS seconds, volume, row_number() OVER (PARTITION BY symbol, date ORDER BY seconds DESC, bin) = 1 AS is_control FROM b""")
def o144_time_at_price(spark, d):
    return rounded(intraday.time_at_price(series(spark, d), 10.0))


@query()
def o145_value_area(spark, d):
    """The fold has no SQL twin; tested against a plain loop."""
    p = polls(spark, d).withColumn("bin", F.floor("price").cast("int"))
    h = p.groupBy("symbol", "date", "bin").agg(F.sum("volume").alias("v"))
    filled = h.groupBy("symbol", "date").agg(F.min("bin").alias("bottom"), F.max("bin").alias("top"), F.map_from_entries(F.collect_list(F.struct("bin", "v"))).alias("m"))
    hist = F.transform(F.sequence("bottom", "top"), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))
    out = filled.select("symbol", "date", "bottom", intraday.value_area(hist).alias("a"))
    return rounded(out.select("symbol", "date", (F.col("bottom") + F.col("a.low")).alias("low"), (F.col("bottom") + F.col("a.high")).alias("high"), F.col("a.held").alias("held")))


@query()
def o141_zigzag(spark, d):
    """Stateful legs have no SQL twin; tested against a plain loop and for no repaint."""
    m = dense(spark, d).groupBy("symbol", "date").agg(F.sort_array(F.collect_list(F.struct("minute", "close"))).alias("m"))
    legs = intraday.zigzag(F.transform("m", lambda x: x["close"]), 0.3)
    return rounded(m.select("symbol", "date", F.posexplode(legs).alias("at", "leg")).select("symbol", "date", "at", "leg.*"))


@query()
def o79_hysteresis_and_rearming(spark, d):
    """Stateful scans of a day's ordered ranks; tested against a plain loop."""
    m = dense(spark, d).withColumn("rank", F.row_number().over(Window.partitionBy("minute").orderBy(F.desc("close"), "symbol")))
    day = m.groupBy("symbol", "date").agg(F.sort_array(F.collect_list(F.struct("minute", "rank", "close"))).alias("m"))
    on = rolling.hysteresis(F.transform("m", lambda x: x["rank"]), 1, 2)
    fired = rolling.rearming(F.transform("m", lambda x: F.unix_seconds(x["minute"])), F.transform("m", lambda x: x["close"]), 60.0, 7200)
    return day.select("symbol", "date", F.size(F.filter(on, lambda x: x)).alias("minutes_on"), F.size(fired).alias("fires"))


@query(POLLS + """, g AS (SELECT DISTINCT symbol, ts FROM polls), l AS (SELECT symbol, ts AS gap_start, lead(ts) OVER (PARTITION BY symbol ORDER BY ts) AS gap_end FROM g)
 SELECT symbol, gap_start, gap_end, f32((epoch_us(gap_end) - epoch_us(gap_start)) / 1e6) AS gap_s FROM l WHERE epoch_us(gap_end) - epoch_us(gap_start) > 3600000000""")
def o76_gaps(spark, d):
    return rounded(rolling.gaps(polls(spark, d).select("symbol", "ts"), ["symbol"], "ts", 3600))


@query(POLLS + """ SELECT a.event_id, b.event_id AS other_id FROM polls a JOIN polls b ON a.symbol = b.symbol AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 120000000 WHERE a.user_id % 2 = 0 AND b.user_id % 2 = 1""")
def o31_proximity_join(spark, d):
    p = polls(spark, d)
    a, b = p.filter("user_id % 2 = 0").select("event_id", "symbol", "ts"), p.filter("user_id % 2 = 1").select(F.col("event_id").alias("other_id"), "symbol", F.col("ts").alias("other_ts"))
    return asof.near_join(a, b, ["symbol"], "ts", "other_ts", 120).select("event_id", "other_id")


@query(POLLS + """, lag AS (SELECT unnest([0, 60, 300, 1800]) AS s), q AS (SELECT p.event_id, p.symbol, p.price, l.s, p.ts - to_seconds(l.s) AS t FROM polls p, lag l WHERE p.user_id % 5 = 0)
 , b AS (SELECT symbol, ts, avg(price) AS bar FROM polls WHERE user_id % 5 <> 0 GROUP BY ALL), h AS (SELECT q.symbol, q.s, q.price, b.bar FROM q ASOF LEFT JOIN b ON q.symbol = b.symbol AND q.t >= b.ts)
 SELECT symbol, s AS lag_s, count(bar) AS n, f32(avg((abs(bar - price) <= 20)::INT)) AS match_rate FROM h GROUP BY ALL""")
def o26_lag_scan(spark, d):
    p = polls(spark, d)
    q = p.filter("user_id % 5 = 0").select("event_id", "symbol", "price", "ts", F.explode(F.array(*[F.lit(x) for x in (0, 60, 300, 1800)])).alias("lag_s"))
    b = p.filter("user_id % 5 <> 0").groupBy("symbol", F.col("ts").alias("b_ts")).agg(F.avg("price").alias("bar"))
    hit = asof.asof_join(q.withColumn("t", F.timestamp_add("SECOND", -F.col("lag_s"), F.col("ts"))), b, ["symbol"], "t", "b_ts")
    return rounded(hit.groupBy("symbol", "lag_s").agg(F.count("bar").alias("n"), F.avg((F.abs(F.col("bar") - F.col("price")) <= 20).cast("int")).alias("match_rate")))


@query(r"""SELECT event_id, regexp_extract(props, '(\d+)', 1) AS k, (hour(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York') * 60 + minute(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York'))::INT AS ny_minute, (ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York')::DATE AS ny_date FROM events""")
def o90_o103_clock_and_json(spark, d):
    from marketloom.functions.expr import ny_minute, ny_time

    ts = F.col("ts").cast("timestamp")
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), ny_minute(ts).alias("ny_minute"), F.to_date(ny_time(ts)).alias("ny_date"))


@query(POLLS + " SELECT symbol, date, event_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY md5(event_id::VARCHAR), event_id) AS rn FROM polls) WHERE rn <= 5")
def o83_deterministic_sample(spark, d):
    w = Window.partitionBy("symbol", "date").orderBy(F.md5(F.col("event_id").cast("string")), "event_id")
    return polls(spark, d).withColumn("rn", F.row_number().over(w)).filter("rn <= 5").select("symbol", "date", "event_id")


@query(POLLS + " SELECT symbol, date, count(*) AS n_rows, count(DISTINCT ts) AS polls, count(DISTINCT user_id) AS users, min(ts) AS first_ts, max(ts) AS last_ts FROM polls GROUP BY ALL")
def o60_feed_summary(spark, d):
    return polls(spark, d).groupBy("symbol", "date").agg(F.count("*").alias("n_rows"), F.count_distinct("ts").alias("polls"), F.count_distinct("user_id").alias("users"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
