"""Queries of model frames."""

from pyspark.sql import functions as F

from marketloom.operators import frames
from marketloom.plans.base import query, read, rounded
from marketloom.plans.intraday import POLLS, dense, series


@query(POLLS + " SELECT symbol, date, minute FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY minute) - 1 AS i FROM dense) WHERE i % 4 = ('0x' || substr(md5(symbol || '|' || date::VARCHAR), 1, 8))::BIGINT % 4")
def o155_staggered_decisions(spark, d):
    return frames.staggered(dense(spark, d), 4).select("symbol", "date", "minute")


@query("WITH k AS (SELECT user_id AS v, count(DISTINCT ts::DATE) AS n FROM events GROUP BY 1 HAVING count(DISTINCT ts::DATE) >= 5), c AS (SELECT v, row_number() OVER (ORDER BY v)::INT AS code FROM k) SELECT e.event_id, coalesce(c.code, 0)::INT AS code FROM events e LEFT JOIN c ON e.user_id = c.v")
def o157_vocabulary(spark, d):
    e = read(spark, d, "events").withColumn("date", F.to_date("ts"))
    return frames.coded(e, "user_id", frames.vocabulary(e, "user_id", "date", 5), "code").select("event_id", "code")


@query("WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS b, quantile_cont(value, 0.75) AS c FROM events) SELECT event_id, f32(coalesce(greatest(-5.0, least(5.0, (value - b) / nullif((c - a) / 1.349, 0))), 0)) AS value FROM events, q")
def o157_robust_scale(spark, d):
    return rounded(frames.scaled(read(spark, d, "events").select("event_id", "value"), ["value"]))


@query(POLLS + " SELECT symbol, date, minute, f32(volume / nullif(sum(volume) OVER g, 0)) AS share, f32(coalesce(sum(volume) OVER a / nullif(sum(volume) OVER g, 0), 0)) AS to_come, date_diff('minute', minute, max(minute) OVER g) AS to_close FROM dense WINDOW g AS (PARTITION BY symbol, date), a AS (PARTITION BY symbol, date ORDER BY minute ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)")
def o140_o156_normal_shares(spark, d):
    return rounded(frames.normal_shares(dense(spark, d)))


@query(POLLS + """ SELECT symbol, date, minute, f32(ln(close / lag(close, 3) OVER o)) AS ret_3, f32((max(high) OVER w - min(low) OVER w) / close) AS range_3, f32((close - min(low) OVER w) / nullif(max(high) OVER w - min(low) OVER w, 0)) AS place_3,
 f32(close / (sum(vwap * volume) OVER u / nullif(sum(volume) OVER u, 0)) - 1) AS off_vwap FROM dense WINDOW o AS (PARTITION BY symbol, date ORDER BY minute), w AS (PARTITION BY symbol, date ORDER BY minute ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), u AS (PARTITION BY symbol, date ORDER BY minute ROWS UNBOUNDED PRECEDING)""")
def o158_indicators(spark, d):
    return rounded(frames.indicators(dense(spark, d), [3]))


@query(POLLS + """, n AS (SELECT symbol, date, minute, close >= max(high) OVER (PARTITION BY symbol, date ORDER BY minute ROWS UNBOUNDED PRECEDING) * (1 - 0.2) AS n FROM dense), s AS (SELECT *, (n AND NOT coalesce(lag(n) OVER (PARTITION BY symbol, date ORDER BY minute), false))::INT AS s FROM n)
 SELECT symbol, date, sum(s)::BIGINT AS visits, f32(sum(n::INT)::DOUBLE / nullif(sum(s), 0)) AS mean_rows FROM s GROUP BY ALL""")
def o146_visits(spark, d):
    return rounded(frames.visits(dense(spark, d), 0.2))


@query(POLLS + """, h AS (SELECT symbol, date, date_trunc('hour', ts) AS hour, price, volume, coalesce(epoch_us(lead(ts) OVER (PARTITION BY symbol, date ORDER BY ts)) - epoch_us(ts), 0) / 1e6 AS held FROM series), g AS (SELECT symbol, date, hour, sum(price * held) / nullif(sum(held), 0) AS twap, sum(price * volume) / nullif(sum(volume), 0) AS vwap FROM h GROUP BY ALL)
 SELECT symbol, date, hour, f32(twap) AS twap, f32(vwap) AS vwap, f32(vwap / nullif(twap, 0) - 1) AS gap FROM g""")
def o147_time_weighted(spark, d):
    return rounded(frames.time_weighted(series(spark, d)))
