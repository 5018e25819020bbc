"""Queries of what happens after a decision."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.operators import paths
from marketloom.plans.base import query, rounded
from marketloom.plans.intraday import POLLS, dense, entries, series

BINS, CLOSES = [(0, 60), (60, 120), (120, 240), (240, None)], 960

E = POLLS + """, entries AS (SELECT symbol, date, minute AS at_ts, close AS entry FROM dense WHERE hour(minute) IN (10, 13) AND minute(minute) = 0), aft AS (SELECT e.symbol, e.date, e.at_ts, e.entry, m.minute, m.high, m.low, m.close, m.vwap, m.volume, date_diff('minute', e.at_ts, m.minute) AS age FROM entries e JOIN dense m ON e.symbol = m.symbol AND e.date = m.date AND m.minute > e.at_ts AND m.minute <= e.at_ts + INTERVAL 240 MINUTES)
, tc AS (SELECT symbol, date, at_ts, min(minute) FILTER (WHERE high >= entry * (1 + 0.2)) AS up_at, min(minute) FILTER (WHERE low <= entry * (1 - 0.2)) AS down_at FROM aft GROUP BY ALL)
, rc AS (SELECT *, CASE WHEN up_at IS NULL AND down_at IS NULL THEN 'neither' WHEN up_at = down_at THEN 'both' WHEN down_at IS NULL OR up_at < down_at THEN 'win' ELSE 'loss' END AS race FROM tc)"""


@query(E + " SELECT symbol, date, at_ts AS at, up_at, down_at, race FROM rc")
def o150_o161_touches(spark, d):
    return paths.touches(dense(spark, d), entries(spark, d), 240, 0.2)


@query(E + " SELECT symbol, count(*) AS n, " + ", ".join(f"f32(avg((race = '{r}')::INT)) AS {r}" for r in ("win", "loss", "both", "neither")) + " FROM rc GROUP BY symbol")
def o160b_touch_rates(spark, d):
    return rounded(paths.touch_rates(paths.touches(dense(spark, d), entries(spark, d), 240, 0.2), ["symbol"]))


@query(E + " SELECT a.symbol, a.date, a.at_ts AS at, f32(coalesce(sum(CASE WHEN least(r.up_at, r.down_at) IS NULL OR a.minute < least(r.up_at, r.down_at) THEN a.volume ELSE 0 END) / nullif(sum(a.volume), 0), 1)) AS share FROM aft a JOIN rc r ON a.symbol = r.symbol AND a.date = r.date AND a.at_ts = r.at_ts GROUP BY ALL")
def o150_volume_until_touch(spark, d):
    return rounded(paths.volume_until_touch(dense(spark, d), entries(spark, d), 240, 0.2))


@query(E + " SELECT symbol, date, at_ts AS at, CASE WHEN age <= 60 THEN 0 ELSE 1 END AS bin, f32(sum(vwap * volume) / nullif(sum(volume), 0)) AS vwap, f32(avg(close)) AS twap, f32(arg_max(close, minute)) AS last, sum(volume) AS volume FROM aft GROUP BY ALL")
def o154_averages(spark, d):
    return rounded(paths.averages(dense(spark, d), entries(spark, d), [(0, 60), (60, 240)]))


@query(E + " SELECT symbol, date, at_ts AS at, f32(avg((close > entry)::INT)) AS above, f32(avg((close < entry)::INT)) AS below FROM aft GROUP BY ALL")
def o151_occupancy(spark, d):
    return rounded(paths.occupancy(dense(spark, d), entries(spark, d), 240))


@query(E + " SELECT e.symbol, e.date, e.at_ts AS at, f32(sum(ln(m.vwap / e.entry) * m.volume) / nullif(sum(m.volume), 0)) AS net FROM entries e JOIN dense m ON e.symbol = m.symbol AND e.date = m.date AND m.minute <= e.at_ts AND m.minute > e.at_ts - INTERVAL 120 MINUTES GROUP BY ALL")
def o152_persistence(spark, d):
    return rounded(paths.persistence(dense(spark, d), entries(spark, d), 120))


@query(POLLS + " SELECT symbol, date, minute, volume, f32(CASE WHEN count(volume) OVER w >= 5 THEN quantile_cont(volume, 0.5) OVER w END) AS normal FROM (SELECT *, hour(minute) * 60 + minute(minute) AS slot FROM dense) WINDOW w AS (PARTITION BY symbol, slot ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)")
def o67_prior_normals(spark, d):
    return rounded(paths.prior_normals(dense(spark, d), 20, 5))


@query(POLLS + " SELECT symbol, date, block::BIGINT AS block, f32(sum(r * r)) AS ssq, count(r) AS n FROM (SELECT symbol, date, floor((hour(minute) * 60 + minute(minute)) / 120.0) AS block, ln(vwap / lag(vwap) OVER (PARTITION BY symbol, date ORDER BY minute)) AS r FROM dense) GROUP BY ALL")
def o40_squared_changes(spark, d):
    return rounded(paths.squared_changes(dense(spark, d), 120))


@query(POLLS + """, st AS (SELECT *, lnp(price / lag(price) OVER (PARTITION BY symbol, date ORDER BY ts)) AS step, floor(epoch(ts))::BIGINT AS t FROM series), p AS (SELECT *, CASE WHEN side > 0 THEN volume ELSE 0 END AS u, CASE WHEN side < 0 THEN volume ELSE 0 END AS dn, coalesce(greatest(step, 0), 0) AS pu, coalesce(greatest(-step, 0), 0) AS pd FROM st)
 SELECT symbol, date, ts, f32(ln((sum(u) OVER w / (sum(pu) OVER w + 0.01) + 1) / (sum(dn) OVER w / (sum(pd) OVER w + 0.01) + 1))) AS balance_120m FROM p WINDOW w AS (PARTITION BY symbol, date ORDER BY t RANGE BETWEEN 7200 PRECEDING AND CURRENT ROW)""")
def o143_resistance(spark, d):
    return rounded(paths.resistance(series(spark, d), [120]))


# Entries with a sigma (root mean square of a symbol's steps) and a typical day's volume.
ASKED = POLLS + """, stp AS (SELECT symbol, ln(vwap / lag(vwap) OVER (PARTITION BY symbol, date ORDER BY minute)) AS r FROM dense), sg2 AS (SELECT symbol, sqrt(avg(r * r)) AS sigma FROM stp GROUP BY symbol)
, ty AS (SELECT symbol, avg(v) AS typical FROM (SELECT symbol, date, sum(volume) AS v FROM dense GROUP BY symbol, date) GROUP BY symbol)
, nm AS (SELECT symbol, date, minute, high, low, vwap, volume, CASE WHEN count(volume) OVER w >= 5 THEN quantile_cont(volume, 0.5) OVER w END AS normal FROM (SELECT *, hour(minute) * 60 + minute(minute) AS slot FROM dense) WINDOW w AS (PARTITION BY symbol, slot ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
, en AS (SELECT symbol, date, minute AS at_ts, close AS entry, sigma, typical, 960 - hour(minute) * 60 - minute(minute) AS rest FROM dense JOIN sg2 USING (symbol) JOIN ty USING (symbol) WHERE hour(minute) IN (10, 13) AND minute(minute) = 0)"""
BIN_TARGETS = ASKED + """, bn AS (SELECT en.*, b.bin, b.a, least(b.b, rest) AS b, coalesce(b.b > rest, false)::INT AS cut FROM en, (VALUES (1, 0, 60), (2, 60, 120), (3, 120, 240), (4, 240, NULL)) b(bin, a, b))
, jn AS (SELECT b.symbol, b.date, b.at_ts, b.bin, b.cut, greatest(coalesce(b.b, rest) - b.a, 0) AS mins, ln(m.vwap / b.entry) / b.sigma AS d, CASE WHEN ln(m.vwap / b.entry) / b.sigma IS NOT NULL THEN m.volume ELSE 0 END AS v, m.normal
  FROM bn b LEFT JOIN nm m ON b.symbol = m.symbol AND b.date = m.date AND m.minute > b.at_ts + to_minutes(b.a) AND m.minute <= b.at_ts + to_minutes(coalesce(b.b, rest)))
, gb AS (SELECT symbol, date, at_ts, bin, cut, mins, sum(v) AS volume, coalesce(sum(normal), 0) AS nv, coalesce(sum(d * v) FILTER (WHERE d > 0), 0) AS u, coalesce(sum(-d * v) FILTER (WHERE d < 0), 0) AS w, coalesce(sum(v) FILTER (WHERE d > 0), 0) AS mu, coalesce(sum(v) FILTER (WHERE d < 0), 0) AS md FROM jn GROUP BY ALL)
, tg AS (SELECT symbol, date, at_ts, bin, volume, u / nullif(volume, 0) AS bulge, w / nullif(volume, 0) AS sag, mu / nullif(volume, 0) AS mass_up, md / nullif(volume, 0) AS mass_dn, CASE WHEN mu / nullif(volume, 0) >= 0.05 THEN u / nullif(mu, 0) END AS cm_up, CASE WHEN md / nullif(volume, 0) >= 0.05 THEN w / nullif(md, 0) END AS cm_dn,
  (u - w) / nullif(volume, 0) AS net, ln((volume + 1) / (nv + 1)) AS rvol, u / nullif(volume, 0) * (volume / nullif(nv, 0)) / nullif(mins, 0) AS pi_up, w / nullif(volume, 0) * (volume / nullif(nv, 0)) / nullif(mins, 0) AS pi_dn, cut, mins FROM gb)"""


def normals(spark, d):
    m = dense(spark, d)
    return m.join(paths.prior_normals(m, 20, 5).drop("volume"), ["symbol", "date", "minute"])


def asked(spark, d):
    m = dense(spark, d)
    r = F.ln(F.col("vwap") / F.lag("vwap").over(Window.partitionBy("symbol", "date").orderBy("minute")))
    sigma = m.select("symbol", r.alias("r")).groupBy("symbol").agg(F.sqrt(F.avg(F.col("r") * F.col("r"))).alias("sigma"))
    typical = m.groupBy("symbol", "date").agg(F.sum("volume").alias("v")).groupBy("symbol").agg(F.avg("v").alias("typical"))
    return entries(spark, d).join(sigma, "symbol").join(typical, "symbol")


@query(BIN_TARGETS + " SELECT symbol, date, at_ts AS at, bin, " + ", ".join(f"f32({c}) AS {c}" for c in "volume bulge sag mass_up mass_dn cm_up cm_dn net rvol pi_up pi_dn".split()) + ", cut, mins::INT AS mins FROM tg")
def o149_bin_targets(spark, d):
    out = paths.bin_targets(normals(spark, d), asked(spark, d), BINS, CLOSES)
    return rounded(out.withColumn("mins", F.col("mins").cast("int")))


@query(BIN_TARGETS + " SELECT symbol, date, at_ts AS at, (arg_max(bin, (pi_up, -bin)) FILTER (WHERE pi_up IS NOT NULL))::INT AS peak_up, (arg_max(bin, (pi_dn, -bin)) FILTER (WHERE pi_dn IS NOT NULL))::INT AS peak_dn FROM tg GROUP BY ALL")
def o150_peak_bins(spark, d):
    return paths.peak_bins(paths.bin_targets(normals(spark, d), asked(spark, d), BINS, CLOSES))


@query(ASKED + """, af AS (SELECT e.symbol, e.date, e.at_ts, e.entry, e.sigma, e.typical, m.minute, date_diff('minute', e.at_ts, m.minute) AS age, ln(m.vwap / e.entry) / e.sigma AS d, ln(m.high / e.entry) AS h, ln(m.low / e.entry) AS l, m.volume AS v FROM en e JOIN nm m ON e.symbol = m.symbol AND e.date = m.date AND m.minute > e.at_ts AND m.minute <= e.at_ts + INTERVAL 240 MINUTES AND hour(m.minute) * 60 + minute(m.minute) <= 960)
, cu AS (SELECT *, sum(v) OVER u AS cum, sum(greatest(d * v, 0)) OVER u AS cu, sum(greatest(-d * v, 0)) OVER u AS cd, sum(greatest(d * v, 0)) OVER w AS tu, sum(greatest(-d * v, 0)) OVER w AS td FROM af WINDOW u AS (PARTITION BY symbol, date, at_ts ORDER BY minute ROWS UNBOUNDED PRECEDING), w AS (PARTITION BY symbol, date, at_ts ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
, gr AS (SELECT symbol, date, at_ts, (min(age) FILTER (WHERE cu >= 0.5 * tu AND tu > 0))::INT AS t50_up, (min(age) FILTER (WHERE cd >= 0.5 * td AND td > 0))::INT AS t50_dn, coalesce(arg_min(cum, age) FILTER (WHERE h >= ln(1.1)) / max(typical), 1) AS vol_to_up, coalesce(arg_min(cum, age) FILTER (WHERE -l >= ln(1.1)) / max(typical), 1) AS vol_to_dn,
  coalesce(min(age) FILTER (WHERE h >= 0.5 * sigma), 1e9) AS ru, coalesce(min(age) FILTER (WHERE -l >= 0.5 * sigma), 1e9) AS rd, sum(v) FILTER (WHERE d > 0) AS mu, max(tu) AS tu, max(td) AS td, sum(v) AS tot FROM cu GROUP BY ALL)
 SELECT symbol, date, at_ts AS at, t50_up, t50_dn, f32(vol_to_up) AS vol_to_up, f32(vol_to_dn) AS vol_to_dn, (CASE WHEN ru < rd THEN 0 WHEN rd < ru THEN 1 ELSE 2 END)::INT AS race, f32(coalesce(mu, 0) / nullif(tot, 0)) AS mass_up, f32(tu / nullif(tot, 0)) AS bulge, f32(td / nullif(tot, 0)) AS sag, f32((tu - td) / nullif(tot, 0)) AS net FROM gr""")
def o150_row_targets(spark, d):
    return rounded(paths.row_targets(dense(spark, d), asked(spark, d), 240, CLOSES, move=0.1))
