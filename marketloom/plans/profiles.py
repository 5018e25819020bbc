"""Queries of profiles over regular sessions."""

from pyspark.sql import functions as F

from marketloom.operators import profiles
from marketloom.operators import session_polls as sp
from marketloom.plans.base import query, rounded
from marketloom.plans.session_polls import FEED, GRID, OPENS, points, regular

STEP, WIDTH, HALF_LIFE, NEAR, MOVE = 1800, 0.1, 3600.0, 0.1, 0.1
_OUT = "poc time_above dwell poc_faded time_above_faded dwell_faded accept linger_high linger_low volume_up volume_down".split()

SQL = FEED + GRID + """, dd AS (SELECT symbol, date, max(cum_rv) AS rv, max(cum_v) AS v, max(prev_close) AS ref FROM series GROUP BY ALL), sy AS (SELECT symbol, sqrt(avg(rv)) AS sigma, avg(v) AS typical FROM dd GROUP BY symbol)
, sl AS (SELECT * FROM dd JOIN sy USING (symbol) WHERE ref > 0 AND sigma > 0)
, hd AS (SELECT symbol, date, price, traded, epoch_us(lead(ts) OVER (PARTITION BY symbol, date ORDER BY ts)) / 1e6 AS nx, greatest(epoch_us(ts) / 1e6, epoch_us(date::TIMESTAMP) / 1e6 + 34200) AS f FROM series)
, hb AS (SELECT h.symbol, h.date, h.traded, h.f, greatest(coalesce(h.nx, h.f), h.f) AS t, floor(ln(h.price / l.ref) / l.sigma / 0.1 + 0.5) AS bin FROM hd h JOIN sl l USING (symbol, date))
, ct AS (SELECT *, ceil(f / 1800)::BIGINT AS k0, unnest(range(ceil(f / 1800)::BIGINT, greatest(ceil(t / 1800), ceil(f / 1800))::BIGINT + 1)) AS k FROM hb)
, iv AS (SELECT symbol, date, bin, k * 1800 AS step_end, greatest(f, k * 1800 - 1800.0) AS a, least(t, k * 1800.0) AS b, CASE WHEN k = k0 THEN traded ELSE 0 END AS v FROM ct)
, ce AS (SELECT symbol, date, step_end, bin, sum(greatest(b - a, 0)) AS s, sum(greatest((exp((b - step_end) * (ln(2) / 3600)) - exp((a - step_end) * (ln(2) / 3600))) * (3600 / ln(2)), 0)) AS w, sum(v) AS v FROM iv GROUP BY ALL)
, pt AS (SELECT s.symbol, s.date, s.at_ts, epoch(s.at_ts)::BIGINT AS at_s, floor(ln(s.price / l.ref) / l.sigma / 0.1 + 0.5) AS now, greatest(floor(ln(1.1) / l.sigma / 0.1 + 0.5), 1) AS reach, l.typical FROM (SELECT g.*, s.price FROM grid g ASOF LEFT JOIN series s ON g.symbol = s.symbol AND g.date = s.date AND g.at_ts >= s.ts) s JOIN sl l ON l.symbol = s.symbol AND l.date = s.date)
, hs AS (SELECT p.symbol, p.date, p.at_ts, p.reach, p.typical, c.bin, c.bin - p.now AS off, sum(c.s) AS s, sum(c.w * exp((c.step_end - p.at_s) * (ln(2) / 3600))) AS w, sum(c.v) AS v FROM pt p JOIN ce c ON p.symbol = c.symbol AND p.date = c.date AND c.step_end <= p.at_s WHERE p.now IS NOT NULL GROUP BY ALL)
, he AS (SELECT *, max(CASE WHEN s > 0 THEN bin END) OVER k AS hi, min(CASE WHEN s > 0 THEN bin END) OVER k AS lo FROM hs WINDOW k AS (PARTITION BY symbol, date, at_ts))
, re AS (SELECT symbol, date, at_ts, """ + ", ".join(f"arg_max(off, (round({c}, 6), -bin)) * 0.1 AS poc{n}, coalesce(sum({c}) FILTER (WHERE off > 0), 0) / nullif(sum({c}), 0) AS time_above{n}, coalesce(sum({c}) FILTER (WHERE off = 0), 0) / nullif(sum({c}), 0) AS dwell{n}" for n, c in (("", "s"), ("_faded", "w"))) + """,
  (coalesce(sum(s) FILTER (WHERE off = 0), 0) / nullif(sum(s), 0)) / nullif(coalesce(sum(v) FILTER (WHERE off = 0), 0) / nullif(sum(v), 0), 0) AS accept, coalesce(sum(s) FILTER (WHERE bin >= hi - 1), 0) / nullif(sum(s), 0) AS linger_high, coalesce(sum(s) FILTER (WHERE bin <= lo + 1), 0) / nullif(sum(s), 0) AS linger_low,
  coalesce(sum(v) FILTER (WHERE off > 0 AND off <= reach), 0) / nullif(max(typical), 0) AS volume_up, coalesce(sum(v) FILTER (WHERE off < 0 AND off >= -reach), 0) / nullif(max(typical), 0) AS volume_down FROM he GROUP BY ALL)"""  # fmt: skip


@query(SQL + " SELECT symbol, date, at_ts AS at, " + ", ".join(f"f32({c}) AS {c}" for c in _OUT) + " FROM re")
def o144_profiles(spark, d):
    s = regular(spark, d)
    days = s.groupBy("symbol", "date").agg(F.max("cum_rv").alias("rv"), F.max("cum_v").alias("v"), F.max("prev_close").alias("ref"))
    scale = days.join(days.groupBy("symbol").agg(F.sqrt(F.avg("rv")).alias("sigma"), F.avg("v").alias("typical")), "symbol").drop("rv", "v")
    at = sp.held_prices(points(spark, d), s).select("symbol", "date", "at", "price").join(scale, ["symbol", "date"])
    c = profiles.cells(s, scale.drop("typical"), OPENS, STEP, WIDTH, HALF_LIFE)
    return rounded(profiles.profiles(at, c, WIDTH, HALF_LIFE, NEAR, MOVE))
