"""Queries of outages and of two feeds: polls of all users against those of users whose number isn't divisible by 11."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.operators import intervals
from marketloom.plans.base import query, rounded
from marketloom.plans.intraday import POLLS, polls

_GAPS = """, fa AS (SELECT symbol, date, ts, sum(price * volume) OVER w AS cum_pv, sum(volume) OVER w AS cum_v FROM (SELECT symbol, date, ts, sum(price * volume) / sum(volume) AS price, sum(volume) AS volume FROM polls GROUP BY ALL) WINDOW w AS (PARTITION BY symbol, date ORDER BY ts))
, fb AS (SELECT symbol, date, ts, sum(price * volume) OVER w AS cum_pv, sum(volume) OVER w AS cum_v FROM (SELECT symbol, date, ts, sum(price * volume) / sum(volume) AS price, sum(volume) AS volume FROM polls WHERE user_id % 11 <> 0 GROUP BY ALL) WINDOW w AS (PARTITION BY symbol, date ORDER BY ts))
, ga AS (SELECT symbol, date, p AS s, ts AS e FROM (SELECT *, lag(ts) OVER (PARTITION BY symbol, date ORDER BY ts) AS p FROM fa UNION ALL SELECT *, lag(ts) OVER (PARTITION BY symbol, date ORDER BY ts) FROM fb) WHERE p IS NOT NULL AND ts - p > INTERVAL 75 MINUTES)"""


def _running(df):
    one = df.groupBy("symbol", "date", "ts").agg((F.sum(F.col("price") * F.col("volume")) / F.sum("volume")).alias("price"), F.sum("volume").alias("volume"))
    w = Window.partitionBy("symbol", "date").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return one.select("symbol", "date", "ts", F.sum(F.col("price") * F.col("volume")).over(w).alias("cum_pv"), F.sum("volume").over(w).alias("cum_v"))


def feeds(spark, d):
    p = polls(spark, d)
    a, b = _running(p), _running(p.filter("user_id % 11 <> 0"))
    return a, b, intervals.gaps(a, ["symbol", "date"], "ts", 4500).union(intervals.gaps(b, ["symbol", "date"], "ts", 4500))


# An outage stays separate only if no other covers its start from before; its end is that of the last one in its chain.
@query(POLLS + _GAPS + """, st AS (SELECT DISTINCT symbol, date, s FROM ga a WHERE NOT EXISTS (SELECT 1 FROM ga b WHERE b.symbol = a.symbol AND b.date = a.date AND b.s < a.s AND b.e >= a.s))
 SELECT st.symbol, st.date, st.s AS "start", max(g.e) AS "end" FROM st JOIN ga g ON g.symbol = st.symbol AND g.date = st.date AND g.s >= st.s AND g.s < coalesce((SELECT min(n.s) FROM st n WHERE n.symbol = st.symbol AND n.date = st.date AND n.s > st.s), TIMESTAMP '2100-01-01') GROUP BY ALL""")
def o76_o132_outages(spark, d):
    """Gaps of either feed of more than 75 minutes, merged."""
    return intervals.union(feeds(spark, d)[2], ["symbol", "date"], "start", "end")


@query(POLLS + _GAPS + """, pt AS (SELECT DISTINCT symbol, date, unnest([date + INTERVAL 10 HOURS, date + INTERVAL 13 HOURS, date + INTERVAL 16 HOURS]) AS at_ts FROM polls)
, wi AS (SELECT symbol, date, at_ts, k.kind, CASE WHEN k.m IS NULL THEN date::TIMESTAMP ELSE greatest(date::TIMESTAMP, at_ts - to_minutes(k.m::INT)) END AS since FROM pt, (VALUES ('session', NULL), ('trailing_60', 60), ('trailing_240', 240)) k(kind, m))
, cl AS (SELECT * FROM wi WHERE NOT EXISTS (SELECT 1 FROM ga WHERE ga.symbol = wi.symbol AND ga.date = wi.date AND ga.s < wi.at_ts AND ga.e > wi.since))
, sm AS (SELECT cl.*, coalesce(ea.cum_pv - coalesce(sa.cum_pv, 0), NULL) / nullif(ea.cum_v - coalesce(sa.cum_v, 0), 0) AS va, (eb.cum_pv - coalesce(sb.cum_pv, 0)) / nullif(eb.cum_v - coalesce(sb.cum_v, 0), 0) AS vb FROM cl
 ASOF LEFT JOIN fa ea ON ea.symbol = cl.symbol AND ea.date = cl.date AND cl.at_ts >= ea.ts ASOF LEFT JOIN fa sa ON sa.symbol = cl.symbol AND sa.date = cl.date AND cl.since >= sa.ts
 ASOF LEFT JOIN fb eb ON eb.symbol = cl.symbol AND eb.date = cl.date AND cl.at_ts >= eb.ts ASOF LEFT JOIN fb sb ON sb.symbol = cl.symbol AND sb.date = cl.date AND cl.since >= sb.ts)
 SELECT symbol, date, at_ts AS "at", kind, f32(va) AS vwap_a, f32(vb) AS vwap_b, f32(round(10000 * (va / nullif(vb, 0) - 1), 6)) AS bp FROM sm""")
def o136b_feed_checkpoints(spark, d):
    """VWAPs of both feeds since the day's start and over the last 60 and 240 minutes, where neither had an outage."""
    a, b, outages = feeds(spark, d)
    hours = F.explode(F.array(*[F.timestamp_add("HOUR", F.lit(h), F.col("date").cast("timestamp")) for h in (10, 13, 16)]))
    points = a.select("symbol", "date").distinct().select("symbol", "date", hours.alias("at"))
    out = intervals.checkpoints(a, b, outages, points, {"session": None, "trailing_60": 60, "trailing_240": 240})
    return rounded(out.withColumn("bp", F.round("bp", 6)))
