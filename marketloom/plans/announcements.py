"""Announcements from orders as filings: suppliers in credit file themselves, the others are known from a vendor's list."""

from pyspark.sql import functions as F

from marketloom.operators import announcements as ann
from marketloom.plans.base import BARS, query, read, releases, sessions

FILINGS = BARS + """, ff AS (SELECT r.symbol, substr(r.form, 1, 1) AS p, r.order_key, r.date, s.weight, (r.date::TIMESTAMP + to_hours((r.order_key % 24)::INT)) AS at_ts FROM releases r JOIN sectors s USING (symbol))
, filings AS (SELECT symbol, CASE p WHEN '1' THEN '8-K' WHEN '2' THEN '10-K' WHEN '3' THEN '10-Q' ELSE 'other' END AS form, order_key::VARCHAR AS accession, CASE WHEN order_key % 5 <> 0 THEN at_ts END AS accepted_at, date AS filing_date, p = '1' AS is_release FROM ff WHERE weight > 0)
, vendor AS (SELECT symbol, CASE p WHEN '4' THEN '10-K' WHEN '5' THEN '10-Q' ELSE 'other' END AS form, date AS filing_date FROM ff)
, ed AS (SELECT *, CASE WHEN is_release AND accepted_at IS NOT NULL THEN accepted_at::DATE + (accepted_at::TIME >= TIME '16:00')::INT ELSE filing_date END AS react FROM filings WHERE is_release OR form IN ('10-K', '10-Q'))
, kn AS (SELECT * FROM ed WHERE react >= (SELECT min(date) FROM sessions)), pl AS (SELECT k.*, s.day_idx FROM kn k ASOF LEFT JOIN sessions s ON k.react <= s.date)
, rp AS (SELECT DISTINCT symbol, day_idx AS report_day FROM pl WHERE NOT is_release AND day_idx IS NOT NULL)
, rl AS (SELECT p.*, r.report_day FROM (SELECT * FROM pl WHERE is_release AND day_idx IS NOT NULL) p ASOF LEFT JOIN rp r ON p.symbol = r.symbol AND p.day_idx - 1 <= r.report_day)
, gr AS (SELECT *, CASE WHEN report_day <= day_idx + 50 THEN report_day WHEN report_day IS NOT NULL THEN -day_idx END AS grp FROM rl)
, ev AS (SELECT symbol, day_idx, 'release' AS source, day_idx = max(day_idx) OVER (PARTITION BY symbol, grp) AS scheduled, accepted_at, accession, 0 AS pri FROM gr
  UNION ALL SELECT symbol, day_idx, form, true, NULL, accession, 1 FROM pl WHERE NOT is_release AND day_idx IS NOT NULL AND NOT EXISTS (SELECT 1 FROM gr WHERE gr.symbol = pl.symbol AND gr.grp = pl.day_idx)
  UNION ALL SELECT v.symbol, s.day_idx, 'vendor ' || form, true, NULL, NULL, 2 FROM (SELECT DISTINCT * FROM vendor WHERE form IN ('10-K', '10-Q') AND filing_date >= (SELECT min(date) FROM sessions) AND symbol NOT IN (SELECT symbol FROM kn)) v ASOF JOIN sessions s ON v.filing_date <= s.date)
, pick AS (SELECT ev.*, c.date FROM ev JOIN sessions c USING (day_idx) QUALIFY row_number() OVER (PARTITION BY ev.symbol, ev.day_idx ORDER BY pri, scheduled DESC, accepted_at DESC NULLS LAST, source, accession DESC NULLS LAST) = 1)"""


def filings(spark, d):
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("symbol"), F.col("s_acctbal").alias("weight"))
    r = releases(spark, d).join(s, "symbol").withColumn("p", F.substring("form", 1, 1))
    at = F.timestamp_add("HOUR", (F.col("order_key") % 24).cast("int"), F.col("date").cast("timestamp"))
    form = F.when(F.col("p") == "1", "8-K").when(F.col("p") == "2", "10-K").when(F.col("p") == "3", "10-Q").otherwise("other")
    own = r.filter("weight > 0").select("symbol", form.alias("form"), F.col("order_key").cast("string").alias("accession"), F.when(F.col("order_key") % 5 != 0, at).alias("accepted_at"), F.col("date").alias("filing_date"), (F.col("p") == "1").alias("is_release"))
    listed = F.when(F.col("p") == "4", "10-K").when(F.col("p") == "5", "10-Q").otherwise("other")
    return own, r.select("symbol", listed.alias("form"), F.col("date").alias("filing_date"))


@query(FILINGS + """ SELECT symbol, day_idx, date, source, scheduled, accepted_at, CASE WHEN accepted_at IS NULL THEN NULL WHEN date > accepted_at::DATE THEN 'after_close' WHEN accepted_at::TIME < TIME '09:30' THEN 'before_open' WHEN accepted_at::TIME < TIME '16:00' THEN 'market_hours' ELSE 'after_close' END AS timing, accession FROM pick""")
def o110_three_sources(spark, d):
    return ann.announcements(*filings(spark, d), sessions(spark, d).select("date", "day_idx"))
