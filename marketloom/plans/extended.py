"""Queries over parts of a session; events stand for prints with times in UTC."""

from pyspark.sql import functions as F

from marketloom.operators import daily, extended
from marketloom.plans.base import BARS, bars, query, read, rounded
from marketloom.plans.daily import _SPLITS, _splits
from marketloom.plans.intraday import POLLS, dense, polls

CUTS = [480, 540, 565, 570, 585]
PRINTS = r"""
WITH pr AS (SELECT event_type AS symbol, ts::DATE AS date, (hour(ts) * 60 + minute(ts))::INT AS minute, value AS price, regexp_extract(props, '(\d+)', 1)::DOUBLE + 1 AS volume, event_id AS seq FROM events
), hd AS (SELECT DISTINCT date FROM pr WHERE day(date) IN (3, 24)
), mk AS (SELECT pr.*, hd.date IS NOT NULL AS half, CASE WHEN minute < 570 THEN 'pre' WHEN minute < CASE WHEN hd.date IS NOT NULL THEN 780 ELSE 960 END THEN 'regular' ELSE 'after' END AS part FROM pr LEFT JOIN hd USING (date)
), parts AS (SELECT symbol, date, """ + ", ".join(
    f"arg_min(price, (minute, seq)) FILTER (WHERE part = '{p}') AS {p}_first, arg_max(price, (minute, seq)) FILTER (WHERE part = '{p}') AS {p}_last, max(price) FILTER (WHERE part = '{p}') AS {p}_high, min(price) FILTER (WHERE part = '{p}') AS {p}_low, sum(volume) FILTER (WHERE part = '{p}') AS {p}_volume, sum(price * volume) FILTER (WHERE part = '{p}') / sum(volume) FILTER (WHERE part = '{p}') AS {p}_vwap"
    for p in ("pre", "regular", "after")
) + ", " + ", ".join(f"arg_max(price, (minute, seq)) FILTER (WHERE minute < {c}) AS last_before_{c}" for c in CUTS) + ", max(half) AS half_day FROM mk GROUP BY symbol, date)"


def parts(spark, d):
    e = read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    prints = e.select(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"), (F.hour("ts") * 60 + F.minute("ts")).alias("minute"), F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("volume"), F.col("event_id").alias("seq"))
    return extended.session_parts(prints, CUTS, prints.select("date").filter(F.dayofmonth("date").isin(3, 24)))


_NAMES = [f"{p}_{x}" for p in ("pre", "regular", "after") for x in ("first", "last", "high", "low", "volume", "vwap")] + [f"last_before_{c}" for c in CUTS]


@query(PRINTS + f" SELECT symbol, date, {', '.join(f'f32({n}) AS {n}' for n in _NAMES)}, half_day FROM parts")
def o39_session_parts(spark, d):
    return rounded(parts(spark, d))


_DAYS = """, dy AS (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) AS day_idx, regular_last AS close, pre_last, after_last, CASE WHEN month(date) % 2 = 0 THEN 0.5 END AS split_factor, CASE WHEN month(date) % 3 = 0 THEN 0.5 END AS ext_split_factor FROM parts)"""


@query(PRINTS + _DAYS + """ SELECT symbol, date, f32(pre_last * coalesce(ext_split_factor, 1) / nullif(lag(close * coalesce(split_factor, 1)) OVER (PARTITION BY symbol ORDER BY day_idx), 0) - 1) AS pre_market_change,
 f32(after_last * coalesce(ext_split_factor, 1) / nullif(close * coalesce(split_factor, 1), 0) - 1) AS after_hours_change FROM dy""")
def o64_extended_changes(spark, d):
    from pyspark.sql.window import Window

    own = lambda n: F.when(F.month("date") % n == 0, 0.5)
    days = parts(spark, d).select("symbol", "date", F.row_number().over(Window.partitionBy("symbol").orderBy("date")).alias("day_idx"), F.col("regular_last").alias("close"), "pre_last", "after_last", own(2).alias("split_factor"), own(3).alias("ext_split_factor"))
    return rounded(extended.extended_changes(days).select("symbol", "date", "pre_market_change", "after_hours_change"))


@query(BARS + _SPLITS + """ , fb AS (SELECT b.*, b.date + (b.symbol % 40)::INT AS fetched, DATE '1998-01-01' AS today FROM bars b), p AS (SELECT b.symbol, b.date, b.close, coalesce(exp(sum(ln(s.factor))), 1.0) AS split_factor
 FROM fb b LEFT JOIN splits s ON b.symbol = s.symbol AND s.split_date > b.date AND s.split_date > b.fetched AND s.split_date <= b.today GROUP BY ALL) SELECT symbol, date, f32(split_factor) AS split_factor, f32(close * split_factor) AS adj_close FROM p""")
def o29_split_adjusted_by_fetch(spark, d):
    rows = bars(spark, d).select("symbol", "date", "close", F.date_add("date", (F.col("symbol") % 40).cast("int")).alias("fetched"))
    return rounded(daily.split_adjusted_by_fetch(rows, _splits(spark, d), F.lit("1998-01-01").cast("date")).select("symbol", "date", "split_factor", "adj_close"))


@query(BARS + _SPLITS + """ , p AS (SELECT b.symbol, b.date, b.day_idx, b.close, b.vwap, b.volume, coalesce(exp(sum(ln(s.factor))), 1.0) AS sf FROM bars b LEFT JOIN splits s ON b.symbol = s.symbol AND s.split_date > b.date GROUP BY ALL)
 SELECT symbol, date, f32(lag(close) OVER o) AS close_1, f32(lag(close, 2) OVER o) AS close_2, f32(ln(lag(vwap) OVER o / lag(vwap, 2) OVER o)) AS vwap_move_1,
 f32(CASE WHEN count(volume) OVER w >= 5 AND round(min(sf) OVER w, 12) = round(max(sf) OVER w, 12) THEN avg(volume) OVER w END) AS volume_mean FROM p WINDOW o AS (PARTITION BY symbol ORDER BY day_idx), w AS (PARTITION BY symbol ORDER BY day_idx ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""")
def o133_daily_context(spark, d):
    days = daily.split_adjusted(bars(spark, d).select("symbol", "date", "day_idx", "close", "vwap", "volume"), _splits(spark, d)).withColumn("split_factor", F.round("split_factor", 12))
    return rounded(extended.daily_context(days).select("symbol", "date", "close_1", "close_2", "vwap_move_1", "volume_mean"))


@query(PRINTS + """ , held AS (SELECT symbol || date AS symbol, pre_last AS last, CASE WHEN day(date) % 2 = 0 THEN regular_first END AS open FROM parts), opens AS (SELECT symbol || date AS symbol, regular_first AS open FROM parts)
 SELECT symbol, f32(h.last) AS last, f32(coalesce(h.open, o.open)) AS open FROM held h JOIN opens o USING (symbol)""")
def o126_merged_morning(spark, d):
    p = parts(spark, d).withColumn("symbol", F.concat("symbol", F.col("date").cast("string")))
    held = p.select("symbol", F.col("pre_last").alias("last"), F.when(F.dayofmonth("date") % 2 == 0, F.col("regular_first")).alias("open"))
    return rounded(extended.merge_morning(held, p.select("symbol", F.col("regular_first").alias("open")), p.select("symbol", F.col("pre_last").alias("last")), True))


@query("""WITH a AS (SELECT user_id, ts, event_id, 0 AS source_rank FROM events WHERE event_type IN ('click', 'view')), b AS (SELECT user_id, ts, event_id, 1 AS source_rank FROM events)
 SELECT user_id, ts, event_id, source_rank FROM (SELECT * FROM a UNION ALL SELECT * FROM b) QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY source_rank, event_id) = 1""")
def o03_union_feeds(spark, d):
    e = read(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    return extended.union_feeds([e.filter(F.col("event_type").isin("click", "view")).drop("event_type"), e.drop("event_type")], ["user_id", "ts"], ["event_id"])


@query(POLLS + """, b AS (SELECT symbol, minute AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS ny, open, close, CASE WHEN volume > 40 THEN vwap END AS vwap, volume FROM mins), r AS (SELECT *, ny::DATE AS d, (hour(ny) * 60 + minute(ny))::INT AS m FROM b WHERE hour(ny) * 60 + minute(ny) >= 570 AND hour(ny) * 60 + minute(ny) < 960)
 SELECT symbol, d AS date, m AS minute, f32(open) AS open, f32(close) AS close, f32(coalesce(vwap, close)) AS vwap, volume, f32(first_value(open) OVER (PARTITION BY symbol, d ORDER BY m)) AS first_open FROM r""")
def o04_regular_minutes(spark, d):
    from marketloom.operators import intraday

    b = intraday.minute_bars(polls(spark, d), 30).withColumns({"ts": F.col("minute"), "vwap": F.when(F.col("volume") > 40, F.col("vwap"))})
    return rounded(extended.regular_minutes(b.select("symbol", "ts", "open", "close", "vwap", "volume")))


@query(POLLS + """, dc AS (SELECT symbol, date, minute AS at_ts, close AS price, 0.5 AS sigma FROM dense WHERE hour(minute) IN (12, 18) AND minute(minute) = 0)
 , j AS (SELECT d.symbol, d.date, d.at_ts, m.volume AS v, ln(m.vwap / d.price) / d.sigma AS y, m.volume * pow(0.5, date_diff('minute', m.minute, d.at_ts) / 120.0) AS w FROM dc d JOIN dense m ON m.symbol = d.symbol AND m.date = d.date AND m.minute < d.at_ts WHERE m.volume > 0)
 , c AS (SELECT symbol, date, at_ts, greatest(-12, least(12, floor(y / 0.25 + 0.5)))::INT AS bin, sum(v) AS v, sum(CASE WHEN y > 0 THEN v ELSE 0 END) AS up, sum(w) AS w, sum(CASE WHEN y > 0 THEN w ELSE 0 END) AS w_up FROM j WHERE y IS NOT NULL GROUP BY ALL)
 , r AS (SELECT *, sum(v) OVER (PARTITION BY symbol, date, at_ts ORDER BY bin) / sum(v) OVER (PARTITION BY symbol, date, at_ts) AS share FROM c)
 SELECT symbol, date, at_ts AS at, f32(sum(up) / sum(v)) AS above, f32(sum(w_up) / sum(w)) AS above_recent, arg_max(bin, (v, -bin)) * 0.25::DOUBLE AS control, min(bin) FILTER (WHERE share >= 0.15) * 0.25::DOUBLE AS low, min(bin) FILTER (WHERE share >= 0.85) * 0.25::DOUBLE AS high FROM r GROUP BY symbol, date, at_ts""")
def o159_volume_at_price(spark, d):
    m = dense(spark, d)
    decisions = m.filter(F.hour("minute").isin(12, 18) & (F.minute("minute") == 0)).select("symbol", "date", F.col("minute").alias("at"), F.col("close").alias("price"), F.lit(0.5).alias("sigma"))
    return rounded(extended.volume_at_price(m, decisions, half_life=120.0))
