"""Queries of universes, rules, scores and group moves."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.operators import daily, screening
from marketloom.plans.base import BARS, bars, query, read, releases, rounded, sectors

DAYS = BARS + """ , dv AS (SELECT symbol, date, day_idx, close AS price, vwap * volume AS dollars, (high - low) / open AS range, vwap / lag(vwap) OVER (PARTITION BY symbol ORDER BY day_idx) - 1 AS ret, trades > 1 AS earn_near FROM bars)
 , days AS (SELECT *, CASE WHEN count(ret) OVER w >= 10 THEN stddev_samp(ret) OVER w END AS sigma FROM dv WINDOW w AS (PARTITION BY symbol ORDER BY day_idx ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))"""


def days(spark, d):
    w = Window.partitionBy("symbol").orderBy("day_idx")
    b = bars(spark, d).select("symbol", "date", "day_idx", F.col("close").alias("price"), (F.col("vwap") * F.col("volume")).alias("dollars"), ((F.col("high") - F.col("low")) / F.col("open")).alias("range"), (F.col("vwap") / F.lag("vwap").over(w) - 1).alias("ret"), (F.col("trades") > 1).alias("earn_near"))
    p = w.rowsBetween(-20, -1)
    return b.withColumn("sigma", F.when(F.count("ret").over(p) >= 10, F.stddev_samp("ret").over(p)))


@query(DAYS + " SELECT date, symbol, f32(dollars) AS dollars, place FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY dollars DESC, symbol)::INT AS place FROM days WHERE sigma > 0.003 AND dollars >= 20000 AND price >= 900) WHERE place <= 5")
def o20g_eligibility(spark, d):
    return rounded(screening.eligible(days(spark, d), 5, 0.003, 20000.0, 900.0).select("date", "symbol", "dollars", "place"))


@query(DAYS + """ , p AS (SELECT *, coalesce(price >= 1000, false) AND coalesce(sigma >= 0, true) AND coalesce(dollars >= 15000, false) AND NOT earn_near AS rule_pass FROM days)
 SELECT date, symbol, rule_pass, CASE WHEN rule_pass THEN row_number() OVER (PARTITION BY date, rule_pass ORDER BY dollars DESC, symbol)::INT END AS place FROM p""")
def o20h_o120_rules(spark, d):
    rows = days(spark, d).withColumn("rule_pass", screening.rule_pass(screening.Rules(least_price=1000.0, least_dollars=15000.0, earnings="exclude")))
    return screening.rank_passing(rows, "date", "dollars", "symbol").select("date", "symbol", "rule_pass", "place")


@query(DAYS + """ , r AS (SELECT *, round(sigma, 9) AS s9 FROM days), k AS (SELECT date, symbol, price, ((rank() OVER (PARTITION BY date ORDER BY price) + (count(*) OVER (PARTITION BY date, price) - 1) / 2.0)::DOUBLE / count(price) OVER (PARTITION BY date)) AS a,
 CASE WHEN s9 IS NOT NULL THEN (rank() OVER (PARTITION BY date ORDER BY s9 NULLS FIRST) + (count(s9) OVER (PARTITION BY date, s9) - 1) / 2.0)::DOUBLE / count(s9) OVER (PARTITION BY date) END AS b FROM r)
 SELECT date, symbol, f32((a * 0.7 + coalesce(b, 0) * 0.3) / (0.7 + CASE WHEN b IS NULL THEN 0 ELSE 0.3 END)) AS score FROM k""")
def o70_weighted_score(spark, d):
    rows = days(spark, d).withColumn("sigma", F.round("sigma", 9)).select("date", "symbol", "price", "sigma")
    return rounded(screening.weighted_score(rows, ["date"], {"price": 0.7, "sigma": 0.3}).select("date", "symbol", "score"))


@query(DAYS + """ , s AS (SELECT date, symbol, concat_ws('+', CASE WHEN row_number() OVER (PARTITION BY date ORDER BY dollars DESC, symbol) <= 3 THEN 'top' END, CASE WHEN price >= 2000 THEN 'price' END, CASE WHEN dollars >= 80000 THEN 'dollars' END) AS why FROM days) SELECT * FROM s WHERE why <> ''""")
def o82_shortlist(spark, d):
    return screening.shortlist(days(spark, d), "date", "dollars", "symbol", 3, {"price": 2000.0, "dollars": 80000.0}).select("date", "symbol", "why")


@query(DAYS + """ , x AS (SELECT symbol, day_idx, least(0.5, greatest(-0.5, ret)) AS ret FROM (SELECT *, lag(day_idx) OVER (PARTITION BY symbol ORDER BY day_idx) AS p FROM dv) WHERE p = day_idx - 1), z AS (SELECT symbol, day_idx, ret, CASE WHEN count(ret) OVER w >= 5 THEN stddev_samp(ret) OVER w END AS sd FROM x WINDOW w AS (PARTITION BY symbol ORDER BY day_idx RANGE BETWEEN 63 PRECEDING AND 1 PRECEDING))
 SELECT symbol, day_idx, f32(sign(ret) * least(4.0, greatest(0.0, abs(ret) / nullif(sd, 0) - 2))) AS excess FROM z WHERE sd IS NULL OR sd > 0""")
def o78_event_excess(spark, d):
    r = daily.session_returns(bars(spark, d))
    w = Window.partitionBy("symbol").orderBy("day_idx").rangeBetween(-63, -1)
    flat = r.withColumn("sd", F.when(F.count("ret").over(w) >= 5, F.stddev_samp("ret").over(w))).filter("sd = 0").select("symbol", "day_idx")
    out = screening.event_excess(r, 63, 5).join(flat, ["symbol", "day_idx"], "left_anti")
    # An unknown deviation bounds nothing: greatest and least skip NULL on both sides, so it counts as no excess.
    return rounded(out)


@query(DAYS + """ , pk AS (SELECT date, symbol FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY dollars DESC, symbol) AS k FROM days) WHERE k <= 5), u AS (SELECT date, median(range) AS usual FROM days GROUP BY date)
 SELECT date, count(*) AS n, f32(avg(range)) AS mean_range, f32(avg((range > usual)::INT)) AS hit_rate FROM pk JOIN days USING (date, symbol) JOIN u USING (date) GROUP BY date""")
def o119_outcomes(spark, d):
    from marketloom.operators.rolling import top_n

    picks = top_n(days(spark, d), ["date"], "dollars", "symbol", 5).select("date", "symbol")
    return rounded(screening.outcomes(bars(spark, d), picks))


@query(BARS + """ , li AS (SELECT symbol AS ticker, max(date) AS delisted, form AS listing_id FROM releases WHERE form < '4' GROUP BY ALL), en AS (SELECT ticker, delisted AS until, min(listing_id) AS listing_id FROM li GROUP BY ALL)
 SELECT b.symbol AS ticker, b.date, coalesce(e.listing_id, l.last_id, b.symbol::VARCHAR) AS listing_id FROM (SELECT symbol, date FROM bars) b ASOF LEFT JOIN en e ON b.symbol = e.ticker AND b.date <= e.until LEFT JOIN (SELECT ticker, arg_max(listing_id, until) AS last_id FROM en GROUP BY ticker) l ON l.ticker = b.symbol""")
def o35_identities(spark, d):
    li = releases(spark, d).filter("form < '4'").groupBy(F.col("symbol").alias("ticker"), F.col("form").alias("listing_id")).agg(F.max("date").alias("delisted"))
    return screening.identities(bars(spark, d).select(F.col("symbol").alias("ticker"), "date"), li)


@query()
def o51_capped_group_moves(spark, d):
    """Leave-one-out moves under capped weights; tested against bisection of the fixed point."""
    r = daily.session_returns(bars(spark, d)).join(sectors(spark, d).filter("weight > 0"), "symbol")
    return rounded(screening.capped_moves(r, ["date", "sector"], "symbol", "weight", "ret").select("date", "sector", "symbol", "others_move"))


@query(BARS + """ , e AS (SELECT DISTINCT symbol, day_idx FROM bars WHERE trades >= 2), a AS (SELECT b.symbol, b.day_idx, b.vwap, b.volume, b.day_idx - p.day_idx AS since, n.day_idx - b.day_idx AS nx FROM (SELECT symbol, day_idx, vwap, volume FROM bars) b
 ASOF LEFT JOIN e p ON b.symbol = p.symbol AND b.day_idx >= p.day_idx ASOF LEFT JOIN e n ON b.symbol = n.symbol AND b.day_idx < n.day_idx)
 SELECT symbol, day_idx, least(coalesce(since, 99), 99)::INT AS since, least(coalesce(nx, 99), 99)::INT AS "to", f32(1 / quantile_cont(vwap, 0.5) OVER (PARTITION BY symbol)) AS loss_weight, f32(ln(1 + volume)) AS log_volume, (since = 0)::INT IS NOT DISTINCT FROM 1 AS is_day FROM a""")
def o116_prepared_panel(spark, d):
    b = bars(spark, d)
    e = daily.earnings_counters(b.select("symbol", "day_idx", "vwap", "volume"), b.filter("trades >= 2").select("symbol", "day_idx"))
    return rounded(screening.prepared(e).select("symbol", "day_idx", "since", "to", "loss_weight", "log_volume", (F.coalesce("is_day", F.lit(0)) == 1).alias("is_day")))


@query(DAYS + " SELECT b.symbol, b.day_idx, f32(b.vwap) AS vwap, f32(p.dollars) AS dollars, f32(p.sigma) AS sigma FROM bars b JOIN days p ON p.symbol = b.symbol AND p.day_idx = b.day_idx - 1")
def o36_shift_join(spark, d):
    return rounded(screening.shifted(days(spark, d), bars(spark, d).select("symbol", "day_idx", "vwap"), ["dollars", "sigma"]))


@query("SELECT o_orderkey, list_contains(string_split(o_orderpriority, '-'), '1') AS has_item FROM orders")
def o104_item_lists(spark, d):
    return read(spark, d, "orders").select("o_orderkey", F.array_contains(F.split("o_orderpriority", "-"), "1").alias("has_item"))
