"""Queries of said moves: at each step of the session, will the price move by a tenth within two hours? Said is the share of the same minute's last days."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.operators import intraday, move_tables, paths
from marketloom.plans.base import query, rounded
from marketloom.plans.intraday import POLLS, dense
from marketloom.staging import written

SPAN, MOVE, DAYS, LEAST, FLAG = 120, 1.1, 20, 5, 0.5

MOVES = POLLS + """, dc AS (SELECT symbol, date, minute AS at_ts, close AS entry FROM dense WHERE hour(minute) BETWEEN 9 AND 15 AND close > 0)
, pk AS (SELECT d.symbol, d.date, d.at_ts, d.entry, sum(m.volume) AS tot, sum(m.volume) FILTER (WHERE m.vwap > d.entry) AS mu, sum(m.volume) FILTER (WHERE m.vwap < d.entry) AS md, sum(ln(m.vwap / d.entry) * m.volume) FILTER (WHERE m.vwap > d.entry) AS u, sum(-ln(m.vwap / d.entry) * m.volume) FILTER (WHERE m.vwap < d.entry) AS w, max(m.high) AS hi, min(m.low) AS lo
  FROM dc d LEFT JOIN dense m ON d.symbol = m.symbol AND d.date = m.date AND m.minute > d.at_ts AND m.minute <= d.at_ts + INTERVAL 120 MINUTES GROUP BY ALL)
, ce AS (SELECT *, CASE WHEN mu / nullif(tot, 0) >= 0.05 THEN u / mu END AS cu, CASE WHEN md / nullif(tot, 0) >= 0.05 THEN w / md END AS cd, CASE WHEN tot > 0 THEN (coalesce(u, 0) - coalesce(w, 0)) / tot END AS net, hour(at_ts) * 60 + minute(at_ts) AS minute FROM pk)
, ou AS (SELECT *, CASE WHEN tot > 0 THEN coalesce(cu >= ln(1.1), false)::INT END AS reached_up, CASE WHEN tot > 0 THEN coalesce(cd >= ln(1.1), false)::INT END AS reached_dn, (hi >= entry * 1.1)::INT AS touched_up, (lo <= entry / 1.1)::INT AS touched_dn FROM ce)
, sp AS (SELECT *, CASE WHEN count(touched_up) OVER b >= 5 THEN avg(touched_up) OVER b END AS p_up, CASE WHEN count(touched_dn) OVER b >= 5 THEN avg(touched_dn) OVER b END AS p_dn FROM ou WINDOW b AS (PARTITION BY symbol, minute ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
, bo AS (SELECT symbol, date, minute, 'up' AS side, p_up AS p, reached_up AS reached, touched_up AS touched, CASE WHEN tot > 0 THEN (cu IS NOT NULL)::INT END AS formed, cu AS centre, ln(hi / entry) AS best, ln(hi / entry) / ln(1.1) AS best_x, net AS vwap_move, p_up, p_dn, reached_up, reached_dn FROM sp WHERE p_up IS NOT NULL AND p_dn IS NOT NULL
  UNION ALL SELECT symbol, date, minute, 'down', p_dn, reached_dn, touched_dn, CASE WHEN tot > 0 THEN (cd IS NOT NULL)::INT END, -cd, ln(nullif(lo, 0) / entry), -ln(nullif(lo, 0) / entry) / ln(1.1), net, p_up, p_dn, reached_up, reached_dn FROM sp WHERE p_up IS NOT NULL AND p_dn IS NOT NULL)
, sc AS (SELECT date, side, count(*) AS decisions FROM bo GROUP BY ALL), mt AS (SELECT * FROM bo WHERE p >= 0.5)"""
_RATES = "count(*) AS predictions, avg(p) AS said, avg(reached) AS reached, avg(touched) AS touched, avg(best_x) FILTER (WHERE touched = 1) AS mean_over"
_STATES = "count(*) FILTER (WHERE reached = 1) AS happened, count(*) FILTER (WHERE coalesce(reached, 0) <> 1 AND touched = 1) AS touched_only, count(*) FILTER (WHERE reached = 0 AND coalesce(touched, 0) <> 1) AS did_not"


def said(spark, d):
    """One row for each decision and side, with what was said and what happened. A price of 0 counts as touched and has no log move; at one, nothing is decided."""
    minutes = dense(spark, d)
    at = minutes.filter(F.hour("minute").between(9, 15) & (F.col("close") > 0)).select("symbol", "date", F.col("minute").alias("at"), F.col("close").alias("entry"), F.lit(1.0).alias("sigma"))
    pocket = paths.bin_targets(minutes.withColumn("normal", F.lit(None).cast("double")), at, [(0, SPAN)], 1440).select("symbol", "date", "at", "volume", "cm_up", "cm_dn", "net")
    r = at.join(pocket, ["symbol", "date", "at"]).join(intraday.excursions(minutes, at, SPAN).select("symbol", "date", "at", "high", "low"), ["symbol", "date", "at"], "left")
    goal, traded = F.ln(F.lit(MOVE)), F.col("volume") > 0
    r = r.withColumns({"minute": F.hour("at") * 60 + F.minute("at"), "best_up": F.ln(F.col("high") / F.col("entry")), "best_dn": -F.ln(F.col("low") / F.col("entry"))})
    by = Window.partitionBy("symbol", "minute").orderBy("date").rowsBetween(-DAYS, -1)
    for s in ("up", "dn"):
        r = r.withColumns({f"reached_{s}": F.when(traded, F.coalesce(F.col(f"cm_{s}") >= goal, F.lit(False)).cast("int")), f"touched_{s}": (F.col("high") >= F.col("entry") * MOVE if s == "up" else F.col("low") <= F.col("entry") / MOVE).cast("int")})
    for s in ("up", "dn"):
        r = r.withColumn(f"p_{s}", F.when(F.count(f"touched_{s}").over(by) >= LEAST, F.avg(f"touched_{s}").over(by)))
    side = lambda name, s, sign: F.struct(
        F.lit(name).alias("side"), F.col(f"p_{s}").alias("p"), F.col(f"reached_{s}").alias("reached"), F.col(f"touched_{s}").alias("touched"), F.when(traded, F.col(f"cm_{s}").isNotNull().cast("int")).alias("formed"),
        (sign * F.col(f"cm_{s}")).alias("centre"), (sign * F.col(f"best_{s}")).alias("best"), (F.col(f"best_{s}") / goal).alias("best_x"))
    r = r.filter("p_up IS NOT NULL AND p_dn IS NOT NULL").withColumn("x", F.explode(F.array(side("up", "up", F.lit(1)), side("down", "dn", F.lit(-1)))))
    return r.select("symbol", "date", "minute", "x.*", F.col("net").alias("vwap_move"), "p_up", "p_dn", "reached_up", "reached_dn", "touched_up", "touched_dn")


def flagged(spark, d):
    """The rows whose chance is high enough, and the scored decisions. Tables read them several times, so they are written once."""
    rows = written(said(spark, d), "said")
    return rows.filter(F.col("p") >= FLAG), rows.groupBy("date", "side").agg(F.count("*").alias("decisions"))


@query(MOVES + f""", b2 AS (SELECT * EXCLUDE (side), unnest([side, 'both']) AS side FROM mt), s2 AS (SELECT side, sum(decisions)::BIGINT AS decisions FROM (SELECT decisions, unnest([side, 'both']) AS side FROM sc) GROUP BY side)
, ag AS (SELECT side, {_RATES}, count(DISTINCT symbol) AS stocks, count(DISTINCT date) AS days, 1 - avg(formed) AS not_formed, median(abs(centre)) AS median_centre, median(abs(best)) AS median_best, median(vwap_move) AS median_vwap_move, median(best_x) FILTER (WHERE touched = 1) AS median_best_x FROM b2 GROUP BY side)
, dy AS (SELECT side, row_number() OVER (PARTITION BY side ORDER BY date) - 1 AS slot, count(*) OVER (PARTITION BY side) AS n, a, b FROM (SELECT side, date, sum(1 - (reached - p)) AS a, count(*) AS b FROM b2 WHERE reached IS NOT NULL GROUP BY ALL))
, dr AS (SELECT side, rep, (rep * 73856093 + slot * 19349663 + rep * slot * 83492791) % n AS slot FROM dy, (SELECT unnest(range(0, 200)) AS rep))
, rp AS (SELECT side, rep, 1 - sum(a) / sum(b) AS g FROM dr JOIN dy USING (side, slot) GROUP BY ALL)
, gp AS (SELECT side, quantile_cont(g, 0.025) AS gap_low, quantile_cont(g, 0.975) AS gap_high FROM rp GROUP BY side), pt AS (SELECT side, 1 - sum(a) / sum(b) AS gap FROM dy GROUP BY side)
 SELECT s2.side, s2.decisions, coalesce(predictions, 0) AS predictions, coalesce(stocks, 0) AS stocks, coalesce(days, 0) AS days, """ + ", ".join(f"f32({c}) AS {c}" for c in "said reached touched mean_over not_formed median_centre median_best median_vwap_move median_best_x gap gap_low gap_high".split()) + ", f32(coalesce(predictions, 0) / s2.decisions) AS share_flagged FROM s2 LEFT JOIN ag USING (side) LEFT JOIN gp USING (side) LEFT JOIN pt USING (side)")
def o206_moves_by_period(spark, d):
    return rounded(move_tables.by_period(*flagged(spark, d)))


@query(MOVES + f""", ag AS (SELECT date, side, {_RATES}, {_STATES}, count(DISTINCT symbol) AS stocks, max(p) AS max_said, median(abs(best)) AS median_best, median(vwap_move) AS median_vwap_move FROM mt GROUP BY ALL)
 SELECT date, side, decisions, """ + ", ".join(f"coalesce({c}, 0) AS {c}" for c in "predictions happened touched_only did_not stocks".split()) + ", " + ", ".join(f"f32({c}) AS {c}" for c in "said reached touched mean_over max_said median_best median_vwap_move".split()) + " FROM sc LEFT JOIN ag USING (date, side)")
def o206_moves_by_day(spark, d):
    return rounded(move_tables.by_day(*flagged(spark, d)))


@query(MOVES + f""", ag AS (SELECT (minute // 60 * 60)::INT AS bucket, side, {_RATES}, {_STATES}, median(best_x) AS median_best_x FROM mt GROUP BY ALL)
 SELECT bucket, side, predictions, happened, touched_only, did_not, predictions - happened - touched_only - did_not AS unknown, """ + ", ".join(f"f32({c}) AS {c}" for c in "said reached touched mean_over median_best_x".split()) + " FROM ag")
def o206_moves_by_time(spark, d):
    return rounded(move_tables.by_time(flagged(spark, d)[0], 60))


@query(MOVES + """ SELECT CASE WHEN p_up >= p_dn THEN 'up' ELSE 'down' END AS lean, count(*) AS predictions, f32(avg(p_up)) AS mean_p_up, f32(avg(p_dn)) AS mean_p_dn, f32(avg((vwap_move > 0)::INT)) AS went_up,
 f32(avg(CASE WHEN p_up >= p_dn THEN reached_up ELSE reached_dn END)) AS lean_reached, f32(avg(CASE WHEN p_up >= p_dn THEN reached_dn ELSE reached_up END)) AS other_reached, f32(count(*) / (SELECT count(*) FROM mt)) AS share FROM mt GROUP BY 1""")
def o206_moves_by_lean(spark, d):
    return rounded(move_tables.by_lean(flagged(spark, d)[0]))


LEANS = MOVES + """, ld AS (SELECT *, round(p_up - p_dn, 9) AS lean FROM sp WHERE p_up IS NOT NULL AND p_dn IS NOT NULL), wild AS (SELECT date FROM ld GROUP BY date HAVING avg(touched_up) > 0.9)"""


def leans(spark, d):
    rows = written(said(spark, d).filter("side = 'up'"), "leans")  # a row for each decision
    return rows, rows.groupBy("date").agg(F.avg("touched_up").alias("m")).filter("m > 0.9")


@query(LEANS + """, al AS (SELECT 'all' AS days, * FROM ld UNION ALL SELECT 'rest', * FROM ld WHERE date NOT IN (SELECT date FROM wild)), rk AS (SELECT *, rank() OVER (PARTITION BY days ORDER BY lean) - 1 AS before, count(*) OVER (PARTITION BY days, lean) AS k, count(*) OVER (PARTITION BY days) AS total FROM al)
 SELECT days, floor((before + k / 2) * 10 / total)::INT AS decile, count(*) AS n, f32(avg(lean)) AS lean, f32(avg(CASE WHEN net <> 0 THEN (net > 0)::INT END)) AS went_up, f32(avg(touched_up)) AS touched_up, f32(avg(touched_dn)) AS touched_dn, f32(avg(net)) AS vwap_move FROM rk GROUP BY 1, 2""")
def o161b_lean_deciles(spark, d):
    return rounded(move_tables.by_lean_decile(*leans(spark, d)))


@query(LEANS + """, oc AS (SELECT 'went_up' AS outcome, lean, (net > 0)::INT AS y FROM ld WHERE net <> 0 UNION ALL SELECT 'only_up_touched', lean, touched_up FROM ld WHERE touched_up + touched_dn = 1), rk AS (SELECT outcome, y, rank() OVER (PARTITION BY outcome ORDER BY lean) + (count(*) OVER (PARTITION BY outcome, lean) - 1) / 2.0 AS r FROM oc)
 SELECT outcome, f32((sum(r * y) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * (count(*) - sum(y)), 0)) AS auc, count(*) AS n FROM rk GROUP BY outcome""")
def o161b_lean_skill(spark, d):
    return rounded(move_tables.lean_skill(leans(spark, d)[0]))
