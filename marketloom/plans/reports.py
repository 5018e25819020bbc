"""Queries of report tables."""

from pyspark.sql import functions as F

from marketloom.operators import daily, reports, scoring
from marketloom.plans.base import bars, query, rounded
from marketloom.plans.scoring import FORECASTS, cdf, forecasts, quantiles_of
from marketloom.staging import written

_MOVES = [-0.2, 0.05, 0.2]
_MV = f""" , mv AS (SELECT *, unnest([-0.2, 0.05, 0.2]) AS move FROM sc), pr AS (SELECT *, {cdf('move')} AS c FROM mv), mp AS (SELECT *, CASE WHEN move > 0 THEN 1 - c ELSE c END AS p, (CASE WHEN move > 0 THEN actual > move ELSE actual < move END)::INT AS hit FROM pr)
 , bk AS (SELECT *, CASE WHEN p < 0.25 - 1e-12 THEN 0 WHEN p < 0.5 - 1e-12 THEN 1 WHEN p < 0.75 - 1e-12 THEN 2 ELSE 3 END AS bucket FROM mp)"""


@query(FORECASTS + _MV + " , b AS (SELECT move, avg(hit) AS base FROM mp GROUP BY move) SELECT f32(move) AS move, f32(t) AS threshold, count(*) AS n, f32(avg(hit)) AS rate, f32(avg(hit) / nullif(max(base), 0)) AS lift FROM mp JOIN b USING (move), (SELECT unnest([0.2, 0.35, 0.45]) AS t) WHERE p >= t GROUP BY move, t")
def o194_threshold_curve(spark, d):
    return rounded(reports.threshold_curve(reports.move_probabilities(forecasts(spark, d), _MOVES), [0.2, 0.35, 0.45]).drop("base"))


@query(FORECASTS + _MV + """ , h AS (SELECT * FROM bk WHERE fold < 4), o AS (SELECT symbol, move, bucket, count(*) AS n_own, avg(hit) AS rate_own FROM h GROUP BY ALL), w AS (SELECT move, bucket, count(*) AS n_all, avg(hit) AS rate_all FROM h GROUP BY ALL)
 SELECT l.symbol, l.day_idx, f32(l.move) AS move, f32(l.p) AS p, l.bucket, n_own, f32(rate_own) AS rate_own, n_all, f32(rate_all) AS rate_all FROM bk l LEFT JOIN o ON o.symbol = l.symbol AND o.move = l.move AND o.bucket = l.bucket LEFT JOIN w ON w.move = l.move AND w.bucket = l.bucket WHERE l.fold >= 4""")
def o209_move_table(spark, d):
    rows = reports.move_probabilities(forecasts(spark, d), _MOVES)
    edges = [0.0, 0.25, 0.5, 0.75, 1.0]
    latest = rows.filter("fold >= 4").select("symbol", "day_idx", "move", "p")
    return rounded(reports.move_table(latest, rows.filter("fold < 4"), edges))


@query(FORECASTS + " , n AS (SELECT 'scaled' AS run, abs(actual) * 0.3 AS loss, in_50 AS in_90, direction FROM sc WHERE symbol % 2 = 0 UNION ALL SELECT 'base', loss, in_90, direction FROM sc WHERE symbol % 2 = 0), g AS (SELECT run, count(*) AS n, avg(loss) AS loss, avg(in_90) AS cover_90, avg(direction) AS direction FROM n GROUP BY run) SELECT run, n, f32(loss) AS loss, f32(cover_90) AS cover_90, f32(direction) AS direction, f32(loss / (SELECT loss FROM g WHERE run = 'base') - 1) AS change FROM g")
def o211b_run_table(spark, d):
    base = scoring.scored(forecasts(spark, d)).select("symbol", "date", "actual", "loss", "in_90", "in_50", "direction")
    other = base.filter("symbol % 2 = 0").select("symbol", "date", (F.abs("actual") * 0.3).alias("loss"), F.col("in_50").alias("in_90"), "direction")
    return rounded(reports.run_table({"base": base, "scaled": other}, ["symbol", "date"], "base"))


@query()
def o199_isotonic_remap(spark, d):
    """Pooling has no SQL twin; tested against a plain loop."""
    rows = reports.move_probabilities(forecasts(spark, d), [0.2]).select("symbol", "day_idx", "grp", F.round("p", 9).alias("p"), "hit")
    return rounded(reports.isotonic(rows, "grp", 10))


@query(FORECASTS + """ , s AS (SELECT symbol, date, [q[3] + (q[1] - q[3]) * exp(0.1 + 0.5 * sigma), q[3] + (q[5] - q[3]) * exp(0.1 + 0.5 * sigma)] AS b FROM fc) SELECT symbol, date, f32(b[1]) AS low, f32(b[2]) AS high FROM s""")
def o210_band_scaling(spark, d):
    out = reports.scaled(forecasts(spark, d), 0.1, 0.5, "sigma")
    return rounded(out.select("symbol", "date", F.get("q", F.lit(0)).alias("low"), F.get("q", F.lit(4)).alias("high")))


@query()
def o210_fitted_scale(spark, d):
    """Scale fitted by gradient steps on the earlier folds and applied to the last; losses of both, raw and scaled. Tested against a grid of scales."""
    # Every step reads the rows again, so they are made once; the quantiles follow from sigma.
    f = written(forecasts(spark, d).select("fold", "actual", "sigma"), "forecasts").withColumn("q", quantiles_of("sigma"))
    last = f.agg(F.max("fold")).first()[0]
    a, b = reports.fit_scale(f.filter(F.col("fold") < (last if last is not None else 0)), "sigma")
    raw = scoring.scored(f).select("fold", "actual", "sigma", "q", F.col("loss").alias("raw"))
    both = scoring.scored(reports.scaled(raw, a, b, "sigma")).select("fold", "raw", F.col("loss").alias("fitted"))
    return rounded(both.groupBy("fold").agg(F.count("*").alias("n"), F.avg("raw").alias("raw"), F.avg("fitted").alias("fitted")))


@query()
def o213_range_model(spark, d):
    """A trained model; tested to beat the mean on its own training rows."""
    b = daily.true_range(bars(spark, d)).select("symbol", "day_idx", "volume", "vwap", "atr_pct", ((F.col("high") - F.col("low")) / F.col("open") + 0.001).alias("range"))
    b = written(b.fillna(0.0, ["atr_pct"]), "ranges")  # read by every step of the training
    out = reports.range_model(b.filter("day_idx < 1500"), b.filter("day_idx >= 1500"), ["volume", "vwap", "atr_pct"], "range")
    return rounded(out.select("symbol", "day_idx", "mean_log", "score"))


@query(FORECASTS + """ , m AS (SELECT fold, count(*) AS n, 1 - sum(loss) / sum(naive_loss) AS skill, avg(in_90) AS c FROM sc GROUP BY fold)
 SELECT fold AS key, 'bad' AS level, printf('worse than naive by %.1f %%', -100 * skill) AS text FROM m WHERE skill < 0 UNION ALL SELECT fold, 'good', printf('better than naive by %.1f %%', 100 * skill) FROM m WHERE skill > 0.05
 UNION ALL SELECT fold, 'warn', printf('90 %% band holds %.1f %%', 100 * c) FROM m WHERE c < 0.85 UNION ALL SELECT fold, 'info', printf('only %d rows', n) FROM m WHERE n < 30""")
def o214_insights(spark, d):
    return reports.insights(scoring.metrics(scoring.scored(forecasts(spark, d)), ["fold"]), "fold")
