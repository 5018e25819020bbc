"""Queries that assemble, grade and report forecasts."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions import expr as X
from marketloom.operators import grading, scoring
from marketloom.operators.scoring import TAUS
from marketloom.plans.base import bars, query, rounded, sectors, sessions
from marketloom.plans.scoring import _BUCKET, _EDGES, FORECASTS, cdf, forecasts
from marketloom.plans.streams import _work


@query(FORECASTS + """ SELECT f.symbol, f.date, f.fold::INT AS fold, f32(f.actual) AS actual, f32(f.sigma) AS prev, coalesce(s.industry, 'unknown') AS industry, coalesce(s.sector, 'unknown') AS sector
 FROM fc f LEFT JOIN sectors s ON s.symbol = f.symbol AND s.weight > 0""")
def o36d_assembled_run(spark, d):
    folder = _work(spark)
    f = forecasts(spark, d).select("symbol", "date", "actual", F.col("sigma").alias("prev"), F.col("fold").cast("int").alias("fold"))
    f.write.partitionBy("fold").parquet(folder)  # the run, a folder for each fold
    rows = spark.read.schema("symbol long, date date, actual double, prev double, fold int").parquet(folder)
    out = grading.assemble_run(rows, sectors(spark, d).filter("weight > 0"), ["industry", "sector"], ["symbol", "date", "actual", "prev", "fold"])
    return rounded(out.select("symbol", "date", "fold", "actual", "prev", "industry", "sector"))


@query(FORECASTS + """ , live AS (SELECT f.symbol, f.date, s.date AS asof, f.q[3] + 1 AS level FROM fc f JOIN sessions s ON s.day_idx = f.day_idx - 1)
 SELECT l.symbol, l.date, l.asof, f32(n.vwap / t.vwap - 1) AS actual_move, f32(l.level * (n.vwap / t.vwap)) AS actual_vwap FROM live l JOIN bars n ON n.symbol = l.symbol AND n.date = l.date JOIN bars t ON t.symbol = l.symbol AND t.date = l.asof""")
def o122_graded_live(spark, d):
    before = sessions(spark, d).select(F.col("date").alias("asof"), (F.col("day_idx") + 1).alias("day_idx"))
    live = forecasts(spark, d).join(F.broadcast(before), "day_idx").select("symbol", "date", "asof", (F.get("q", F.lit(2)) + 1).alias("level"))
    return rounded(grading.graded_live(live, bars(spark, d)).select("symbol", "date", "asof", "actual_move", "actual_vwap"))


@query(FORECASTS + """ , di AS (SELECT symbol, date, q[3] AS d_med, q[5] - q[1] AS d_width, coalesce((q[5] + q[1] - 2 * q[3]) / nullif(q[5] - q[1], 0), 0) AS d_skew, len(list_filter(q, lambda x: x > 0)) / 5.0 AS d_p_up,
 avg(abs(actual - q[3])) OVER w AS hist_mae, avg((actual BETWEEN q[1] AND q[5])::INT) OVER w AS hist_cov FROM fc WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
 , j AS (SELECT b.symbol, b.date, s.sector, i.symbol IS NOT NULL AS has, i.* EXCLUDE (symbol, date) FROM bars b JOIN sectors s ON s.symbol = b.symbol LEFT JOIN di i ON i.symbol = b.symbol AND i.date = b.date)
 SELECT symbol, date, sector, has::INT::DOUBLE AS has_daily, f32(coalesce(d_med, 0)) AS d_med, f32(coalesce(d_width, 0)) AS d_width, f32(coalesce(d_skew, 0)) AS d_skew, f32(coalesce(d_p_up, 0)) AS d_p_up, f32(coalesce(hist_mae, 0)) AS hist_mae, f32(coalesce(hist_cov, 0)) AS hist_cov,
 f32(coalesce((sum(d_med) OVER g - coalesce(d_med, 0)) / nullif(count(d_med) OVER g - has::INT, 0), 0)) AS group_d_med FROM j WINDOW g AS (PARTITION BY date, sector)""")
def o121b_attached_daily(spark, d):
    rows = bars(spark, d).select("symbol", "date").join(sectors(spark, d).select("symbol", "sector"), "symbol")
    return rounded(grading.attach_daily(rows, grading.daily_inputs(forecasts(spark, d), 20), "sector"))


_LIST = "[" + ", ".join(f"quantile_cont({{0}}, {t})" for t in TAUS) + "]"
_PIN = " + ".join(f"greatest({t} * (actual - {{0}}[{i + 1}]), ({t} - 1) * (actual - {{0}}[{i + 1}]))" for i, t in enumerate(TAUS))
BASELINES = FORECASTS + f""" , mo AS (SELECT *, coalesce(lag(actual) OVER (PARTITION BY symbol ORDER BY date), 0) AS ref FROM sc), t1 AS (SELECT grp, {_LIST.format('actual - ref')} AS m FROM mo GROUP BY grp), t2 AS (SELECT grp, {_LIST.format('actual')} AS c FROM mo GROUP BY grp)
 , bl AS (SELECT *, ({_PIN.format('c')}) / 5 AS climatology, ({_PIN.format('mm')}) / 5 AS momentum FROM (SELECT mo.*, t2.c, list_transform(t1.m, lambda x: x + mo.ref) AS mm FROM mo JOIN t1 USING (grp) JOIN t2 USING (grp)))"""


def baselines(spark, d):
    rows = scoring.scored(forecasts(spark, d)).withColumn("ref", F.coalesce(F.lag("actual").over(Window.partitionBy("symbol").orderBy("date")), F.lit(0.0)))
    none = F.lit(0.0)
    rows = grading.with_baseline(rows, grading.residual_quantiles(rows, "grp", none), "grp", none, "climatology")
    return grading.with_baseline(rows, grading.residual_quantiles(rows, "grp", F.col("ref")), "grp", F.col("ref"), "momentum")


@query(BASELINES + " SELECT symbol, date, f32(climatology) AS climatology, f32(momentum) AS momentum FROM bl")
def o201_baseline_losses(spark, d):
    return rounded(baselines(spark, d).select("symbol", "date", "climatology", "momentum"))


_SKILLS = ", ".join(f"f32(1 - sum(loss) / nullif(sum({b}), 0)) AS skill_{b}" for b in ("naive_loss", "climatology", "momentum"))


@query(BASELINES + f""" , j AS (SELECT bl.*, s.sector FROM bl JOIN sectors s USING (symbol)) SELECT CASE WHEN grouping(symbol) = 0 THEN 'symbol' WHEN grouping(sector) = 0 THEN 'sector' WHEN grouping(date) = 0 THEN 'date' ELSE 'all' END AS kind,
 coalesce(symbol::VARCHAR, sector, date::VARCHAR) AS value, count(*) AS n, f32(avg(loss)) AS loss, {_SKILLS}, f32(avg(in_90)) AS cover_90 FROM j GROUP BY GROUPING SETS ((symbol), (sector), (date), ())""")
def o202_skill_tables(spark, d):
    rows = baselines(spark, d).join(sectors(spark, d).select("symbol", "sector"), "symbol")
    return rounded(grading.skills(rows, ["date", "sector", "symbol"], ["naive_loss", "climatology", "momentum"]))


EVENTS = FORECASTS + f""" , ev AS (SELECT symbol, date, grp, (actual > 0.05)::INT AS hit, 1 - {cdf('0.05')} AS base FROM fc), er AS (SELECT *, avg(hit) OVER (PARTITION BY grp) AS rate FROM ev), eo AS (SELECT *, (base + rate) / 2 AS shrunk FROM er)"""


def event_rows(spark, d):
    f = forecasts(spark, d).select("symbol", "date", "grp", (F.col("actual") > 0.05).cast("int").alias("hit"), (1 - X.prob_below("q", F.lit(0.05), TAUS)).alias("base"))
    rate = f.groupBy("grp").agg(F.avg("hit").alias("rate"))  # a row for each group
    return f.join(F.broadcast(rate), "grp").withColumn("shrunk", (F.col("base") + F.col("rate")) / 2)


@query(EVENTS + " SELECT grp, count(*) AS n, f32(avg(hit)) AS came_true, f32(avg(base)) AS said_base, f32(1 - sum(pow(base - hit, 2)) / nullif(sum(pow(rate - hit, 2)), 0)) AS skill_base, f32(avg(shrunk)) AS said_shrunk, f32(1 - sum(pow(shrunk - hit, 2)) / nullif(sum(pow(rate - hit, 2)), 0)) AS skill_shrunk FROM eo GROUP BY grp")
def o204_brier_skills(spark, d):
    return rounded(grading.brier_skills(event_rows(spark, d), ["grp"], "hit", "rate", ["base", "shrunk"]))


@query(FORECASTS + f""" , mv AS (SELECT symbol, date, 'up' AS side, 1 - {cdf('0.1')} AS p, (actual > 0.1)::INT AS reached FROM fc UNION ALL SELECT symbol, date, 'down', {cdf('-0.1')}, (actual < -0.1)::INT FROM fc)
 SELECT coalesce(side, 'both') AS side, count(*) AS predictions, count(DISTINCT symbol) AS stocks, count(DISTINCT date) AS days, f32(avg(p)) AS said, f32(avg(reached)) AS reached, f32(avg(reached) - avg(p)) AS gap FROM mv GROUP BY GROUPING SETS ((side), ())""")
def o206_move_summary(spark, d):
    f = forecasts(spark, d)
    side = lambda name, p, hit: f.select("symbol", "date", F.lit(name).alias("side"), p.alias("p"), hit.cast("int").alias("reached"))
    up = side("up", 1 - X.prob_below("q", F.lit(0.1), TAUS), F.col("actual") > 0.1)
    return rounded(grading.move_summary(up.union(side("down", X.prob_below("q", F.lit(-0.1), TAUS), F.col("actual") < -0.1))))


@query(FORECASTS + """ SELECT date, count(*) AS n, f32(avg(in_90)) AS coverage, f32(avg((actual > q[5])::INT)) AS above, f32(avg((actual < q[1])::INT)) AS below, f32(avg(CASE WHEN actual <> 0 THEN (sign(q[3]) = sign(actual))::INT END)) AS direction_hit, f32(avg(pit - 0.5)) AS bias,
 f32(1 - sum(loss) / nullif(sum(naive_loss), 0)) AS skill, f32(median(q[5] - q[1])) AS median_width, f32(median(actual)) AS median_actual FROM sc GROUP BY date""")
def o208_live_by_day(spark, d):
    return rounded(grading.live_by_day(scoring.scored(forecasts(spark, d))))


PICKS = FORECASTS + """ , rk AS (SELECT date, symbol, abs(actual) AS moved, sigma, row_number() OVER (PARTITION BY date ORDER BY round(sigma, 9) DESC, symbol) AS a, row_number() OVER (PARTITION BY date ORDER BY symbol % 7 DESC, symbol) AS b FROM fc)
 , pk AS (SELECT date, avg(moved) FILTER (WHERE a <= 5) AS by_sigma, avg(moved) FILTER (WHERE b <= 5) AS by_plain, median(moved) AS universe_median FROM rk GROUP BY date)"""


def picks(spark, d):
    rows = forecasts(spark, d).select("date", "symbol", F.abs("actual").alias("moved"), "sigma", (F.col("symbol") % 7).alias("plain"))
    return grading.day_picks(rows, ["sigma", "plain"], "moved", 5)


@query(PICKS + " SELECT date, f32(by_sigma) AS by_sigma, f32(by_plain) AS by_plain, f32(universe_median) AS universe_median FROM pk")
def o212_day_picks(spark, d):
    return rounded(picks(spark, d))


@query(PICKS + """ , dy AS (SELECT row_number() OVER (ORDER BY date) - 1 AS slot, count(*) OVER () AS n, by_sigma - by_plain AS v FROM pk)
 , rp AS (SELECT r.b, avg(y.v) AS m FROM (SELECT unnest(range(0, 200)) AS b) r JOIN dy x ON true JOIN dy y ON y.slot = (r.b * 73856093 + x.slot * 19349663 + r.b * x.slot * 83492791) % x.n GROUP BY r.b)
 SELECT f32((SELECT avg(v) FROM dy)) AS mean, f32(quantile_cont(m, 0.025)) AS low, f32(quantile_cont(m, 0.975)) AS high FROM rp""")
def o212_o57_paired_difference(spark, d):
    return rounded(grading.bootstrap_mean(picks(spark, d).withColumn("v", F.col("by_sigma") - F.col("by_plain")), "v"))


@query(FORECASTS + f""" , mv AS (SELECT *, unnest([-0.2, -0.05, 0.05, 0.2]) AS move FROM fc), pr AS (SELECT *, {cdf('move')} AS c FROM mv)
 , g AS (SELECT move, CASE WHEN move > 0 THEN 1 - c ELSE c END AS p, (CASE WHEN move > 0 THEN actual > move ELSE actual < move END)::INT AS hit FROM pr), b AS (SELECT move, {_BUCKET} AS bucket, round(avg(hit) * 100, 0)::INT || '% (' || count(*) || ')' AS cell FROM g GROUP BY ALL)
 SELECT f32(move) AS move, {", ".join(f"max(cell) FILTER (WHERE bucket = {i}) AS bucket_{i}" for i in range(5))} FROM b GROUP BY move""")
def o192b_grid_pivot(spark, d):
    return rounded(grading.grid_pivot(scoring.calibration_grid(forecasts(spark, d), [-0.2, -0.05, 0.05, 0.2], _EDGES, []), list(range(5))))


@query(EVENTS + f""" , nm AS (SELECT date FROM fc GROUP BY date HAVING avg(abs(actual)) > 0.3), bd AS (SELECT eo.*, nm.date IS NULL AS rest, {_BUCKET.replace('p ', 'base ')} AS band FROM eo LEFT JOIN nm USING (date))
 SELECT band, count(*) AS n, f32(avg(base)) AS said, f32(avg(hit)) AS happened, count(*) FILTER (WHERE rest) AS n_rest, f32(avg(base) FILTER (WHERE rest)) AS said_rest, f32(avg(hit) FILTER (WHERE rest)) AS happened_rest FROM bd GROUP BY band""")
def o161b_said_and_happened(spark, d):
    wild = forecasts(spark, d).groupBy("date").agg(F.avg(F.abs("actual")).alias("m")).filter("m > 0.3")
    return rounded(grading.said_and_happened(event_rows(spark, d).withColumn("p", F.col("base")), wild, _EDGES))
