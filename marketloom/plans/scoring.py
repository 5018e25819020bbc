"""Queries over forecasts: the previous VWAP's moves as quantiles, built from daily bars."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions import expr as X
from marketloom.operators import daily, scoring
from marketloom.operators.scoring import TAUS, Z
from marketloom.plans.base import BARS, bars, query, rounded, sectors

_Q = ", ".join(f"sigma * {z!r}" for z in Z)
FORECASTS = BARS + f""" , rets AS (SELECT symbol, date, day_idx, least(0.5, greatest(-0.5, r)) AS ret FROM (
 SELECT *, vwap / lag(vwap) OVER w - 1 AS r, lag(day_idx) OVER w AS p FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY day_idx)) WHERE p = day_idx - 1)
 , sg AS (SELECT *, CASE WHEN count(ret) OVER w >= 5 THEN stddev_samp(ret) OVER w END AS sigma FROM rets WINDOW w AS (PARTITION BY symbol ORDER BY day_idx ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
 , fc AS (SELECT symbol, date, day_idx, ret AS actual, [{_Q}] AS q, symbol % 3 AS grp, day_idx // 400 AS fold, sigma FROM sg WHERE sigma > 0)
 , cdf AS (SELECT *, {{cdf}} AS pit FROM fc)
 , sc AS (SELECT *, ({" + ".join(f"greatest({t} * (actual - q[{i + 1}]), ({t} - 1) * (actual - q[{i + 1}]))" for i, t in enumerate(TAUS))}) / 5 AS loss, abs(actual) / 2 AS naive_loss, abs(actual - q[3]) AS error,
   (sign(actual) = sign(q[3]))::INT AS direction, (actual >= q[1] AND actual <= q[5])::INT AS in_90, (actual >= q[2] AND actual <= q[4])::INT AS in_50 FROM cdf)"""


def cdf(x: str) -> str:
    parts = [f"WHEN {x} < q[{i + 2}] THEN {TAUS[i]} + ({x} - q[{i + 1}]) / (q[{i + 2}] - q[{i + 1}]) * {TAUS[i + 1] - TAUS[i]!r}" for i in range(4)]
    return f"CASE WHEN {x} < q[1] THEN 0.05 {' '.join(parts)} ELSE 0.95 END"


FORECASTS = FORECASTS.replace("{cdf}", cdf("actual"))


def quantiles_of(sigma: str):
    return F.array(*[F.col(sigma) * F.lit(z) for z in Z])


def forecasts(spark, d, made=None, keep=()):
    """From bars, made already or not; keep: other columns of theirs that stay."""
    f = daily.daily_volatility(daily.session_returns(bars(spark, d) if made is None else made), 20, 5, keep).filter("sigma > 0")
    return f.select("symbol", "date", "day_idx", *keep, F.col("ret").alias("actual"), quantiles_of("sigma").alias("q"), (F.col("symbol") % 3).alias("grp"), F.floor(F.col("day_idx") / 400).alias("fold"), "sigma")


@query(FORECASTS + " SELECT symbol, date, f32(actual) AS actual, f32(loss) AS loss, f32(pit) AS pit, f32(error) AS error, direction, in_90, in_50 FROM sc")
def o94_o190_scored_rows(spark, d):
    return rounded(scoring.scored(forecasts(spark, d)).select("symbol", "date", "actual", "loss", "pit", "error", "direction", "in_90", "in_50"))


@query(FORECASTS + " SELECT fold, count(*) AS n, f32(avg(loss)) AS loss, f32(1 - sum(loss) / sum(naive_loss)) AS skill, f32(avg(error)) AS mae, f32(avg(direction)) AS direction, f32(avg(in_90)) AS cover_90, f32(avg(in_50)) AS cover_50, f32(avg(pit)) AS mean_pit FROM sc GROUP BY fold")
def o196_fold_table(spark, d):
    return rounded(scoring.metrics(scoring.scored(forecasts(spark, d)), ["fold"]))


@query(FORECASTS + " SELECT symbol, n, f32(p) AS mean_pit, f32((p - 0.5) * sqrt(12.0 * n)) AS z, CASE WHEN (p - 0.5) * sqrt(12.0 * n) > 2 THEN 'pessimistic' WHEN (p - 0.5) * sqrt(12.0 * n) < -2 THEN 'optimistic' ELSE 'calibrated' END AS label FROM (SELECT symbol, count(*) AS n, avg(pit) AS p FROM sc GROUP BY symbol)")
def o191_bias(spark, d):
    return rounded(scoring.bias(scoring.scored(forecasts(spark, d)), ["symbol"]))


_EDGES = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
_BUCKET = "CASE WHEN p < 0 - 1e-12 OR p > 1 + 1e-12 THEN -1 " + " ".join(f"WHEN p < {e} - 1e-12 THEN {i}" for i, e in enumerate(_EDGES[1:-1])) + " ELSE 4 END"


@query(FORECASTS + f""" , mv AS (SELECT *, unnest([-0.2, -0.05, 0.05, 0.2]) AS move FROM fc), pr AS (SELECT *, {cdf('move')} AS c FROM mv)
 , g AS (SELECT move, grp, CASE WHEN move > 0 THEN 1 - c ELSE c END AS p, (CASE WHEN move > 0 THEN actual > move ELSE actual < move END)::INT AS hit FROM pr)
 , b AS (SELECT grp, move, {_BUCKET} AS bucket, count(*) AS n, avg(p) AS mean_p, sum(hit)::BIGINT AS hits FROM g GROUP BY ALL), r AS (SELECT *, hits::DOUBLE / n AS rate, 1.959963984540054 AS k FROM b)
 SELECT grp, f32(move) AS move, bucket, n, f32(mean_p) AS mean_p, hits, f32(rate) AS rate, f32((rate - mean_p) / nullif(sqrt(mean_p * (1 - mean_p) / n), 0)) AS z,
 f32((rate + k * k / (2 * n)) / (1 + k * k / n) - k * sqrt(rate * (1 - rate) / n + k * k / (4.0 * n * n)) / (1 + k * k / n)) AS low,
 f32((rate + k * k / (2 * n)) / (1 + k * k / n) + k * sqrt(rate * (1 - rate) / n + k * k / (4.0 * n * n)) / (1 + k * k / n)) AS high FROM r""")
def o192_o52_calibration_grid(spark, d):
    return rounded(scoring.calibration_grid(forecasts(spark, d), [-0.2, -0.05, 0.05, 0.2], _EDGES, ["grp"]))


@query(FORECASTS + """ , l AS (SELECT actual, unnest([0.75, 0.95]) AS c, q FROM fc), s AS (SELECT c, 'up' AS side, actual >= CASE WHEN c = 0.75 THEN q[2] ELSE q[1] END AS held FROM l UNION ALL SELECT c, 'down', actual <= CASE WHEN c = 0.75 THEN q[4] ELSE q[5] END FROM l)
 SELECT f32(c) AS c, side, count(*) AS n, f32(avg(held::INT)) AS rate FROM s GROUP BY ALL""")
def o193_ladder_hits(spark, d):
    return rounded(scoring.ladder_hits(forecasts(spark, d), [0.75, 0.95]))


@query(FORECASTS + f" SELECT f32([{', '.join(map(str, TAUS))}][i]) AS tau, count(*) AS n, f32(avg((actual <= q[i])::INT)) AS share FROM fc, (SELECT unnest(range(1, 6)) AS i) GROUP BY i")
def o195_quantile_table(spark, d):
    return rounded(scoring.quantile_table(forecasts(spark, d)))


_AVG_RANK = "(rank() OVER (PARTITION BY fold ORDER BY {0}) + (count(*) OVER (PARTITION BY fold, {0}) - 1) / 2.0)::DOUBLE"


@query(FORECASTS + f" , k AS (SELECT fold, {_AVG_RANK.format('round(sigma, 9)')} AS a, {_AVG_RANK.format('round(error, 9)')} AS b FROM sc) SELECT fold, count(*) AS n, f32(corr(a, b)) AS ic FROM k GROUP BY fold HAVING count(*) >= 20")
def o59_rank_ic(spark, d):
    rows = scoring.scored(forecasts(spark, d)).withColumns({c: F.round(c, 9) for c in ("sigma", "error")})
    return rounded(scoring.rank_ic(rows, ["fold"], "sigma", "error", 20))


@query(FORECASTS + f" , k AS (SELECT fold, (error > 0.3)::INT AS y, {_AVG_RANK.format('round(sigma, 9)')} AS r FROM sc) SELECT fold, f32((sum(r * y) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * (count(*) - sum(y)), 0)) AS auc, count(*) AS n FROM k GROUP BY fold")
def o58_auc(spark, d):
    rows = scoring.scored(forecasts(spark, d)).withColumns({"big": (F.col("error") > 0.3).cast("int"), "sigma": F.round("sigma", 9)})
    return rounded(scoring.auc(rows, "sigma", "big", ["fold"]))


@query(FORECASTS + """ , dy AS (SELECT row_number() OVER (ORDER BY date) - 1 AS slot, count(*) OVER () AS n, a, b FROM (SELECT date, sum(loss) AS a, sum(naive_loss) AS b FROM sc GROUP BY date))
 , dr AS (SELECT r.b AS rep, (r.b * 73856093 + slot * 19349663 + r.b * slot * 83492791) % n AS pick FROM dy, (SELECT unnest(range(0, 200)) AS b) r)
 , rp AS (SELECT rep, 1 - sum(dy.a) / sum(dy.b) AS skill FROM dr JOIN dy ON dr.pick = dy.slot GROUP BY rep)
 SELECT f32((SELECT 1 - sum(a) / sum(b) FROM dy)) AS skill, f32(quantile_cont(skill, 0.025)) AS low, f32(quantile_cont(skill, 0.975)) AS high FROM rp""")
def o57_bootstrap_skill(spark, d):
    per = scoring.scored(forecasts(spark, d)).groupBy("date").agg(F.sum("loss").alias("a"), F.sum("naive_loss").alias("b"))
    return rounded(scoring.bootstrap(per, "a", "b"))


@query(FORECASTS + """ , r AS (SELECT day_idx, i, actual - q[i] AS res FROM fc, (SELECT unnest(range(1, 6)) AS i)), l AS (SELECT day_idx + k AS day_idx, i, res FROM r, (SELECT unnest(range(1, 21)) AS k))
 , g AS (SELECT day_idx, i, count(*) AS n, CASE i WHEN 1 THEN quantile_cont(res, 0.05) WHEN 2 THEN quantile_cont(res, 0.25) WHEN 3 THEN quantile_cont(res, 0.5) WHEN 4 THEN quantile_cont(res, 0.75) ELSE quantile_cont(res, 0.95) END AS shift FROM l GROUP BY day_idx, i)
 SELECT day_idx, f32([0.05, 0.25, 0.5, 0.75, 0.95][i]) AS tau, n, f32(shift) AS shift FROM g WHERE n >= 10""")
def o198_rolling_recalibration(spark, d):
    return rounded(scoring.rolling_offsets(forecasts(spark, d), 20, 10))


@query(FORECASTS + """ , r AS (SELECT fold, grp, i, actual - q[i] AS res FROM fc, (SELECT unnest(range(1, 6)) AS i)), e AS (SELECT f.fold AS for_fold, r.grp, r.i, r.res FROM r JOIN (SELECT DISTINCT fold FROM fc) f ON r.fold < f.fold)
 , g AS (SELECT for_fold, i, grp, grouping(grp) AS whole, count(*) AS n, CASE i WHEN 1 THEN quantile_cont(res, 0.05) WHEN 2 THEN quantile_cont(res, 0.25) WHEN 3 THEN quantile_cont(res, 0.5) WHEN 4 THEN quantile_cont(res, 0.75) ELSE quantile_cont(res, 0.95) END AS shift FROM e GROUP BY GROUPING SETS ((for_fold, i, grp), (for_fold, i)))
 SELECT a.for_fold AS fold, a.grp, f32([0.05, 0.25, 0.5, 0.75, 0.95][a.i]) AS tau, a.n, f32(CASE WHEN a.n >= 50 THEN a.shift ELSE b.shift END) AS shift FROM g a JOIN g b ON a.for_fold = b.for_fold AND a.i = b.i WHERE a.whole = 0 AND b.whole = 1""")
def o197_walk_forward_recalibration(spark, d):
    return rounded(scoring.fold_shifts(forecasts(spark, d), 50))


@query(FORECASTS + " SELECT CASE WHEN grouping(grp) = 1 THEN -1 ELSE grp END AS grp, count(*) AS n, " + ", ".join(f"f32(quantile_cont(actual, {t})) AS q{i}" for i, t in enumerate(TAUS)) + " FROM fc GROUP BY GROUPING SETS ((grp), ())")
def o200_o91_climatology(spark, d):
    c = scoring.climatology(forecasts(spark, d), "grp", "actual")
    return rounded(c.select("grp", "n", *[F.get("q", F.lit(i)).alias(f"q{i}") for i in range(5)]))


@query(FORECASTS + """ , o AS (SELECT symbol, date, (0.05 * greatest(0, 0) + abs(actual) * 0.4) AS loss FROM sc) SELECT a.date, count(*) AS n, f32(avg(a.loss)) AS loss_a, f32(avg(b.loss)) AS loss_b, f32(avg((b.loss < a.loss)::INT)) AS b_better FROM sc a JOIN o b USING (symbol, date) GROUP BY a.date""")
def o211_paired_runs(spark, d):
    a = scoring.scored(forecasts(spark, d))
    return rounded(scoring.paired(a, a.select("symbol", "date", (F.abs("actual") * 0.4).alias("loss")), ["symbol", "date"]))


@query(FORECASTS + """ , w AS (SELECT grp, day_idx, error AS x, sigma AS w FROM sc), p AS (SELECT *, (sum(w) OVER (PARTITION BY grp ORDER BY x, w ROWS UNBOUNDED PRECEDING) - w / 2) / sum(w) OVER (PARTITION BY grp) AS p FROM w)
 , l AS (SELECT *, lead(x) OVER o AS x1, lead(p) OVER o AS p1, row_number() OVER o = 1 AS f FROM p WINDOW o AS (PARTITION BY grp ORDER BY x, w)), q AS (SELECT grp, """ + ", ".join(f"max(CASE WHEN p <= {t} AND p1 > {t} THEN x + (x1 - x) * ({t} - p) / (p1 - p) WHEN f AND p > {t} THEN x WHEN p1 IS NULL AND p <= {t} THEN x END) AS w{i}" for i, t in enumerate((0.1, 0.5, 0.9))) + """ FROM l GROUP BY grp)
 , e AS (SELECT grp, sum(s) * sum(s) / sum(s * s) AS n_eff FROM (SELECT grp, day_idx, sum(w) AS s FROM w GROUP BY ALL) GROUP BY grp) SELECT grp, f32(w0) AS w0, f32(w1) AS w1, f32(w2) AS w2, f32(n_eff) AS n_eff FROM q JOIN e USING (grp)""")
def o54_o56_weighted_quantiles(spark, d):
    rows = scoring.scored(forecasts(spark, d))
    q = scoring.weighted_quantiles(rows.select("grp", "error", "sigma"), ["grp"], "error", "sigma", [0.1, 0.5, 0.9])
    return rounded(q.join(scoring.effective_days(rows, ["grp"], "day_idx", "sigma"), "grp"))


@query(FORECASTS + " SELECT symbol, date, f32(q[3]) AS median, f32(q[4] - q[2]) AS iqr, f32(q[5] - q[1]) AS width, f32((q[5] + q[1] - 2 * q[3]) / (q[5] - q[1])) AS skew, f32((q[5] - q[1]) / (q[4] - q[2])) AS tail, f32(1 - 0.5) AS p_up FROM fc")
def o99_forecast_shape(spark, d):
    return rounded(forecasts(spark, d).select("symbol", "date", *[c.alias(n) for n, c in X.shape("q", TAUS).items()]))


@query(FORECASTS + """ , j AS (SELECT f.*, s.sector FROM fc f JOIN sectors s USING (symbol)), r AS (SELECT symbol, date, sector, sigma, q[5] - q[1] AS width, avg((actual >= q[1] AND actual <= q[5])::INT) OVER w AS own_record FROM j WINDOW w AS (PARTITION BY symbol ORDER BY day_idx ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
 SELECT symbol, date, sector, f32(width) AS width, f32(own_record) AS own_record, f32((sum(width) OVER g - width) / nullif(count(width) OVER g - 1, 0)) AS sector_width, row_number() OVER (PARTITION BY date ORDER BY round(width, 9) DESC, symbol)::INT AS place FROM r WINDOW g AS (PARTITION BY date, sector)""")
def o121_handoff(spark, d):
    """Places by width in nine decimals, then symbol: a width's last digits depend on the order of its sums."""
    from marketloom.operators.rolling import loo_mean

    f = forecasts(spark, d).join(sectors(spark, d).select("symbol", "sector"), "symbol")
    inside = ((F.col("actual") >= F.get("q", F.lit(0))) & (F.col("actual") <= F.get("q", F.lit(4)))).cast("int")
    record = F.avg(inside).over(Window.partitionBy("symbol").orderBy("day_idx").rowsBetween(-20, -1))
    f = f.select("symbol", "date", "sector", (F.get("q", F.lit(4)) - F.get("q", F.lit(0))).alias("width"), record.alias("own_record"))
    return rounded(f.withColumns({"sector_width": loo_mean("width", ["date", "sector"]), "place": F.row_number().over(Window.partitionBy("date").orderBy(F.desc(F.round("width", 9)), "symbol"))}))


@query(FORECASTS + """ , dy AS (SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY date) - 1 AS i, a, b FROM (SELECT grp, date, sum(loss) AS a, sum(naive_loss) AS b FROM sc GROUP BY ALL)),
 sl AS (SELECT grp, i // 2 AS slot, a, b, count(*) OVER (PARTITION BY grp) AS n FROM dy WHERE i % 2 = 0),
 st AS (SELECT grp, slot, n, rep, (rep * 73856093 + slot * 19349663 + rep * slot * 83492791) % n AS frm FROM sl, (SELECT unnest(range(0, 200)) AS rep) WHERE slot % 5 = 0),
 dw AS (SELECT grp, rep, (frm + k) % n AS slot FROM st, (SELECT unnest(range(0, 5)) AS k) WHERE st.slot + k < n),
 rp AS (SELECT grp, rep, 1 - sum(a) / sum(b) AS skill FROM dw JOIN sl USING (grp, slot) GROUP BY ALL)
 SELECT grp, f32((SELECT 1 - sum(a) / sum(b) FROM sl WHERE sl.grp = rp.grp)) AS skill, f32(quantile_cont(skill, 0.025)) AS low, f32(quantile_cont(skill, 0.975)) AS high FROM rp GROUP BY grp""")
def o57_block_bootstrap(spark, d):
    """By group: circular blocks of five days, of every second day."""
    per = scoring.scored(forecasts(spark, d)).groupBy("grp", "date").agg(F.sum("loss").alias("a"), F.sum("naive_loss").alias("b"))
    return rounded(scoring.bootstrap(per, "a", "b", by=["grp"], block=5, gap=1))
