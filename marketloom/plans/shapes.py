"""Queries of scored decision frames: forecasts of a stock's move joined to its bars; targets are the actual move, its size and its rise."""

from pyspark.sql import functions as F

from marketloom.operators import scoring, shapes
from marketloom.operators.scoring import TAUS
from marketloom.plans.base import bars, query, rounded
from marketloom.plans.scoring import FORECASTS, forecasts, quantiles_of
from marketloom.staging import written

BITS = {"move": 0, "size": 1, "rise": 3}
_PIN = lambda q: "(" + " + ".join(f"greatest({t} * (y - {q}[{i + 1}]), ({t} - 1) * (y - {q}[{i + 1}]))" for i, t in enumerate(TAUS)) + f") / {len(TAUS)}"
FRAME = FORECASTS + f""" , qc AS (SELECT grp, [{", ".join(f"quantile_cont(actual, {t})" for t in TAUS)}] AS qc FROM fc GROUP BY grp)
 , fq AS (SELECT symbol, date, day_idx, target, list_transform(q, lambda v: CASE target WHEN 'move' THEN v WHEN 'size' THEN v + 0.1 ELSE v * 0.8 END) AS q, qc FROM fc JOIN qc USING (grp), (SELECT unnest(['move', 'size', 'rise', 'none']) AS target))
 , oc AS (SELECT b.symbol, b.date, (1 + 2 * (b.trades >= 2)::INT + 8 * (b.volume > 20)::INT) AS mask, f.actual FROM bars b LEFT JOIN fc f USING (symbol, date) WHERE b.day_idx % 10 <> 9)
 , fr0 AS (SELECT f.*, o.mask, CASE f.target WHEN 'move' THEN o.actual WHEN 'size' THEN abs(o.actual) WHEN 'rise' THEN CASE WHEN o.actual > 0 THEN o.actual END END AS y, CASE WHEN o.symbol IS NULL THEN 'no decision row' WHEN NOT coalesce((o.mask >> CASE f.target WHEN 'move' THEN 0 WHEN 'size' THEN 1 WHEN 'rise' THEN 3 END) & 1 = 1, false) THEN 'not valid' END AS r0 FROM fq f LEFT JOIN oc o USING (symbol, date))
 , fr AS (SELECT * EXCLUDE (r0, y), CASE WHEN r0 IS NULL THEN y END AS y, coalesce(r0, CASE WHEN y IS NULL THEN 'no outcome' END) AS reason FROM fr0)
 , ok AS (SELECT *, {_PIN("q")} AS loss, {_PIN("qc")} AS clim_loss FROM fr WHERE reason IS NULL)"""
_RANK = "(rank() OVER (PARTITION BY target, date ORDER BY {0}) + (count(*) OVER (PARTITION BY target, date, {0}) - 1) / 2.0)::DOUBLE"
_IC = "(avg({0} * b) - avg({0}) * avg(b)) / nullif(stddev_pop({0}) * stddev_pop(b), 0)"


def frame(spark, d):
    # The forecasts are used by their climatology, as rows and as outcomes, so they are made once; the quantiles follow from sigma.
    f = written(forecasts(spark, d).select("symbol", "date", "grp", "actual", "sigma"), "forecasts")
    qc = scoring.climatology(f, "grp", "actual").filter("grp >= 0").select("grp", F.col("q").alias("qc"))
    asked = f.join(F.broadcast(qc), "grp").select("symbol", "date", "sigma", "qc")  # three groups
    q = quantiles_of("sigma")
    smaller = F.transform(q, lambda v: v * 0.8)
    targets = {"move": q, "size": F.transform(q, lambda v: v + 0.1), "rise": smaller, "none": smaller}
    b = bars(spark, d).filter("day_idx % 10 <> 9").select("symbol", "date", (1 + 2 * (F.col("trades") >= 2).cast("int") + 8 * (F.col("volume") > 20).cast("int")).alias("mask"))
    own = b.join(f.select("symbol", "date", "actual"), ["symbol", "date"], "left")
    y = F.create_map(F.lit("move"), F.col("actual"), F.lit("size"), F.abs("actual"), F.lit("rise"), F.when(F.col("actual") > 0, F.col("actual")))
    return shapes.scored_frame(asked, own.select("symbol", "date", "mask", y.alias("y")), ["symbol", "date"], BITS, TAUS, targets)


@query(FRAME + " SELECT target, coalesce(reason, 'scored') AS reason, count(*) AS n, f32(avg(loss)) AS loss FROM (SELECT target, reason, NULL::DOUBLE AS loss FROM fr WHERE reason IS NOT NULL UNION ALL SELECT target, reason, loss FROM ok) GROUP BY ALL")
def o202b_scored_frame(spark, d):
    """Counts and mean losses of the joined rows by target and by why they are left out."""
    return rounded(frame(spark, d).groupBy("target", F.coalesce("reason", F.lit("scored")).alias("reason")).agg(F.count("*").alias("n"), F.avg("loss").alias("loss")))


@query(FRAME + f""" , bs AS (SELECT target, count(*) AS n, {", ".join(f"avg((y <= q[{i + 1}])::INT) AS h{i}, avg((y < q[{i + 1}])::INT) AS g{i}" for i in range(5))}, avg((y >= q[1] AND y <= q[5])::INT) AS cover, avg((y > q[1] AND y < q[5])::INT) AS cover_below FROM ok GROUP BY target)
 , dy AS (SELECT target, row_number() OVER (PARTITION BY target ORDER BY date) - 1 AS slot, count(*) OVER (PARTITION BY target) AS n, a, b FROM (SELECT target, date, sum(loss) AS a, sum(clim_loss) AS b FROM ok GROUP BY ALL))
 , dr AS (SELECT target, r.rep, (r.rep * 73856093 + slot * 19349663 + r.rep * slot * 83492791) % n AS slot FROM dy, (SELECT unnest(range(0, 200)) AS rep) r)
 , rp AS (SELECT target, rep, 1 - sum(a) / sum(b) AS skill FROM dr JOIN dy USING (target, slot) GROUP BY ALL)
 , sk AS (SELECT target, quantile_cont(skill, 0.025) AS low, quantile_cont(skill, 0.975) AS high FROM rp GROUP BY target), s0 AS (SELECT target, 1 - sum(a) / sum(b) AS skill FROM dy GROUP BY target)
 , rk AS (SELECT target, date, {_RANK.format("y")} AS b, {_RANK.format("q[3]")} AS a, {_RANK.format("qc[3]")} AS c FROM ok), ic AS (SELECT target, avg(i) AS rank_ic, avg(ci) AS clim_rank_ic FROM (SELECT target, date, {_IC.format("a")} AS i, {_IC.format("c")} AS ci FROM rk GROUP BY ALL HAVING count(*) >= 3) GROUP BY target)
 SELECT target, n, f32(h0) AS hit_5, f32(h2) AS hit_50, f32(g2) AS below_50, f32(h4) AS hit_95, f32(cover) AS cover, f32(skill) AS skill, f32(low) AS low, f32(high) AS high, f32(round(rank_ic, 6)) AS rank_ic, f32(round(clim_rank_ic, 6)) AS clim_rank_ic,
 g2 <= 0.55 AND h2 >= 0.45 AND cover_below <= 0.85 AND cover >= 0.75 AS calibrated, g2 <= 0.55 AND h2 >= 0.45 AND cover_below <= 0.85 AND cover >= 0.75 AND coalesce(low > 0, false) AND coalesce(rank_ic > coalesce(clim_rank_ic, 0), false) AS passes FROM bs JOIN s0 USING (target) JOIN sk USING (target) LEFT JOIN ic USING (target)""")
def o203_shape_scores(spark, d):
    """Scores by target and the go rule."""
    s = shapes.go_rule(shapes.shape_scores(frame(spark, d), ["target"], TAUS, ["date"]))
    at = lambda c, i: F.get(c, F.lit(i))
    return rounded(s.select("target", "n", at("hits", 0).alias("hit_5"), at("hits", 2).alias("hit_50"), at("hits_below", 2).alias("below_50"), at("hits", 4).alias("hit_95"), "cover", "skill", "low", "high", F.round("rank_ic", 6).alias("rank_ic"), F.round("clim_rank_ic", 6).alias("clim_rank_ic"), "calibrated", "passes"))
