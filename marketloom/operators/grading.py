"""Assembling forecast runs, grading them later, baselines, and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions import expr as X
from marketloom.functions.expr import ratio
from marketloom.operators.scoring import TAUS


def assemble_run(rows: DataFrame, panel: DataFrame, labels: list[str], needed: list[str]) -> DataFrame:
    """O-36d: the folds of a run (a fold column: read its folder, one partition for each fold) as one table.

    All needed columns must be there. Rows without a reference or an outcome are dropped. Labels that a row lacks come from the panel (symbol
    and labels), else they are 'unknown'.
    """
    if lacking := set(needed) - set(rows.columns):
        raise ValueError(f"the run lacks {sorted(lacking)}")
    rows = rows.filter("prev IS NOT NULL AND actual IS NOT NULL")
    known = panel.select("symbol", *[F.col(c).alias(f"__{c}") for c in labels])
    filled = {c: F.coalesce(F.col(c) if c in rows.columns else F.lit(None), F.col(f"__{c}"), F.lit("unknown")) for c in labels}
    return rows.join(known, "symbol", "left").withColumns(filled).drop(*[f"__{c}" for c in labels])


def graded_live(forecasts: DataFrame, panel: DataFrame) -> DataFrame:
    """O-122: live forecasts (symbol, date, asof, level) with what the panel (symbol, date, vwap) says happened since their as-of session.

    Rows without both sessions are dropped. Two equality joins on (symbol, date).
    """
    now = panel.select("symbol", "date", F.col("vwap").alias("__now"))
    then = panel.select("symbol", F.col("date").alias("asof"), F.col("vwap").alias("__then"))
    out = forecasts.join(now, ["symbol", "date"]).join(then, ["symbol", "asof"]).withColumn("actual_move", ratio("__now", "__then") - 1)
    return out.filter("actual_move IS NOT NULL").withColumn("actual_vwap", F.col("level") * (1 + F.col("actual_move"))).drop("__now", "__then")


def daily_inputs(forecasts: DataFrame, sessions: int) -> DataFrame:
    """O-121b: shape of each daily forecast (q, actual) and the model's record over the rows before it."""
    low, mid, high = (F.get("q", F.lit(i)) for i in (0, 2, 4))
    past = Window.partitionBy("symbol").orderBy("date").rowsBetween(-sessions, -1)
    width = high - low
    return forecasts.select("symbol", "date", F.lit(1.0).alias("has_daily"), mid.alias("d_med"), width.alias("d_width"), F.coalesce(ratio(high + low - 2 * mid, width), F.lit(0.0)).alias("d_skew"), (F.size(F.filter("q", lambda x: x > 0)) / F.size("q")).alias("d_p_up"), F.avg(F.abs(F.col("actual") - mid)).over(past).alias("hist_mae"), F.avg(F.col("actual").between(low, high).cast("double")).over(past).alias("hist_cov"))


def attach_daily(rows: DataFrame, daily: DataFrame, group: str) -> DataFrame:
    """O-121b: rows (symbol, date, group) with the daily inputs, 0 where there is no forecast, and the mean median of the others in the group."""
    names = [c for c in daily.columns if c not in ("symbol", "date")]
    j = rows.join(daily, ["symbol", "date"], "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in names})
    own = F.when(F.col("has_daily") > 0, F.col("d_med"))
    return j.withColumn("__own", own).withColumn("group_d_med", F.coalesce(others_mean("__own", ["date", group]), F.lit(0.0))).drop("__own")


def others_mean(x: str, by: list[str]) -> Column:
    """Mean of the other rows' values that aren't NULL."""
    w = Window.partitionBy(*by)
    mine = F.coalesce(F.col(x), F.lit(0.0))
    return ratio(F.sum(x).over(w) - mine, F.count(x).over(w) - F.col(x).isNotNull().cast("int"))


def residual_quantiles(rows: DataFrame, cell: str, reference: Column) -> DataFrame:
    """O-201: for each cell the quantiles of what happened minus a reference (a trailing move: momentum; 0: climatology)."""
    r = rows.withColumn("__res", F.col("actual") - reference).filter("__res IS NOT NULL")
    return r.groupBy(cell).agg(F.percentile("__res", F.array(*[F.lit(t) for t in TAUS])).alias("table"))


def with_baseline(rows: DataFrame, table: DataFrame, cell: str, reference: Column, name: str) -> DataFrame:
    """O-201, O-202b: rows with the loss of a baseline: its cell's residual quantiles around the reference. Cells are few and broadcast."""
    j = rows.join(F.broadcast(table), cell, "left").withColumn("__b", F.transform("table", lambda x: x + reference))
    return j.withColumn(name, X.pinball("__b", "actual", TAUS)).drop("table", "__b")


def skills(rows: DataFrame, keys: list[str], baselines: list[str]) -> DataFrame:
    """O-202: one table for each key and one over all (grouping sets in one pass): n, loss, skill against each baseline, coverage.

    Columns kind and value name the group.
    """
    sets = [[k] for k in keys] + [[]]
    agg = [F.count("*").alias("n"), F.avg("loss").alias("loss"), *[(1 - ratio(F.sum("loss"), F.sum(b))).alias(f"skill_{b}") for b in baselines], F.avg("in_90").alias("cover_90"), *[F.grouping(k).alias(f"__{k}") for k in keys]]
    out = rows.groupingSets(sets, *keys).agg(*agg)
    kind, value = F.lit("all"), F.lit(None).cast("string")
    for k in keys:
        kind = F.when(F.col(f"__{k}") == 0, F.lit(k)).otherwise(kind)
        value = F.when(F.col(f"__{k}") == 0, F.col(k).cast("string")).otherwise(value)
    return out.select(kind.alias("kind"), value.alias("value"), "n", "loss", *[f"skill_{b}" for b in baselines], "cover_90")


def brier_skills(rows: DataFrame, by: list[str], hit: str, rate: str, variants: list[str]) -> DataFrame:
    """O-204: for each group n, how often the event came true, and each variant's mean probability and Brier skill against a rate."""
    y, base = F.col(hit), F.sum(F.pow(F.col(rate) - F.col(hit), 2.0))
    own = [x for v in variants for x in (F.avg(v).alias(f"said_{v}"), (1 - ratio(F.sum(F.pow(F.col(v) - y, 2.0)), base)).alias(f"skill_{v}"))]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.avg(y).alias("came_true"), *own)


def move_summary(rows: DataFrame) -> DataFrame:
    """O-206: predictions, stocks and days, said against reached, for each side and both together, in one pass.

    rows: symbol, date, side, p, reached.
    """
    agg = [F.count("*").alias("predictions"), F.countDistinct("symbol").alias("stocks"), F.countDistinct("date").alias("days"), F.avg("p").alias("said"), F.avg("reached").alias("reached"), F.grouping("side").alias("__all")]
    out = rows.groupingSets([["side"], []], "side").agg(*agg).withColumn("gap", F.col("reached") - F.col("said"))
    return out.withColumn("side", F.when(F.col("__all") == 1, F.lit("both")).otherwise(F.col("side"))).drop("__all")


def live_by_day(rows: DataFrame) -> DataFrame:
    """O-208: for each day of scored forecasts: coverage of the band, above and below it, direction where something moved, bias, skill, medians."""
    y, at = F.col("actual"), lambda i: F.get("q", F.lit(i))
    moved = F.when(y != 0, (F.signum(at(2)) == F.signum(y)).cast("int"))
    return rows.groupBy("date").agg(
        F.count("*").alias("n"), F.avg("in_90").alias("coverage"), F.avg((y > at(4)).cast("int")).alias("above"), F.avg((y < at(0)).cast("int")).alias("below"), F.avg(moved).alias("direction_hit"),
        F.avg(F.col("pit") - 0.5).alias("bias"), (1 - ratio(F.sum("loss"), F.sum("naive_loss"))).alias("skill"), F.median(at(4) - at(0)).alias("median_width"), F.median(y).alias("median_actual"),
    )


def day_picks(rows: DataFrame, rankings: list[str], outcome: str, n: int) -> DataFrame:
    """O-212: for each day the mean outcome of the n highest of each ranking, and the whole universe's median. Rankings count
    in nine decimals, since the last digits of a spread depend on the order of its sums; ties go by symbol.

    One window for each ranking, all over the same day partitions.
    """
    ranked = rows.withColumns({f"__{r}": F.row_number().over(Window.partitionBy("date").orderBy(F.desc(F.round(r, 9)), "symbol")) for r in rankings})
    return ranked.groupBy("date").agg(*[F.avg(F.when(F.col(f"__{r}") <= n, F.col(outcome))).alias(f"by_{r}") for r in rankings], F.median(outcome).alias("universe_median"))


def bootstrap_mean(days: DataFrame, value: str, draws: int = 200) -> DataFrame:
    """O-57: mean of a value by day (a paired difference, a gap) with the 95 % interval of resampled days. Days are few: one row each.

    Draw b takes at place s day (73856093 b + 19349663 s + 83492791 b s) mod n.
    """
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("date", F.col(value).alias("v")))), lambda x: x["v"])
    one = days.filter(F.col(value).isNotNull()).agg(ordered.alias("v")).withColumn("n", F.size("v").cast("long")).filter("n > 0")
    rep = one.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(draws - 1).cast("long"))))
    place = lambda s: F.pmod(F.col("b") * 73856093 + s * 19349663 + F.col("b") * s * 83492791, F.col("n"))
    total = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), F.lit(0.0), lambda a, s: a + F.get("v", place(s).cast("int")))
    reps = rep.select("v", "n", (total / F.col("n")).alias("mean"))
    q = F.percentile("mean", F.array(F.lit(0.025), F.lit(0.975)))
    point = F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x) / F.col("n"))
    return reps.agg(point.alias("mean"), q.alias("q")).select("mean", F.get("q", F.lit(0)).alias("low"), F.get("q", F.lit(1)).alias("high"))


def grid_pivot(grid: DataFrame, buckets: list[int]) -> DataFrame:
    """O-192b: a calibration grid as text cells, an event (move) in each row and a probability bucket in each column: 'hit % (n)'."""
    cell = F.concat(F.round(F.col("rate") * 100, 0).cast("int").cast("string"), F.lit("% ("), F.col("n").cast("string"), F.lit(")"))
    return grid.groupBy("move").agg(*[F.max(F.when(F.col("bucket") == b, cell)).alias(f"bucket_{b}") for b in buckets])


def said_and_happened(rows: DataFrame, named: DataFrame, edges: list[float]) -> DataFrame:
    """O-161b: for each probability band: said against happened, over all days and without the named ones (date), in one pass.

    Named days are one row a day.
    """
    marked = rows.join(F.broadcast(named.select("date").distinct().withColumn("__named", F.lit(True))), "date", "left")
    rest = F.col("__named").isNull()
    return marked.withColumn("band", X.bucket("p", edges)).groupBy("band").agg(
        F.count("*").alias("n"), F.avg("p").alias("said"), F.avg("hit").alias("happened"),
        F.count_if(rest).alias("n_rest"), F.avg(F.when(rest, F.col("p"))).alias("said_rest"), F.avg(F.when(rest, F.col("hit"))).alias("happened_rest"),
    )
