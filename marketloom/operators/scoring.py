"""Forecast scores, calibration, recalibration and confidence intervals by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions import expr as X
from marketloom.functions.expr import ratio
from marketloom.operators import ranks
from marketloom.staging import written
from marketloom.operators.ranks import auc, rank_ic, weighted_quantiles  # noqa: F401

# Forecast levels and the normal quantiles at them.
TAUS = [0.05, 0.25, 0.5, 0.75, 0.95]
Z = [-1.6448536269514722, -0.6744897501960817, 0.0, 0.6744897501960817, 1.6448536269514722]


def scored(forecasts: DataFrame) -> DataFrame:
    """O-190, O-191: each forecast (q, actual) with pinball loss, the naive loss of its median, PIT, error, direction and coverage."""
    y = F.col("actual")
    at = lambda i: F.get("q", F.lit(i))
    return forecasts.withColumns({
        "loss": X.pinball("q", "actual", TAUS),
        "naive_loss": F.abs(y) / 2,
        "pit": X.prob_below("q", y, TAUS),
        "error": F.abs(y - at(2)),
        "direction": (F.signum(y) == F.signum(at(2))).cast("int"),
        "in_90": ((y >= at(0)) & (y <= at(4))).cast("int"),
        "in_50": ((y >= at(1)) & (y <= at(3))).cast("int"),
    })


def metrics(rows: DataFrame, by: list[str]) -> DataFrame:
    """O-190, O-196: loss, skill over the naive forecast, mean error, direction and coverage for each group."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg("loss").alias("loss"), (1 - ratio(F.sum("loss"), F.sum("naive_loss"))).alias("skill"), F.avg("error").alias("mae"),
        F.avg("direction").alias("direction"), F.avg("in_90").alias("cover_90"), F.avg("in_50").alias("cover_50"), F.avg("pit").alias("mean_pit"),
    )


def bias(rows: DataFrame, by: list[str]) -> DataFrame:
    """O-191: mean PIT of each group, its z-score (a uniform's deviation is 1 / sqrt(12)) and a label."""
    z = (F.col("mean_pit") - 0.5) * F.sqrt(F.lit(12.0) * F.col("n"))
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), F.avg("pit").alias("mean_pit")).withColumn("z", z)
    return out.withColumn("label", F.when(F.col("z") > 2, "pessimistic").when(F.col("z") < -2, "optimistic").otherwise("calibrated"))


def calibration_grid(forecasts: DataFrame, moves: list[float], edges: list[float], by: list[str]) -> DataFrame:
    """O-192, O-52: for each move and bucket of its forecast probability: n, mean probability, hit rate, z and Wilson interval."""
    rows = forecasts.withColumn("move", F.explode(F.array(*[F.lit(m) for m in moves])))
    p = F.when(F.col("move") > 0, 1 - X.prob_below("q", "move", TAUS)).otherwise(X.prob_below("q", "move", TAUS))
    hit = F.when(F.col("move") > 0, F.col("actual") > F.col("move")).otherwise(F.col("actual") < F.col("move"))
    rows = rows.withColumns({"p": p, "hit": hit.cast("int")})
    g = rows.withColumn("bucket", X.bucket("p", edges)).groupBy(*by, "move", "bucket").agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"), F.sum("hit").alias("hits"))
    low, high = X.wilson("hits", "n")
    return g.withColumns({"rate": ratio("hits", "n"), "z": X.binomial_z("hits", "n", "mean_p"), "low": low, "high": high})


def ladder_hits(forecasts: DataFrame, confidences: list[float]) -> DataFrame:
    """O-193: how often the actual stayed above the lower and below the upper ladder level of each confidence."""
    levels = [F.struct(F.lit(c).alias("c"), F.lit(s).alias("side"), X.ladder("q", c, TAUS)[i].alias("level")) for c in confidences for i, s in enumerate(("up", "down"))]
    rows = forecasts.select("actual", F.explode(F.array(*levels)).alias("l")).select("actual", "l.*")
    held = F.when(F.col("side") == "up", F.col("actual") >= F.col("level")).otherwise(F.col("actual") <= F.col("level"))
    return rows.groupBy("c", "side").agg(F.count("*").alias("n"), F.avg(held.cast("int")).alias("rate"))


def quantile_table(forecasts: DataFrame) -> DataFrame:
    """O-195: share of actuals at or below each forecast level."""
    rows = forecasts.select("actual", F.posexplode("q").alias("i", "v"))
    return rows.groupBy(F.get(F.array(*[F.lit(t) for t in TAUS]), F.col("i")).alias("tau")).agg(F.count("*").alias("n"), F.avg((F.col("actual") <= F.col("v")).cast("int")).alias("share"))


def bootstrap(daily: DataFrame, a: str, b: str, replicates: int = 200, by: list[str] | None = None, block: int = 1, gap: int = 0) -> DataFrame:
    """O-57: skill 1 - sum(a) / sum(b) with a 95 % interval over resampled days, for each group.

    daily: one row for each day (date) and group with its sums. Days are numbered in each group; a replicate draws circular blocks of `block` following days until
    it has as many days as there are, so that neighbouring days stay together; days closer than `gap` after a used one are left out first (they
    share outcomes). Draws come from an integer formula, so other engines repeat them. Draws are counted for each day and replicate before they meet the sums:
    one pass over (group, day) rows, each laid out to at most replicates x block counts, and only sums are shuffled.
    """
    by = by or []
    order = Window.partitionBy(*by, *([] if by else [F.lit(0)])).orderBy("date")  # days of one group
    days = daily.withColumn("__i", F.row_number().over(order) - 1).filter(F.col("__i") % (gap + 1) == 0)
    days = days.select(*by, F.expr(f"__i div {gap + 1}").alias("slot"), F.col(a).alias("__a"), F.col(b).alias("__b"), F.count("*").over(Window.partitionBy(*by, *([] if by else [F.lit(0)]))).alias("n"))
    # Every block-th slot of a replicate starts a block at a drawn day; the last block is cut at n days.
    starts = days.filter(F.col("slot") % block == 0).select(*by, "slot", "n", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("b"))
    drawn = F.pmod(F.col("b").cast("long") * 73856093 + F.col("slot").cast("long") * 19349663 + F.col("b").cast("long") * F.col("slot") * 83492791, F.col("n"))
    length = F.least(F.lit(block), F.col("n") - F.col("slot")).cast("int")
    laid = starts.select(*by, "b", "n", drawn.alias("__from"), F.explode(F.sequence(F.lit(0), length - 1)).alias("__k"))
    times = laid.groupBy(*by, "b", F.pmod(F.col("__from") + F.col("__k"), F.col("n")).alias("slot")).agg(F.count("*").alias("__times"))
    reps = times.join(days, [*by, "slot"]).groupBy(*by, "b").agg((1 - ratio(F.sum(F.col("__times") * F.col("__a")), F.sum(F.col("__times") * F.col("__b")))).alias("skill"))
    q = F.percentile("skill", F.array(F.lit(0.025), F.lit(0.975)))  # of the replicates, a few hundred
    point = days.groupBy(*by).agg((1 - ratio(F.sum("__a"), F.sum("__b"))).alias("skill"))
    ends = reps.groupBy(*by).agg(q.alias("q"))
    both = ends.join(point, by) if by else ends.crossJoin(F.broadcast(point))  # one row each
    return both.select(*by, "skill", F.get("q", F.lit(0)).alias("low"), F.get("q", F.lit(1)).alias("high"))


def rolling_offsets(rows: DataFrame, sessions: int, least: int) -> DataFrame:
    """O-198: for each day and level, the shift that would have made the level right over the sessions before.

    Residuals are gathered once into an array for each day and level (a cross-section), and whole arrays, not rows, are laid out to the
    sessions that follow. A group is a universe times a few sessions; its exact quantile is read from the sorted values.
    """
    r = rows.select("day_idx", F.posexplode("q").alias("i", "v"), "actual")
    per = r.groupBy("day_idx", "i").agg(F.collect_list(F.col("actual") - F.col("v")).alias("res"))
    later = per.select(F.explode(F.sequence(F.col("day_idx") + 1, F.col("day_idx") + sessions)).alias("day_idx"), "i", "res")
    tau = F.get(F.array(*[F.lit(t) for t in TAUS]), F.col("i"))
    held = later.groupBy("day_idx", "i").agg(F.sort_array(F.flatten(F.collect_list("res"))).alias("x"))
    held = held.select("day_idx", tau.alias("tau"), "x", F.size("x").cast("long").alias("n")).filter(F.col("n") >= least)
    place = (F.col("n") - 1) * F.col("tau")
    low, high = F.get("x", F.floor(place).cast("int")), F.get("x", F.ceil(place).cast("int"))
    return held.select("day_idx", "tau", "n", (low + (high - low) * (place - F.floor(place))).alias("shift"))


def fold_shifts(rows: DataFrame, least: int) -> DataFrame:
    """O-197: shifts of each fold and group from earlier folds; all groups together where a group has fewer than `least` rows.

    Exact: ranks cuts each group's residuals into slots, so no task holds a group. Residuals that are equal in a fold and group are one row with their number before
    they go to the later folds. grp is not NULL.
    """
    r = rows.select("fold", "grp", F.posexplode("q").alias("i", "v"), "actual").withColumn("res", F.col("actual") - F.col("v")).filter("res IS NOT NULL")
    counted = written(r.groupBy("fold", "grp", "i", "res").agg(F.count("*").alias("k")), "fold-residuals")
    folds = counted.select(F.col("fold").alias("for_fold")).distinct()
    # Folds are few: a handful of rows.
    earlier = counted.join(F.broadcast(folds), F.col("fold") < F.col("for_fold"))
    shifts = lambda by, name: ranks.quantiles(earlier, by, "res", TAUS, count="k").select(*by, "n", F.get("q", F.col("i")).alias(name))
    own, whole = shifts(["for_fold", "i", "grp"], "shift"), shifts(["for_fold", "i"], "all_shift").drop("n")
    out = own.join(whole, ["for_fold", "i"])
    return out.select(F.col("for_fold").alias("fold"), "grp", F.get(F.array(*[F.lit(t) for t in TAUS]), F.col("i")).alias("tau"), "n", F.when(F.col("n") >= least, F.col("shift")).otherwise(F.col("all_shift")).alias("shift"))


def climatology(rows: DataFrame, cell: str, value: str) -> DataFrame:
    """O-200, O-91: quantiles of a value for each cell, and over all (cell -1). Every value counts in its own cell and in cell -1, which ranks cuts into slots."""
    both = rows.select(F.explode(F.array(F.col(cell).cast("long"), F.lit(-1).cast("long"))).alias("__cell"), F.col(value).alias("__x"))
    return ranks.quantiles(both, ["__cell"], "__x", TAUS).select(F.col("__cell").alias(cell), "n", "q")


def paired(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """O-36b, O-211: two scored runs on their common keys: loss of each by day and the share of rows where b is better."""
    j = a.select(*keys, F.col("loss").alias("loss_a")).join(b.select(*keys, F.col("loss").alias("loss_b")), keys)
    return j.groupBy("date").agg(F.count("*").alias("n"), F.avg("loss_a").alias("loss_a"), F.avg("loss_b").alias("loss_b"), F.avg((F.col("loss_b") < F.col("loss_a")).cast("int")).alias("b_better"))


def effective_days(rows: DataFrame, by: list[str], day: str, w: str) -> DataFrame:
    """O-56: (sum W)^2 / sum W^2 over the days' weights W."""
    per = rows.groupBy(*by, day).agg(F.sum(w).alias("__w"))
    return per.groupBy(*by).agg(ratio(F.sum("__w") * F.sum("__w"), F.sum(F.col("__w") * F.col("__w"))).alias("n_eff"))
