"""Scored decision frames and shape scores: hits by level, coverage, skill over climatology with an interval by days, rank correlation, and the rule that says go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.expr import has_bit, pack_mask, pinball, ratio
from marketloom.operators.rolling import average_rank
from marketloom.operators.scoring import bootstrap
from marketloom.staging import written

# Ideal bands of the median's hit rate and of coverage.
HIT_BAND, COVER_BAND = (0.45, 0.55), (0.75, 0.85)


def scored_frame(forecasts: DataFrame, outcomes: DataFrame, keys: list[str], bits: dict[str, int], taus: list[float], targets: dict[str, Column] | None = None) -> DataFrame:
    """O-202b: forecasts joined to their decision rows, with losses: keys, target, q, qc, y, loss, clim_loss, reason.

    forecasts: keys, target, q (quantiles), qc (climatology's, or NULL). outcomes: keys, mask (a bit a target: its outcome is valid), y (a map from target to outcome). reason is NULL for rows that count; others have 'no
    decision row', 'not valid' (the bit isn't set), 'no outcome' or 'no forecast' (a level is unknown). Rows are kept whatever their reason, so that drops can be counted.

    targets: instead of the columns target and q, each target's quantiles as made from forecasts' other columns (not keys alone); rows are laid out to the targets after the join.
    """
    known = F.create_map(*[x for t, b in bits.items() for x in (F.lit(t), F.lit(b))])
    j = forecasts.join(outcomes.withColumn("__row", F.lit(True)), keys, "left")
    if targets is not None:
        laid = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), q.alias("q")) for t, q in targets.items()])).alias("__t")
        j = j.select(*keys, "qc", "mask", "y", "__row", laid).select(*keys, "qc", "mask", "y", "__row", "__t.*")
    j = j.withColumn("y", F.try_element_at("y", F.col("target")))
    valid = F.try_element_at(known, F.col("target")).isNotNull() & (F.call_function("shiftright", F.col("mask"), F.try_element_at(known, F.col("target"))).bitwiseAND(F.lit(1)) == 1)
    whole = ~F.exists("q", lambda v: v.isNull() | F.isnan(v))
    reason = F.when(F.isnull("__row"), "no decision row").when(~F.coalesce(valid, F.lit(False)), "not valid").when(F.isnull("y") | F.isnan("y"), "no outcome").when(~F.coalesce(whole, F.lit(False)), "no forecast")
    out = j.withColumn("reason", reason)
    loss = lambda q: F.when(F.isnull("reason"), pinball(q, "y", taus))
    return out.select(*keys, "target", "q", "qc", "y", loss("q").alias("loss"), loss("qc").alias("clim_loss"), "reason")


def shape_scores(frame: DataFrame, by: list[str], taus: list[float], moment: list[str], least: int = 3, replicates: int = 200) -> DataFrame:
    """O-203: for each group n, hits (share at or below each level) and hits_below (strictly below: outcomes that tie with a level make a span), coverage of the outer levels, skill over
    climatology with its interval over days, and mean rank correlation of the median with the outcome over the moments (date, and others in moment) that have at least `least` rows, beside climatology's.

    frame: of scored_frame, with date (in moment). The frame is read once: its rows go to their moment's cross-section with their losses, the median and the bits of the levels that they hit; a row a moment
    has the sums and the correlations, and all scores come from those.
    """
    rows = frame.filter("reason IS NULL")
    last, middle = len(taus) - 1, len(taus) // 2
    low, high = F.get("q", F.lit(0)), F.get("q", F.lit(last))
    held = lambda op: [op(F.col("y"), F.get("q", F.lit(i))) for i in range(len(taus))]
    inside = [(F.col("y") >= low) & (F.col("y") <= high), (F.col("y") > low) & (F.col("y") < high)]
    flags = [*held(lambda y, q: y <= q), *held(lambda y, q: y < q), *inside]
    cut = [*by, *moment]
    ranked = rows.select(*cut, "y", F.get("q", F.lit(middle)).alias("m"), F.get("qc", F.lit(middle)).alias("mc"), "loss", "clim_loss", pack_mask(flags).alias("__bits"))
    ranked = ranked.withColumns({"__y": average_rank("y", cut), "__m": average_rank("m", cut), "__c": average_rank("mc", cut)})
    corr = lambda c: ratio(F.covar_pop(c, "__y"), F.stddev_pop(c) * F.stddev_pop("__y"))
    scored = F.isnotnull("clim_loss")
    per = written(ranked.groupBy(*cut).agg(
        F.count("*").alias("k"), corr("__m").alias("ic"), corr("__c").alias("clim_ic"), F.count("clim_loss").alias("clim_k"), F.sum(F.when(scored, F.col("loss"))).alias("a"), F.sum("clim_loss").alias("b"),
        *[F.count_if(has_bit("__bits", i)).alias(f"__h{i}") for i in range(len(flags))],
    ), "moment-scores")
    share = lambda i: F.sum(f"__h{i}") / F.sum("k")
    n = len(taus)
    base = per.groupBy(*by).agg(F.sum("k").alias("n"), F.array(*[share(i) for i in range(n)]).alias("hits"), F.array(*[share(n + i) for i in range(n)]).alias("hits_below"), share(2 * n).alias("cover"), share(2 * n + 1).alias("cover_below"))
    daily = per.filter("clim_k > 0").groupBy(*by, "date").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    skill = bootstrap(daily, "a", "b", replicates, by)
    ic = per.filter(F.col("k") >= least).groupBy(*by).agg(F.avg("ic").alias("rank_ic"), F.avg("clim_ic").alias("clim_rank_ic"))
    return base.join(skill, by, "left").join(ic, by, "left")


def go_rule(scores: DataFrame, middle: int = 2) -> DataFrame:
    """O-203: adds calibrated (the span of the median's hit rate reaches HIT_BAND and that of the coverage COVER_BAND) and passes (calibrated, skill above 0 at its low end, and ranks better than climatology's)."""
    at = lambda c: F.get(c, F.lit(middle))
    calibrated = (at("hits_below") <= HIT_BAND[1]) & (at("hits") >= HIT_BAND[0]) & (F.col("cover_below") <= COVER_BAND[1]) & (F.col("cover") >= COVER_BAND[0])
    passes = calibrated & F.coalesce(F.col("low") > 0, F.lit(False)) & F.coalesce(F.col("rank_ic") > F.coalesce("clim_rank_ic", F.lit(0.0)), F.lit(False))
    return scores.withColumns({"calibrated": calibrated, "passes": passes})
