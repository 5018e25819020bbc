"""Universes, eligibility, rules, scores, shortlists, identities and group moves."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions.expr import ratio
from marketloom.operators.asof import asof_join, latest
from marketloom.operators.rolling import percentile_rank


@dataclass(frozen=True)
class Rules:
    """O-20h: thresholds; a rule is active when its threshold is above 0."""

    least_price: float = 0.0
    least_dollars: float = 0.0
    least_range: float = 0.0
    earnings: str = "any"  # any, only or exclude


def rule_pass(rules: Rules) -> Column:
    """O-20h: whether a row (price, dollars, range, earn_near) passes every active rule; NULL fails an active rule."""
    ok = F.lit(True)
    for name, threshold in (("price", rules.least_price), ("dollars", rules.least_dollars), ("range", rules.least_range)):
        if threshold > 0:
            ok = ok & F.coalesce(F.col(name) >= threshold, F.lit(False))
    if rules.earnings == "only":
        ok = ok & F.coalesce(F.col("earn_near"), F.lit(False))
    if rules.earnings == "exclude":
        ok = ok & ~F.coalesce(F.col("earn_near"), F.lit(True))
    return ok


def rank_passing(rows: DataFrame, by: str, score: str, tie: str) -> DataFrame:
    """O-69, O-120: rank among the rows that pass, NULL for the others; ties by another column."""
    w = Window.partitionBy(by, "rule_pass").orderBy(F.desc_nulls_last(score), tie)
    return rows.withColumn("place", F.when(F.col("rule_pass"), F.row_number().over(w)))


def eligible(days: DataFrame, per_day: int, least_sigma: float, least_dollars: float, least_price: float) -> DataFrame:
    """O-20g: stock-days that meet the floors, the per_day largest by dollar volume on each day, ties by symbol."""
    ok = days.filter((F.col("sigma") > least_sigma) & (F.col("dollars") >= least_dollars) & (F.col("price") >= least_price))
    w = Window.partitionBy("date").orderBy(F.desc("dollars"), "symbol")
    return ok.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= per_day)


def identities(days: DataFrame, listings: DataFrame) -> DataFrame:
    """O-35: the listing that stood behind a ticker on each day: the one delisted soonest on or after it (active: never).

    Without one, the last delisted. listings: ticker, delisted (NULL: active), listing_id; the id of a day's row is figi, else cik,
    else ticker as the caller sets it.
    """
    far = F.to_date(F.lit("9999-12-31"))
    ends = latest(listings.withColumn("until", F.coalesce("delisted", far)), ["ticker", "until"], [F.col("listing_id")])
    hit = asof_join(days, ends.select("ticker", "until", "listing_id"), ["ticker"], "date", "until", "forward")
    last = ends.groupBy("ticker").agg(F.max_by("listing_id", "until").alias("last_id"))
    return hit.join(last, "ticker", "left").withColumn("listing_id", F.coalesce("listing_id", "last_id", F.col("ticker").cast("string"))).drop("until", "last_id")


def recycled(listings: DataFrame) -> DataFrame:
    """O-20f: tickers of more than one company."""
    return listings.groupBy("ticker").agg(F.count_distinct("cik").alias("n")).filter("n > 1").select("ticker")


def weighted_score(rows: DataFrame, by: list[str], weights: dict[str, float]) -> DataFrame:
    """O-70: weighted mean of percentile ranks over the features a row has."""
    ranks = {f: percentile_rank(f, by) for f in weights}
    out = rows.withColumns({f"__r_{f}": r for f, r in ranks.items()})
    total = sum((F.when(F.col(f"__r_{f}").isNotNull(), F.lit(w)).otherwise(0.0) for f, w in weights.items()), F.lit(0.0))
    score = ratio(sum((F.coalesce(F.col(f"__r_{f}"), F.lit(0.0)) * w for f, w in weights.items()), F.lit(0.0)), total)
    return out.withColumn("score", score).drop(*[f"__r_{f}" for f in weights])


def shortlist(rows: DataFrame, by: str, score: str, tie: str, size: int, crossings: dict[str, float]) -> DataFrame:
    """O-82: the best `size` rows of a group and every row over a threshold, with the reasons."""
    w = Window.partitionBy(by).orderBy(F.desc_nulls_last(score), tie)
    top = F.when(F.row_number().over(w) <= size, F.lit("top"))
    marked = rows.withColumn("__top", top)
    why = F.concat_ws("+", "__top", *[F.when(F.col(c) >= t, F.lit(c)) for c, t in crossings.items()])
    return marked.withColumn("why", why).filter("why <> ''").drop("__top")


def capped_moves(rows: DataFrame, by: list[str], member: str, cap: str, move: str, limit: float = 0.25) -> DataFrame:
    """O-51: each member's mean move of the others, weighted by capitalisation with weights held at a limit.

    The weights are the fixed point min(limit, s c) that sums to 1. At a limit of a quarter at most four others are held, so five
    names of a group suffice to find them: the group is aggregated once and joined back, with no self join. Groups with too few
    others for the limit keep plain weights.
    """
    g = rows.filter(F.col(cap) > 0)
    most = int(1 / limit)
    top = F.slice(F.reverse(F.array_sort(F.collect_list(F.struct(F.col(cap).alias("c"), F.col(member).alias("id"), F.col(move).alias("m"))))), 1, most + 1)
    # array_agg of a group is bounded by taking the best few rows by rank first.
    w = Window.partitionBy(*by).orderBy(F.desc(cap), F.desc(member))
    ranked = g.withColumn("__k", F.row_number().over(w))
    best = ranked.filter(F.col("__k") <= most + 1).groupBy(*by).agg(top.alias("__top"))
    sums = g.groupBy(*by).agg(F.sum(cap).alias("__c"), F.sum(F.col(cap) * F.col(move)).alias("__cm"), F.count("*").alias("__n"))
    j = g.join(best, by).join(sums, by).withColumn("__o", F.filter("__top", lambda x: x["id"] != F.col(member)))
    others_c, others_cm = F.col("__c") - F.col(cap), F.col("__cm") - F.col(cap) * F.col(move)
    head = lambda f, k: F.aggregate(F.slice("__o", 1, k), F.lit(0.0), lambda a, x: a + f(x)) if k else F.lit(0.0)
    out = None
    for k in range(most):
        s = ratio(F.lit(1 - limit * k), others_c - head(lambda x: x["c"], k))
        value = limit * head(lambda x: x["m"], k) + s * (others_cm - head(lambda x: x["c"] * x["m"], k))
        fits = F.coalesce(s * F.get("__o", F.lit(k))["c"] <= limit, F.lit(True))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    plain = ratio(others_cm, others_c)
    return j.withColumn("others_move", F.when((F.col("__n") - 1) * limit < 1, plain).otherwise(F.coalesce(out, plain))).drop("__top", "__c", "__cm", "__n", "__o")


def event_excess(returns: DataFrame, n: int = 63, least: int = 20, cap: float = 4.0) -> DataFrame:
    """O-78: how far a move exceeds 2 deviations of the n sessions before, signed and capped."""
    w = Window.partitionBy("symbol").orderBy("day_idx").rangeBetween(-n, -1)
    sd = F.when(F.count("ret").over(w) >= least, F.stddev_samp("ret").over(w))
    z = ratio(F.abs("ret"), sd)
    return returns.select("symbol", "day_idx", (F.signum("ret") * F.least(F.lit(cap), F.greatest(F.lit(0.0), z - 2))).alias("excess"))


def outcomes(bars: DataFrame, picks: DataFrame) -> DataFrame:
    """O-119: range from the open of each pick's day against the day's median over all: n, mean ratio and hit rate of each date."""
    r = bars.withColumn("rng", ratio(F.col("high") - F.col("low"), F.col("open")))
    usual = r.groupBy("date").agg(F.median("rng").alias("usual"))
    j = picks.join(r.select("date", "symbol", "rng"), ["date", "symbol"]).join(usual, "date")
    return j.groupBy("date").agg(F.count("*").alias("n"), F.avg("rng").alias("mean_range"), F.avg((F.col("rng") > F.col("usual")).cast("int")).alias("hit_rate"))


def prepared(panel: DataFrame) -> DataFrame:
    """O-116: counters filled and clipped, one-hot windows, log volume ratio and a loss weight of 1 / median price."""
    w = Window.partitionBy("symbol")
    hot = {f"is_{k.lower()}": (F.col("window") == k).cast("int") for k in ("Day", "Post", "Eve", "Pre", "Quiet")}
    return panel.withColumns({"since": F.least(F.coalesce("since", F.lit(99)), F.lit(99)), "to": F.least(F.coalesce("to", F.lit(99)), F.lit(99)), "loss_weight": 1 / F.percentile("vwap", F.lit(0.5)).over(w), "log_volume": F.log1p("volume"), **hot})


def shifted(state: DataFrame, target: DataFrame, columns: list[str]) -> DataFrame:
    """O-36: each target row with the state of the session before it; both sides must be unique in (symbol, day_idx)."""
    past = state.select("symbol", (F.col("day_idx") + 1).alias("day_idx"), *columns)
    return target.join(past, ["symbol", "day_idx"])


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """O-36: keys that occur more than once; an empty result shows a join to be one to one."""
    return df.groupBy(*keys).count().filter("count > 1")
