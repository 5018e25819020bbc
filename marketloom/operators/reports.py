"""Report tables over scored forecasts: curves, move tables, run comparisons, remaps, band scaling, the range model and insights."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions import expr as X
from marketloom.functions.expr import ratio
from marketloom.operators import ranks
from marketloom.operators.scoring import TAUS


def move_probabilities(forecasts: DataFrame, moves: list[float]) -> DataFrame:
    """Each forecast and move with the chance p that the actual goes beyond it, and whether it did."""
    rows = forecasts.withColumn("move", F.explode(F.array(*[F.lit(m) for m in moves])))
    p = F.when(F.col("move") > 0, 1 - X.prob_below("q", "move", TAUS)).otherwise(X.prob_below("q", "move", TAUS))
    hit = F.when(F.col("move") > 0, F.col("actual") > F.col("move")).otherwise(F.col("actual") < F.col("move"))
    return rows.withColumns({"p": p, "hit": hit.cast("int")})


def threshold_curve(rows: DataFrame, thresholds: list[float]) -> DataFrame:
    """O-194: for each move and least chance, how many calls there are, how many came true, and the lift over all rows."""
    base = rows.groupBy("move").agg(F.avg("hit").alias("base"))
    at = rows.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds]))).filter("p >= threshold")
    g = at.groupBy("move", "threshold").agg(F.count("*").alias("n"), F.avg("hit").alias("rate"))
    # One row for each move.
    return g.join(F.broadcast(base), "move").withColumn("lift", ratio("rate", "base"))


def move_table(latest: DataFrame, history: DataFrame, edges: list[float]) -> DataFrame:
    """O-209: the chance of each move of the latest rows beside the past hit rate of its bucket, of the symbol and of all."""
    h = history.withColumn("bucket", X.bucket("p", edges))
    own = h.groupBy("symbol", "move", "bucket").agg(F.count("*").alias("n_own"), F.avg("hit").alias("rate_own"))
    whole = h.groupBy("move", "bucket").agg(F.count("*").alias("n_all"), F.avg("hit").alias("rate_all"))
    rows = latest.withColumn("bucket", X.bucket("p", edges))
    return rows.join(own, ["symbol", "move", "bucket"], "left").join(F.broadcast(whole), ["move", "bucket"], "left").select(*latest.columns, "bucket", "n_own", "rate_own", "n_all", "rate_all")


def run_table(runs: dict[str, DataFrame], keys: list[str], reference: str) -> DataFrame:
    """O-211b, O-196b: loss, coverage and direction of each run on the keys that all runs have, and the change of loss against one run."""
    shared = None
    for df in runs.values():
        shared = df.select(*keys) if shared is None else shared.join(df.select(*keys), keys, "left_semi")
    rows = None
    for name, df in runs.items():
        own = df.join(shared, keys, "left_semi").select(F.lit(name).alias("run"), "loss", "in_90", "direction")
        rows = own if rows is None else rows.unionByName(own)
    g = rows.groupBy("run").agg(F.count("*").alias("n"), F.avg("loss").alias("loss"), F.avg("in_90").alias("cover_90"), F.avg("direction").alias("direction"))
    base = g.filter(F.col("run") == reference).select(F.col("loss").alias("__base"))
    return g.join(F.broadcast(base)).withColumn("change", ratio(F.col("loss"), F.col("__base")) - 1).drop("__base")  # a row for each run


def _pav(bins: pd.DataFrame) -> pd.DataFrame:
    """Pools neighbouring bins until the rates do not fall."""
    held: list[list[float]] = []
    for r in bins.sort_values("bin").itertuples():
        held.append([r.hits, r.n, 1])
        while len(held) > 1 and held[-2][0] / held[-2][1] > held[-1][0] / held[-1][1]:
            hits, n, k = held.pop()
            held[-1] = [held[-1][0] + hits, held[-1][1] + n, held[-1][2] + k]
    out = bins.sort_values("bin").copy()
    out["rate"] = [h[0] / h[1] for h in held for _ in range(h[2])]
    return out[["grp", "bin", "n", "mean_p", "rate"]]


def isotonic(rows: DataFrame, grp: str, bins: int) -> DataFrame:
    """O-199: hit rates of equal-count bins of a probability, made monotone. Only the bins (a few for each group) reach Python."""
    w = Window.partitionBy(grp).orderBy("p", "symbol", "day_idx")
    b = rows.withColumn("bin", F.ntile(bins).over(w)).groupBy(F.col(grp).alias("grp"), "bin").agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"), F.sum("hit").alias("hits"))
    return b.groupBy("grp").applyInPandas(_pav, "grp long, bin int, n long, mean_p double, rate double")


def scaled(forecasts: DataFrame, a: float, b: float, feature: str) -> DataFrame:
    """O-210: bands scaled around the median by exp(a + b f)."""
    s = F.exp(F.lit(a) + F.lit(b) * F.coalesce(F.col(feature), F.lit(0.0)))
    middle = F.get("q", F.lit(2))
    return forecasts.withColumn("q", F.transform("q", lambda v: middle + (v - middle) * s))


def fit_scale(forecasts: DataFrame, feature: str, steps: int = 12, rate: float = 0.5) -> tuple[float, float]:
    """O-210: a and b of least pinball loss by projected gradient steps; each step is one aggregation of three numbers."""
    a = b = 0.0
    best = (float("inf"), a, b)
    f = F.coalesce(F.col(feature), F.lit(0.0))
    for _ in range(steps):
        s = F.exp(F.lit(a) + F.lit(b) * f)
        middle = F.get("q", F.lit(2))
        loss, slope = F.lit(0.0), F.lit(0.0)
        for i, t in enumerate(TAUS):
            width = F.get("q", F.lit(i)) - middle
            e = F.col("actual") - middle - width * s
            loss = loss + F.greatest(F.lit(t) * e, F.lit(t - 1) * e) / len(TAUS)
            slope = slope - F.when(e > 0, F.lit(t)).otherwise(F.lit(t - 1)) * width * s / len(TAUS)
        row = forecasts.agg(F.avg(loss).alias("loss"), F.avg(slope).alias("ga"), F.avg(slope * f).alias("gb")).first()
        if row.loss is None:
            return 0.0, 0.0
        best = min(best, (row.loss, a, b))
        size = max(abs(row.ga), abs(row.gb), 1e-12)
        a, b = (max(-1.0, min(1.0, x - rate * g / size)) for x, g in ((a, row.ga), (b, row.gb)))
        rate *= 0.7
    return best[1], best[2]


def range_model(train: DataFrame, test: DataFrame, features: list[str], target: str) -> DataFrame:
    """O-213: a boosted model of the mean of log(target), and a score that adds the 0.8-quantile of its training residuals."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    assemble = VectorAssembler(inputCols=features, outputCol="__x", handleInvalid="skip")
    ready = lambda df: assemble.transform(df.withColumn("__y", F.ln(target)))
    model = GBTRegressor(featuresCol="__x", labelCol="__y", predictionCol="mean_log", maxIter=10, maxDepth=3, seed=1).fit(ready(train.filter(F.col(target) > 0)))
    residuals = model.transform(ready(train.filter(F.col(target) > 0))).select((F.col("__y") - F.col("mean_log")).alias("__e"))
    # Exact; ranks orders slots, where one percentile would hold every residual in a task.
    spread = ranks.quantiles(residuals, [], "__e", [0.8]).select(F.get("q", F.lit(0)).alias("spread"))
    return model.transform(ready(test)).join(F.broadcast(spread)).withColumn("score", F.col("mean_log") + F.col("spread")).drop("__x", "__y", "spread")  # one row of spread


def insights(metrics: DataFrame, key: str) -> DataFrame:
    """O-214: rows (key, level, text) where a group's figures cross a threshold."""
    rule = lambda cond, level, text: F.when(cond, F.struct(F.lit(level).alias("level"), text.alias("text")))
    rules = [
        rule(F.col("skill") < 0, "bad", F.format_string("worse than naive by %.1f %%", -100 * F.col("skill"))),
        rule(F.col("skill") > 0.05, "good", F.format_string("better than naive by %.1f %%", 100 * F.col("skill"))),
        rule(F.col("cover_90") < 0.85, "warn", F.format_string("90 %% band holds %.1f %%", 100 * F.col("cover_90"))),
        rule(F.col("n") < 30, "info", F.format_string("only %d rows", F.col("n"))),
    ]
    return metrics.select(F.col(key).alias("key"), F.explode(F.array_compact(F.array(*rules))).alias("i")).select("key", "i.*")
