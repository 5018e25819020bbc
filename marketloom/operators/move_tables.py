"""Tables of said moves: over the period, by day, by time of day and by lean. Groups may be of any size: medians come from counted values in slots, not from a sort of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators import ranks, scoring


def _states() -> list[Column]:
    """Disjoint: the centre reached it; only the price touched it; neither. What is left is unknown (no trade)."""
    hit = F.coalesce(F.col("reached") == 1, F.lit(False))
    touch = F.coalesce(F.col("touched") == 1, F.lit(False))
    return [F.count_if(hit).alias("happened"), F.count_if(~hit & touch).alias("touched_only"), F.count_if(F.coalesce(F.col("reached") == 0, F.lit(False)) & ~touch).alias("did_not")]


def _rates() -> list[Column]:
    over = F.avg(F.when(F.col("touched") == 1, F.col("best_x"))).alias("mean_over")
    return [F.count("*").alias("predictions"), F.avg("p").alias("said"), F.avg("reached").alias("reached"), F.avg("touched").alias("touched"), over]


def _medians(table: DataFrame, rows: DataFrame, by: list[str], values: dict[str, Column]) -> DataFrame:
    """table (a row for each group) with the exact medians of the values in each group."""
    long = rows.select(*by, F.explode(F.array(*[F.struct(F.lit(n).alias("__m"), v.cast("double").alias("__x")) for n, v in values.items()])).alias("__v")).select(*by, "__v.*")
    found = ranks.quantiles(long, [*by, "__m"], "__x", [0.5])  # all values in one pass
    wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("__m") == n, F.get("q", F.lit(0)))).alias(n) for n in values])
    return table.join(wide, by, "left")


def by_period(rows: DataFrame, scored: DataFrame, replicates: int = 200) -> DataFrame:
    """O-206: for each side and 'both': predictions, stocks, days, decisions that were scored, said against reached with the gap's 95 % interval of resampled days, touches, centres that never formed, and medians.

    rows: symbol, date, side, p, reached, touched, formed (0, 1 or NULL), centre, best, best_x, vwap_move; scored: date, side, decisions.
    """
    both = rows.withColumn("side", F.explode(F.array("side", F.lit("both"))))
    shown = scored.withColumn("side", F.explode(F.array("side", F.lit("both")))).groupBy("side").agg(F.sum("decisions").alias("decisions"))
    t = both.groupBy("side").agg(*_rates(), F.countDistinct("symbol").alias("stocks"), F.countDistinct("date").alias("days"), (1 - F.avg("formed")).alias("not_formed"))
    t = shown.join(t, "side", "left").fillna(0, ["predictions", "stocks", "days"])
    t = _medians(t, both, ["side"], {"median_centre": F.abs("centre"), "median_best": F.abs("best"), "median_vwap_move": F.col("vwap_move"), "median_best_x": F.when(F.col("touched") == 1, F.col("best_x"))})
    known = both.filter("reached IS NOT NULL AND p IS NOT NULL")
    # 1 - sum(1 - gap) / n is the mean gap, whose days are drawn again.
    daily = known.groupBy("side", "date").agg(F.sum(1 - (F.col("reached") - F.col("p"))).alias("a"), F.count("*").cast("double").alias("b"))
    gap = scoring.bootstrap(daily, "a", "b", replicates, ["side"]).select("side", F.col("skill").alias("gap"), F.col("low").alias("gap_low"), F.col("high").alias("gap_high"))
    return t.join(gap, "side", "left").withColumn("share_flagged", F.try_divide("predictions", "decisions"))


def by_day(rows: DataFrame, scored: DataFrame) -> DataFrame:
    """O-206: for each scored day and side the states, said (mean and most), the rates and medians; a day without a prediction has zeros."""
    t = rows.groupBy("date", "side").agg(*_rates(), *_states(), F.countDistinct("symbol").alias("stocks"), F.max("p").alias("max_said"))
    t = _medians(t, rows, ["date", "side"], {"median_best": F.abs("best"), "median_vwap_move": F.col("vwap_move")})
    return scored.join(t, ["date", "side"], "left").fillna(0, ["predictions", "happened", "touched_only", "did_not", "stocks"])


def by_time(rows: DataFrame, width: int = 15) -> DataFrame:
    """O-206: for each bucket of `width` minutes of the day (minute) and side the states, unknown ones too, said, the rates and how far the price went."""
    r = rows.withColumn("bucket", (F.floor(F.col("minute") / width) * width).cast("int"))
    t = _medians(r.groupBy("bucket", "side").agg(*_rates(), *_states()), r, ["bucket", "side"], {"median_best_x": F.col("best_x")})
    return t.withColumn("unknown", F.col("predictions") - F.col("happened") - F.col("touched_only") - F.col("did_not"))


def by_lean(rows: DataFrame) -> DataFrame:
    """O-206: predictions by the side that had the higher probability at that decision (equal ones lean up): how often the leaned side came, and the other.

    rows: p_up, p_dn, reached_up, reached_dn, vwap_move.
    """
    up = F.col("p_up") >= F.col("p_dn")
    pick = lambda a, b: F.avg(F.when(up, F.col(a)).otherwise(F.col(b)))
    t = rows.groupBy(F.when(up, "up").otherwise("down").alias("lean")).agg(
        F.count("*").alias("predictions"), F.avg("p_up").alias("mean_p_up"), F.avg("p_dn").alias("mean_p_dn"), F.avg((F.col("vwap_move") > 0).cast("int")).alias("went_up"),
        pick("reached_up", "reached_dn").alias("lean_reached"), pick("reached_dn", "reached_up").alias("other_reached"))
    return t.crossJoin(F.broadcast(t.agg(F.sum("predictions").alias("__all")))).withColumn("share", F.col("predictions") / F.col("__all")).drop("__all")  # one row


def by_lean_decile(rows: DataFrame, named: DataFrame, deciles: int = 10) -> DataFrame:
    """O-161b: decisions cut by their lean (p_up - p_dn) into equally many, over all days and without the named ones: how far the price went, and how often either side was touched.

    rows: symbol, date, p_up, p_dn, touched_up, touched_dn, vwap_move, one row for each decision; named: date (a row a day). Equal leans share the decile of their mean rank; ranks come from counted
    values in slots. A move of 0 has no direction.
    """
    marked = rows.join(F.broadcast(named.select("date").distinct().withColumn("__named", F.lit(True))), "date", "left")
    which = F.explode(F.when(F.col("__named").isNull(), F.array(F.lit("all"), F.lit("rest"))).otherwise(F.array(F.lit("all"))))
    r = marked.withColumn("lean", F.round(F.col("p_up") - F.col("p_dn"), 9)).withColumn("days", which).filter("lean IS NOT NULL")
    rank = ranks.running(r, ["days"], "lean").select("days", "lean", F.floor((F.col("before") + F.col("n") / 2) * deciles / F.col("total")).cast("int").alias("decile"))
    went = F.when(F.col("vwap_move") != 0, (F.col("vwap_move") > 0).cast("int"))
    return r.join(rank, ["days", "lean"]).groupBy("days", "decile").agg(
        F.count("*").alias("n"), F.avg("lean").alias("lean"), F.avg(went).alias("went_up"), F.avg("touched_up").alias("touched_up"), F.avg("touched_dn").alias("touched_dn"), F.avg("vwap_move").alias("vwap_move"))


def lean_skill(rows: DataFrame) -> DataFrame:
    """O-161b: area under the curve of the lean for the direction that the price went, and, where one side alone was touched, for that side; with the number of rows of each."""
    lean = F.round(F.col("p_up") - F.col("p_dn"), 9)
    went = rows.filter("vwap_move <> 0").select(F.lit("went_up").alias("outcome"), lean.alias("lean"), (F.col("vwap_move") > 0).cast("int").alias("y"))
    one = rows.filter("touched_up + touched_dn = 1").select(F.lit("only_up_touched").alias("outcome"), lean.alias("lean"), F.col("touched_up").alias("y"))
    return ranks.auc(went.union(one).filter("lean IS NOT NULL"), "lean", "y", ["outcome"])
