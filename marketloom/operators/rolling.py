"""Windows: prior windows, ranks, leave-one-out, runs and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from marketloom.functions.expr import ratio


def prior(by: str | list[str], order: str, n: int) -> WindowSpec:
    """O-66: the n rows before this one."""
    return Window.partitionBy(by).orderBy(order).rowsBetween(-n, -1)


def sessions_window(by: str | list[str], order: str, start: int, end: int) -> WindowSpec:
    """O-61, O-65: rows whose session index lies in [start, end] of this one's; a missing bar leaves a hole."""
    return Window.partitionBy(by).orderBy(order).rangeBetween(start, end)


def with_min(value: Column, x: str, w: WindowSpec, least: int) -> Column:
    """O-66: a window value where at least `least` rows of x are known."""
    return F.when(F.count(x).over(w) >= least, value)


def median_over(x: str, w: WindowSpec) -> Column:
    """O-67: exact median over a frame."""
    return F.percentile(x, F.lit(0.5)).over(w)


def _sorted(x: str, by: list[str]) -> tuple[WindowSpec, WindowSpec, WindowSpec]:
    """A group in the order of x: as ranks need it, up to a row and its equals, and whole. All have one sort, so a task holds its rows once."""
    w = Window.partitionBy(*by).orderBy(x)
    return w, w.rangeBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def loo_mean(x: str, by: list[str]) -> Column:
    """O-50: mean of x over the others of a group."""
    _, _, w = _sorted(x, by)
    return ratio(F.sum(x).over(w) - F.coalesce(F.col(x), F.lit(0.0)), F.count(x).over(w) - F.when(F.col(x).isNotNull(), 1).otherwise(0))


def average_rank(x: str, by: list[str]) -> Column:
    """O-69, O-70: rank with ties sharing their mean place, that between the first and the last of them."""
    w, upto, _ = _sorted(x, by)
    first = F.rank().over(w)
    return (first + F.when(F.col(x).isNotNull(), F.count("*").over(upto)).otherwise(first - 1)) / 2


def percentile_rank(x: str, by: list[str]) -> Column:
    """O-69: average rank divided by the group's size."""
    _, _, w = _sorted(x, by)
    return F.when(F.col(x).isNotNull(), average_rank(x, by) / F.count(x).over(w))


def beta(y: str, m: str, w: WindowSpec, least: int) -> Column:
    """O-68: mean of y m over mean of m squared in a window."""
    return F.when(F.count(F.col(y) * F.col(m)).over(w) >= least, ratio(F.avg(F.col(y) * F.col(m)).over(w), F.avg(F.col(m) * F.col(m)).over(w)))


def runs(df: DataFrame, by: list[str], order: str, flag: Column) -> DataFrame:
    """O-75: runs of consecutive rows with a true flag: by, start, length."""
    w = Window.partitionBy(*by).orderBy(order)
    marked = df.withColumn("__f", F.coalesce(flag, F.lit(False)))
    starts = F.sum(F.when(F.col("__f") & ~F.coalesce(F.lag("__f").over(w), F.lit(False)), 1).otherwise(0)).over(w)
    return marked.withColumn("__run", starts).filter("__f").groupBy(*by, "__run").agg(F.min(order).alias("start"), F.count("*").alias("length")).drop("__run")


def gaps(df: DataFrame, by: list[str], ts: str, seconds: int) -> DataFrame:
    """O-76: spans of more than `seconds` without a row: by, gap_start, gap_end, gap_s."""
    w = Window.partitionBy(*by).orderBy(ts)
    span = F.unix_micros(F.lead(ts).over(w)) - F.unix_micros(ts)
    found = df.select(*by, F.col(ts)).distinct().withColumns({"gap_end": F.lead(ts).over(w), "gap_s": span / 1e6})
    return found.filter(F.col("gap_s") > seconds).select(*by, F.col(ts).alias("gap_start"), "gap_end", "gap_s")


def split_series(df: DataFrame, by: str, order: str, price: str, most_gap: int = 20, most_move: float = 10.0) -> DataFrame:
    """O-77: series cut where more than most_gap sessions are missing or the price moves most_move-fold; earlier parts count back."""
    w = Window.partitionBy(by).orderBy(order)
    move = ratio(F.col(price), F.lag(price).over(w))
    cut = (F.col(order) - F.lag(order).over(w) > most_gap) | (move > most_move) | (move < 1 / most_move)
    marked = df.withColumn("__part", F.sum(F.when(F.coalesce(cut, F.lit(False)), 1).otherwise(0)).over(w))
    back = F.max("__part").over(Window.partitionBy(by)) - F.col("__part")
    name = F.when(back > 0, F.concat(F.col(by).cast("string"), F.lit("~"), back.cast("string"))).otherwise(F.col(by).cast("string"))
    return marked.withColumn("series", name).drop("__part")


def top_n(df: DataFrame, by: list[str], score: str, tie: str, n: int, ascending: bool = False) -> DataFrame:
    """O-81: the n best rows of each group, ties by another column, with their place."""
    order = F.col(score).asc_nulls_last() if ascending else F.col(score).desc_nulls_last()
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(order, tie))).filter(F.col("place") <= n)


def hysteresis(ranks: Column, join: int = 20, stay: int = 35) -> Column:
    """O-79: membership along an ordered array of ranks: in at rank <= join, out at rank > stay."""
    step = lambda acc, r: F.struct((F.when(acc["on"], r <= stay).otherwise(r <= join)).alias("on"), F.concat(acc["all"], F.array(F.when(acc["on"], r <= stay).otherwise(r <= join))).alias("all"))
    return F.aggregate(ranks, F.struct(F.lit(False).alias("on"), F.array().cast("array<boolean>").alias("all")), step)["all"]


def rearming(times: Column, values: Column, threshold: float, silent: int) -> Column:
    """O-79: times at which a value reaches the threshold and nothing fired in the `silent` units before."""
    start = F.struct(F.lit(None).cast("long").alias("last"), F.array().cast("array<bigint>").alias("all"))

    def step(acc, x):
        fire = (x["v"] >= threshold) & (acc["last"].isNull() | (x["t"] - acc["last"] >= silent))
        return F.struct(F.when(fire, x["t"]).otherwise(acc["last"]).alias("last"), F.when(fire, F.concat(acc["all"], F.array(x["t"]))).otherwise(acc["all"]).alias("all"))

    pairs = F.zip_with(times, values, lambda t, v: F.struct(t.cast("long").alias("t"), v.alias("v")))
    return F.aggregate(pairs, start, step)["all"]


def missing_sessions(rows: DataFrame, sessions: DataFrame, cap: int) -> DataFrame:
    """O-86: the newest cap sessions that each symbol lacks. The calendar (a row a day) is one array, and a symbol's dates are another."""
    days = sessions.agg(F.collect_set("date").alias("__days"))
    own = rows.groupBy("symbol").agg(F.collect_set("date").alias("__own"))
    lacking = F.slice(F.sort_array(F.array_except("__days", "__own"), asc=False), 1, cap)
    return own.crossJoin(F.broadcast(days)).select("symbol", F.explode(lacking).alias("date"))  # one row
