"""A library of intraday moments and its index: every decision step of every stock-day with ten parameters, searched by boxes of tolerances."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions.expr import ratio
from marketloom.operators import ranks

#: O-240: parameters by name, as columns of a moment (see laid_out); a new one is one entry.
PARAMETERS: dict[str, Callable[[], Column]] = {
    "vwap_vs_prev": lambda: F.ln(ratio("vws", "prev")) / F.col("sigma"),
    "open_vs_prev": lambda: F.ln(ratio("open", "prev")) / F.col("sigma"),
    "move_since_open": lambda: F.ln(ratio("now", "open")) / F.col("sigma"),
    "day_1": lambda: F.col("d1") / F.col("sigma"),
    "day_2": lambda: F.col("d2") / F.col("sigma"),
    "path": lambda: F.ln(ratio("now", "back")) / F.col("sigma"),
    "day_3": lambda: F.col("d3") / F.col("sigma"),
    "rvol": lambda: F.ln(ratio("cv", F.col("nv") * F.col("curve"))),
    "from_high": lambda: F.ln(ratio("now", "high")) / F.col("sigma"),
    "from_low": lambda: F.ln(ratio("now", "low")) / F.col("sigma"),
}
READINGS = ("rod", "bul", "sag")
#: Rows of a leaf that one task meets at most; larger leaves are dealt to slots. Sample that the tree is fitted on.
MOST_LEAF, SAMPLE = 4_096, 16_384


def stock_days(minutes: DataFrame, memory: int = 20, least: int = 5) -> DataFrame:
    """O-170: (symbol, date, open, vwap, volume, prev, d1..d3, sigma, nv): the moves of the three days before, and the spread of moves and
    mean volume of the `memory` days before (NULL with fewer than `least`)."""
    order = F.struct("minute", "vwap")
    day = minutes.groupBy("symbol", "date").agg(F.min_by(F.coalesce("open", "close"), order).alias("open"), ratio(F.sum(F.col("vwap") * F.col("volume")), F.sum("volume")).alias("vwap"), F.sum("volume").alias("volume"))
    w = Window.partitionBy("symbol").orderBy("date")
    past = w.rowsBetween(-memory, -1)
    day = day.withColumn("prev", F.lag("vwap").over(w)).withColumn("d0", F.ln(ratio("vwap", "prev")))
    known = F.count("d0").over(past) >= least
    return day.select(
        "symbol", "date", "open", "vwap", "volume", "prev", *[F.lag("d0", i).over(w).alias(f"d{i}") for i in (1, 2, 3)],
        F.when(known, F.stddev_samp("d0").over(past)).alias("sigma"), F.when(known, F.avg("volume").over(past)).alias("nv"),
    )


def laid_out(minutes: DataFrame, days: DataFrame, curve: DataFrame, first: int, last: int, look_back: int) -> DataFrame:
    """One row for each stock-day and step (first to last): what the parameters are made of, the readings, and the day's columns.

    minutes: dense steps with `step` (number of the step in the day). curve: step, curve (mean share of a day's volume up to it). All windows share one partition
    (symbol, date), so minutes are shuffled once.
    """
    day = Window.partitionBy("symbol", "date").orderBy("step")
    upto, after = day.rowsBetween(Window.unboundedPreceding, 0), day.rowsBetween(1, Window.unboundedFollowing)
    pv = F.col("vwap") * F.col("volume")
    rows = minutes.select(
        "symbol", "date", "step", F.col("close").alias("now"), F.coalesce(F.lag("close", look_back).over(day), F.first("close").over(upto)).alias("back"),
        ratio(F.sum(pv).over(upto), F.sum("volume").over(upto)).alias("vws"), F.min("low").over(upto).alias("low"), F.max("high").over(upto).alias("high"), F.sum("volume").over(upto).alias("cv"),
        ratio(F.sum(pv).over(after), F.sum("volume").over(after)).alias("rest"), F.max("high").over(after).alias("top"), F.min("low").over(after).alias("bottom"),
    ).filter(F.col("step").between(first, last))
    own = days.select("symbol", "date", "open", "prev", "d1", "d2", "d3", "sigma", "nv", (F.col("vwap") * F.col("volume")).alias("dollars"))
    return rows.join(own, ["symbol", "date"]).join(F.broadcast(curve), "step")  # a row for each step of a day


def moments(laid: DataFrame, sessions: DataFrame, parameters: dict[str, Callable[[], Column]] | None = None) -> DataFrame:
    """O-171: (symbol, date, sess, step, now, sigma, nv, dollars, parameters, readings) of the rows of which all are known and sigma is positive.

    sessions: date, sess. Readings: the rest-of-day VWAP, the highest high and the lowest low after now, in sigmas.
    """
    chosen = {k: f() for k, f in (parameters or PARAMETERS).items()}
    told = {k: F.ln(ratio(c, "now")) / F.col("sigma") for k, c in (("rod", "rest"), ("bul", "top"), ("sag", "bottom"))}
    out = laid.filter("sigma > 0 AND now > 0").join(F.broadcast(sessions), "date")  # the calendar
    out = out.select("symbol", "date", "sess", "step", "now", "sigma", "nv", "dollars", *[c.alias(k) for k, c in (chosen | told).items()])
    return out.dropna(subset=[*chosen, *told])


class CellTree:
    """A complete binary tree over the axes of a table: each node cuts its sample at the median of the axis that is widest against the boxes that will be asked for.

    Leaves so have about equal numbers of rows wherever the rows are dense. It is only an index: any tree gives the same answers.
    """

    def __init__(self, sample: np.ndarray, widths: np.ndarray, depth: int):
        self.depth = depth
        self.axes, self.cuts = [0] * (1 << depth), [0.0] * (1 << depth)
        stack = [(1, sample)]
        while stack:
            node, x = stack.pop()
            if node >= 1 << depth:
                continue
            if len(x):
                spread = (np.quantile(x, 0.9, axis=0) - np.quantile(x, 0.1, axis=0)) / np.maximum(widths, 1e-12)
                self.axes[node] = int(spread.argmax())
                self.cuts[node] = float(np.median(x[:, self.axes[node]]))
            right = x[:, self.axes[node]] >= self.cuts[node] if len(x) else np.zeros(0, bool)
            stack += [(2 * node, x[~right]), (2 * node + 1, x[right])]

    def _at(self, node: Column) -> tuple[Column, Column]:
        return F.get(F.array(*[F.lit(a) for a in self.axes]), node), F.get(F.array(*[F.lit(c) for c in self.cuts]), node)

    def leaf(self, x: Column) -> Column:
        """The leaf of a point (an array by axis)."""

        def down(node: Column, _: Column) -> Column:
            axis, cut = self._at(node)
            return node * 2 + (F.get(x, axis) >= cut).cast("int")

        return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(1), down) if self.depth else F.lit(1)

    def leaves(self, low: Column, high: Column) -> Column:
        """The leaves that a box meets, as an array."""

        def down(nodes: Column, _: Column) -> Column:
            def both(node: Column) -> Column:
                axis, cut = self._at(node)
                left, right = F.when(F.get(low, axis) < cut, node * 2), F.when(F.get(high, axis) >= cut, node * 2 + 1)
                return F.array_compact(F.array(left, right))

            return F.flatten(F.transform(nodes, both))

        return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.array(F.lit(1)), down) if self.depth else F.array(F.lit(1))


def spreads(library: DataFrame, parameters: list[str]) -> dict[str, float]:
    """O-55: the robust spread (IQR / 1.349) of each parameter, 1 where it is 0; exact, by slots. One number a parameter comes to the driver."""
    long = library.select(F.posexplode(F.array(*parameters)).alias("i", "x"))
    rows = ranks.quantiles(long, ["i"], "x", [0.25, 0.75]).collect()
    return {parameters[r.i]: (r.q[1] - r.q[0]) / 1.349 or 1.0 for r in rows}


def search(queries: DataFrame, library: DataFrame, parameters: list[str], dial: float, window: int, apart: int, same_symbol: bool = False, least_dollars: float = 0.0) -> DataFrame:
    """O-172, O-173: (query columns q_symbol, q_date, q_step; m_symbol, m_date, m_step, w): moments of the `window` sessions strictly before a query's, at
    most `apart` steps of the day away, whose parameters all lie within dial x spread, weighted by the product of 1 - z^2.

    library is used several times, so it should be a written table. Both sides meet by the leaf of a CellTree over the parameters, the session and the step; a leaf with more than MOST_LEAF
    rows is dealt to slots, and a query goes to all slots of each leaf that its box meets, so that no task gets more than about a slot's rows of a hot cell.
    """
    tolerance = {p: dial * s for p, s in spreads(library, parameters).items()}
    if not tolerance:
        return queries.sparkSession.createDataFrame([], "q_symbol string, q_date date, q_step int, m_symbol string, m_date date, m_step int, w double")
    axes = [*parameters, "sess", "step"]
    total = library.count()
    depth = int(min(10, max(0, np.ceil(np.log2(max(total, 1) / MOST_LEAF * 4)))))
    drawn = library.orderBy(F.xxhash64("symbol", "date", "step"), "symbol", "date", "step").select(*axes).limit(SAMPLE).toArrow()
    sample = np.column_stack([c.to_numpy().astype(float) for c in drawn.columns])
    tree = CellTree(sample, np.array([2 * tolerance[p] for p in parameters] + [window, 2 * apart + 1], float), depth)
    point = F.array(*[F.col(a).cast("double") for a in axes])
    low = F.array(*[F.col(p) - tolerance[p] for p in parameters], (F.col("sess") - window).cast("double"), (F.col("step") - apart).cast("double"))
    high = F.array(*[F.col(p) + tolerance[p] for p in parameters], (F.col("sess") - 1).cast("double"), (F.col("step") + apart).cast("double"))
    held = library.filter(F.col("dollars") >= least_dollars).withColumn("__leaf", tree.leaf(point))
    slots = held.groupBy("__leaf").agg(F.ceil(F.count("*") / MOST_LEAF).cast("int").alias("__slots"))
    of = F.broadcast(slots)  # at most 1,024 rows
    mine = held.join(of, "__leaf").withColumn("__slot", F.pmod(F.xxhash64("symbol", "date", "step"), F.col("__slots")).cast("int"))
    mine = mine.select("__leaf", "__slot", F.col("symbol").alias("m_symbol"), F.col("date").alias("m_date"), F.col("step").alias("m_step"), F.col("sess").alias("m_sess"), *[F.col(p).alias(f"m_{p}") for p in parameters])
    asked = queries.withColumn("__leaf", F.explode(tree.leaves(low, high))).join(of, "__leaf").withColumn("__slot", F.explode(F.sequence(F.lit(0), F.col("__slots") - 1)))
    asked = asked.select("__leaf", "__slot", F.col("symbol").alias("q_symbol"), F.col("date").alias("q_date"), F.col("step").alias("q_step"), F.col("sess").alias("q_sess"), *parameters)
    near = (F.col("m_sess") < F.col("q_sess")) & (F.col("m_sess") >= F.col("q_sess") - window) & (F.abs(F.col("m_step") - F.col("q_step")) <= apart)
    if same_symbol:
        near = near & (F.col("m_symbol") == F.col("q_symbol"))
    weight = F.lit(1.0)
    for p in parameters:
        z = F.abs(F.col(f"m_{p}") - F.col(p)) / tolerance[p]
        near, weight = near & (z < 1), weight * (1 - z * z)
    return asked.join(mine, ["__leaf", "__slot"]).filter(near).select("q_symbol", "q_date", "q_step", "m_symbol", "m_date", "m_step", weight.alias("w"))
