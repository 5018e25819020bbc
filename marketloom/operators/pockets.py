"""Pockets: where the later volume of matched moments traded, as a smoothed density over log2 of the time ahead and the price in sigmas.

A map has NX x NY cells and is one array a query (a fixed size), so smoothing and levels run inside the JVM without a shuffle. Blobs are labelled relationally, for all
queries at once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.expr import ratio
from marketloom.staging import written

# The map, the shares of the pockets, and the smoothing in cells.
NX, NY, YL = 36, 32, 4.0
LEVELS = (0.5, 0.8, 0.95)
BANDWIDTH = 0.7
FLOOR = 1e-9
QUERY = ["q_symbol", "q_date", "q_step"]


def moment_cells(moments: DataFrame, minutes: DataFrame, steps: int) -> DataFrame:
    """(symbol, date, step, cells): for each moment the mass (volume / normal volume) of each cell that its later steps fall in, as an array of (cell, mass).

    x counts log2 of the steps ahead plus one, in NX parts up to a day of `steps`; y the step's VWAP against the price now, in NY parts of +-YL sigmas, outer ones clipped. Only
    moments of the same stock-day meet its steps: an equality join.
    """
    later = minutes.filter("volume > 0").select("symbol", "date", F.col("step").alias("__s"), "vwap", "volume")
    j = moments.select("symbol", "date", "step", "now", "sigma", "nv").join(later, ["symbol", "date"]).filter(F.col("__s") > F.col("step"))
    ahead = F.col("__s") - F.col("step") - 1
    y = F.ln(ratio("vwap", "now")) / F.col("sigma")
    xb = F.least(F.floor(F.log2(ahead + 1) / math.log2(steps + 1) * NX), F.lit(NX - 1))
    yb = F.least(F.greatest(F.floor((y + YL) / (2 * YL) * NY), F.lit(0)), F.lit(NY - 1))
    per = j.filter(y.isNotNull()).groupBy("symbol", "date", "step", (xb * NY + yb).cast("int").alias("cell")).agg(F.sum(F.col("volume") / F.col("nv")).alias("mass"))
    return per.groupBy("symbol", "date", "step").agg(F.collect_list(F.struct("cell", "mass")).alias("cells"))  # at most `steps` of them


def grids(found: DataFrame, cells: DataFrame) -> DataFrame:
    """O-174: (query, grid): the matches' later volume by cell, weighted, as an array of NX * NY."""
    m = cells.select(F.col("symbol").alias("m_symbol"), F.col("date").alias("m_date"), F.col("step").alias("m_step"), "cells")
    rows = found.join(m, ["m_symbol", "m_date", "m_step"]).select(*QUERY, "w", F.inline("cells"))
    mass = rows.groupBy(*QUERY, "cell").agg(F.sum(F.col("w") * F.col("mass")).alias("mass"))
    per = mass.groupBy(*QUERY).agg(F.map_from_entries(F.collect_list(F.struct("cell", "mass"))).alias("m"))
    return per.select(*QUERY, F.transform(F.sequence(F.lit(0), F.lit(NX * NY - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("grid"))


def kernel(bandwidth: float = BANDWIDTH) -> list[float]:
    r = int(4 * bandwidth + 0.5)
    k = [math.exp(-0.5 * (i / bandwidth) ** 2) for i in range(-r, r + 1)]
    return [x / sum(k) for x in k]


def _blurred(grid: str, along_x: bool, k: list[float]) -> Column:
    """A grid blurred along one axis, edges mirrored (the outer cell counts again)."""
    r, n = len(k) // 2, NX if along_x else NY

    def cell(i: Column) -> Column:
        x, y = F.floor(i / NY).cast("int"), i % NY
        out = F.lit(0.0)
        for j, weight in enumerate(k):
            at = (x if along_x else y) + (j - r)
            at = F.when(at < 0, -at - 1).when(at >= n, 2 * n - 1 - at).otherwise(at)
            out = out + F.lit(weight) * F.get(F.col(grid), at * NY + y if along_x else x * NY + at)
        return out

    return F.transform(F.sequence(F.lit(0), F.lit(NX * NY - 1)), cell)


def densities(maps: DataFrame, bandwidth: float = BANDWIDTH) -> DataFrame:
    """O-175: (query, q): maps smoothed along both axes in two passes, with a floor, summing to 1."""
    k = kernel(bandwidth)
    once = maps.withColumn("__x", _blurred("grid", True, k))
    twice = once.withColumn("__q", F.transform(_blurred("__x", False, k), lambda v: v + FLOOR))
    total = F.array(F.aggregate("__q", F.lit(0.0), lambda a, v: a + v))  # an array's element, so that it isn't summed again for each cell
    return twice.select(*QUERY, F.get(F.transform(total, lambda t: F.transform("__q", lambda v: v / t)), F.lit(0)).alias("q"))


def levels(dense: DataFrame) -> DataFrame:
    """O-176: adds levels: for each share in LEVELS the greatest density at and above which cells hold the share together."""
    s = F.reverse(F.array_sort("q"))
    start = F.struct(F.lit(0.0).alias("held"), F.array(*[F.lit(None).cast("double") for _ in LEVELS]).alias("at"))

    def step(a: Column, v: Column) -> Column:
        held = a["held"] + v
        return F.struct(held.alias("held"), F.array(*[F.when(F.get(a["at"], F.lit(i)).isNull() & (held >= share), v).otherwise(F.get(a["at"], F.lit(i))) for i, share in enumerate(LEVELS)]).alias("at"))

    return dense.withColumn("levels", F.transform(F.aggregate(s, start, step)["at"], lambda v: F.coalesce(v, F.array_min("q"))))


def blobs(cells: DataFrame, by: list[str], width: int) -> DataFrame:
    """O-177: (by, n_blobs, n_cells): numbers of 4-connected blobs of marked cells (x, y; one row each) for all groups at once. width is more than the greatest y.

    Neighbours are equality joins. Each round, roots hook to the least root next to them, hooks are followed to their ends by jumping (log steps), and
    labels take their hook's root, until no two neighbours differ.
    """
    nodes = written(cells.select(*by, (F.col("x") * width + F.col("y")).cast("int").alias("cell"), "x", "y").distinct(), "blob-cells")
    here = nodes.select(*by, F.col("cell").alias("a"), "x", "y")
    steps = F.explode(F.array(F.struct((F.col("x") + 1).alias("x"), F.col("y").alias("y")), F.struct(F.col("x").alias("x"), (F.col("y") + 1).alias("y"))))
    pairs = here.select(*by, "a", steps.alias("to")).select(*by, "a", "to.x", "to.y").join(nodes.select(*by, "x", "y", F.col("cell").alias("b")), [*by, "x", "y"]).select(*by, "a", "b")
    edges = written(pairs, "blob-edges")
    labels = nodes.select(*by, "cell", F.col("cell").alias("label"))
    while not edges.isEmpty():
        up, low = F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")
        hooks = written(edges.select(*by, up, low).groupBy(*by, "node").agg(F.min("to").alias("to")), "blob-hooks")
        while True:
            further = hooks.select(*by, F.col("node").alias("to"), F.col("to").alias("next"))
            jumped = written(hooks.join(further, [*by, "to"], "left").select(*by, "node", F.coalesce("next", "to").alias("to"), F.isnotnull("next").alias("moved")), "blob-hooks")
            hooks = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        to = lambda c: hooks.select(*by, F.col("node").alias(c), F.col("to").alias(f"__{c}"))
        labels = written(labels.join(to("label"), [*by, "label"], "left").select(*by, "cell", F.coalesce("__label", "label").alias("label")), "blob-labels")
        renamed = edges.join(to("a"), [*by, "a"], "left").join(to("b"), [*by, "b"], "left").select(*by, F.coalesce("__a", "a").alias("a"), F.coalesce("__b", "b").alias("b"))
        edges = written(renamed.filter("a <> b").distinct(), "blob-edges")
    return labels.groupBy(*by).agg(F.count_distinct("label").alias("n_blobs"), F.count("*").alias("n_cells"))


def marked(leveled: DataFrame, share: int) -> DataFrame:
    """(query, x, y) of the cells of the pocket of LEVELS[share]."""
    cells = leveled.select(*QUERY, F.get("levels", F.lit(share)).alias("__l"), F.posexplode("q").alias("i", "v")).filter(F.col("v") >= F.col("__l"))
    return cells.select(*QUERY, F.floor(F.col("i") / NY).cast("int").alias("x"), (F.col("i") % NY).alias("y"))


def pocket_scores(leveled: DataFrame, cells: DataFrame) -> DataFrame:
    """O-178, O-181: (query, cover_50, cover_80, cover_95, log_score): the share of what a query's own later volume put into each pocket, and its mean log density."""
    own = cells.select(F.col("symbol").alias("q_symbol"), F.col("date").alias("q_date"), F.col("step").alias("q_step"), "cells")
    j = leveled.join(own, QUERY).withColumn("__t", F.aggregate("cells", F.lit(0.0), lambda a, c: a + c["mass"]))
    total = lambda f: F.aggregate("cells", F.lit(0.0), lambda a, c: a + c["mass"] * f(F.get("q", c["cell"])))
    covers = [ratio(total(lambda v, i=i: (v >= F.get("levels", F.lit(i))).cast("double")), "__t").alias(f"cover_{int(100 * s)}") for i, s in enumerate(LEVELS)]
    return j.select(*QUERY, *covers, ratio(total(F.ln), "__t").alias("log_score"))
