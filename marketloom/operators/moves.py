"""Chances and outcomes of a move's size over windows after a decision, and the place of a price in the forecast in force."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions import expr as X

#: The least share of a window's volume on one side of the price for that side to have formed.
LEAST_MASS = 0.05


def level(size, up) -> Column:
    """The log distance of a relative move, positive for either side; NULL for a fall of all or more."""
    return F.when(up, F.log1p(size)).when(size < 1, -F.log1p(-size))


def centres(prints: DataFrame, decisions: DataFrame, windows: int) -> DataFrame:
    """What the next bars made of a decision's price: for each decision (symbol, n, price, sigma) and each of the next windows the share of volume above
    the price and, for each side, the volume-weighted distance in sigmas.

    n numbers a symbol's bars from 1; prints: symbol, n, price, volume. Each print meets at most `windows` decisions, by an equality join. Decisions, not prints, are laid out to the bars after them, and a
    window's prints are all of one bar, so prints are shuffled once and summed where they met.
    """
    after = F.explode(F.sequence(F.lit(1), F.lit(windows))).alias("win")
    asked = decisions.select("symbol", "n", "price", "sigma", after).withColumn("__n", F.col("n") + F.col("win"))
    near = prints.select("symbol", F.col("n").alias("__n"), F.col("price").alias("__p"), "volume")
    y = F.ln(X.ratio("__p", "price")) / F.col("sigma")
    j = near.join(asked, ["symbol", "__n"]).select("symbol", "__n", "n", "win", "volume", y.alias("y")).filter("y IS NOT NULL")
    over, under = F.when(F.col("y") > 0, F.col("volume")), F.when(F.col("y") < 0, F.col("volume"))
    none = F.lit(0.0)
    return j.groupBy("symbol", "__n", "n", "win").agg(
        X.ratio(F.sum(F.coalesce(over, none)), F.sum("volume")).alias("mass_up"),
        X.ratio(F.sum(over * F.col("y")), F.sum(over)).alias("centre_up"),
        X.ratio(F.sum(under * -F.col("y")), F.sum(under)).alias("centre_down"),
    ).drop("__n")


def move_chance(rows: DataFrame, size: float, taus: list[float]) -> DataFrame:
    """O-205: the chance that a side forms and that its centre lies beyond a move of the given size.

    rows: up (boolean), sigma, q_centre (quantiles of the distance in sigmas) and q_mass (quantiles of the share of volume above; NULL: the side
    counts as formed). Adds p_forms, p_beyond and p, their product.
    """
    up = F.col("up")
    beyond = 1 - X.cdf_tails("q_centre", X.ratio(level(F.lit(size), up), "sigma"), taus)
    below = lambda x: X.cdf_tails("q_mass", F.lit(x), taus)
    forms = F.when(F.col("q_mass").isNull(), F.lit(1.0)).when(up, 1 - below(LEAST_MASS)).otherwise(below(1 - LEAST_MASS))
    return rows.withColumns({"p_forms": forms, "p_beyond": beyond}).withColumn("p", F.col("p_forms") * F.col("p_beyond"))


def move_outcome(rows: DataFrame, size: float) -> DataFrame:
    """O-205: what happened in a window: formed, reached (1, 0, or NULL where nothing was traded) and the centre's relative move.

    rows: up, sigma, mass_up, centre_up, centre_down.
    """
    up, traded = F.col("up"), F.col("mass_up").isNotNull()
    share = F.when(up, F.col("mass_up")).otherwise(1 - F.col("mass_up"))
    centre = F.when(share >= LEAST_MASS, F.when(up, F.col("centre_up")).otherwise(F.col("centre_down")))
    reached = F.coalesce(centre * F.col("sigma") >= level(F.lit(size), up), F.lit(False))
    return rows.withColumns({
        "formed": F.when(traded, centre.isNotNull().cast("int")),
        "reached": F.when(traded, reached.cast("int")),
        "centre_move": F.expm1(F.when(up, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.col("sigma") * centre),
    })


def cumulative(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """O-205: windows from the first to each one together: the chance of at least one (as if independent), whether any happened, the furthest centre,
    and the likeliest window (the first among equals) with its median and its centre.

    rows: of move_chance and move_outcome; `by` names a decision and a side, `order` its window. Few rows for each decision.
    """
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    best = F.max_by(F.struct(order, F.get("q_centre", F.lit(2)).alias("mid"), "centre_move"), F.struct("p", -F.col(order))).over(upto)
    furthest = F.when(F.col("up"), F.max("centre_move").over(upto)).otherwise(F.min("centre_move").over(upto))
    rows = rows.withColumns({"p_any": 1 - F.product(1 - F.col("p")).over(upto), "formed_any": F.max("formed").over(upto), "reached_any": F.max("reached").over(upto), "furthest": furthest, "__best": best})
    return rows.withColumns({"best_window": F.col(f"__best.{order}"), "best_median": F.col("__best.mid"), "best_centre": F.col("__best.centre_move")}).drop("__best")


def band_position(rows: DataFrame, taus: list[float], switch: int = 15) -> DataFrame:
    """O-138: the forecast in force and where the price and the day's VWAP lie in it: the early run's before a minute of the session, the later one's after.

    rows: minute, q_early, q_late, price, vwap (in the forecasts' unit). Adds stage (NULL without a forecast), mid, spread, band_price and band_vwap.
    """
    q = F.when(F.col("minute") < switch, F.col("q_early")).otherwise(F.col("q_late"))
    rows = rows.withColumn("__q", q)
    form = X.shape("__q", taus)
    return rows.withColumns({
        "stage": F.when(F.col("__q").isNotNull(), F.when(F.col("minute") < switch, 930).otherwise(945)),
        "mid": form["median"],
        "spread": form["iqr"],
        "band_price": X.percentile_of("__q", F.col("price"), taus),
        "band_vwap": X.percentile_of("__q", F.col("vwap"), taus),
    }).drop("__q")
