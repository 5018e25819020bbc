"""Profiles of time and volume at price as they stood at each decision: held time is first cut into steps of the day and counted by bin, so a decision meets a day's few cells, not its polls."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions.expr import ratio

DAY = ["symbol", "date"]


def _bin(price, width: float):
    """The bin of a price: its log distance from the day's reference in sigmas, to the nearest multiple of width."""
    return F.floor(ratio(F.ln(ratio(price, "ref")), F.col("sigma")) / width + 0.5)


def cells(series: DataFrame, scale: DataFrame, opens: int, step: int, width: float, half_life: float) -> DataFrame:
    """(symbol, date, step_end, bin) with the seconds that the price stood there in that step, the volume traded, and the seconds weighted by 2^-(age / half_life) at the step's end.

    series: symbol, date, ts, price, traded; scale: symbol, date, ref, sigma. A price holds from its poll (the open, for the base) to the next one; the last one for no time. Time is in seconds since the epoch,
    steps are multiples of `step` seconds; an interval over several steps counts in each. Days without a reference or sigma above 0 have no cells.
    """
    by = Window.partitionBy(*DAY).orderBy("ts")
    open_s = F.unix_seconds(F.col("date").cast("timestamp")) + 60 * opens
    second = lambda t: F.unix_micros(t) / 1e6
    held = series.withColumn("__to", second(F.lead("ts").over(by))).withColumn("__from", F.greatest(second(F.col("ts")), open_s.cast("double")))
    held = held.withColumn("__to", F.greatest(F.coalesce("__to", "__from"), F.col("__from")))
    held = held.join(scale.filter("ref > 0 AND sigma > 0"), DAY).withColumn("bin", _bin("price", width))
    first, last = F.ceil(F.col("__from") / step), F.greatest(F.ceil(F.col("__to") / step), F.ceil(F.col("__from") / step))
    cut = held.select(*DAY, "bin", "__from", "__to", "traded", first.alias("__first"), F.explode(F.sequence(first, last)).alias("__k"))
    end = F.col("__k") * step
    a, b = F.greatest(F.col("__from"), (end - step).cast("double")), F.least(F.col("__to"), end.cast("double"))
    decay = lambda t: F.exp((t - end) * (math.log(2) / half_life))
    weighted = (decay(b) - decay(a)) * (half_life / math.log(2))
    rows = cut.select(*DAY, "bin", end.cast("long").alias("step_end"), F.greatest(b - a, F.lit(0.0)).alias("s"), F.greatest(weighted, F.lit(0.0)).alias("w"), F.when(F.col("__k") == F.col("__first"), F.col("traded")).otherwise(0.0).alias("v"))
    return rows.groupBy(*DAY, "step_end", "bin").agg(F.sum("s").alias("seconds"), F.sum("w").alias("weighted"), F.sum("v").alias("volume"))


def profiles(points: DataFrame, cells: DataFrame, width: float, half_life: float, near: float = 0.1, move: float = 0.01) -> DataFrame:
    """O-144: of the cells up to each point: where the price stood longest (poc, in sigmas from now; the lower of equal bins), the share of time above now and at now's bin, each also with time fading by half_life, acceptance (share of time over
    share of volume at now's bin), the share of time within `near` sigmas of the highest and of the lowest bin, and the volume that lies up to `move` above and below, as a share of a typical day's.

    points: symbol, date, at (at a step's end), price, ref, sigma, typical. Points without a cell have no row.
    """
    p = points.filter("ref > 0 AND sigma > 0").select(*DAY, "at", F.unix_seconds("at").alias("__at"), _bin("price", width).alias("now"), F.greatest(F.floor(F.log1p(F.lit(move)) / F.col("sigma") / width + 0.5), F.lit(1)).alias("reach"), "typical")
    fade = F.exp((F.col("step_end") - F.col("__at")) * (math.log(2) / half_life))
    j = p.join(cells, DAY).filter("step_end <= __at AND now IS NOT NULL")
    keys = [*DAY, "at", "now", "reach", "typical"]
    h = j.groupBy(*keys, "bin").agg(F.sum("seconds").alias("s"), F.sum(F.col("weighted") * fade).alias("w"), F.sum("volume").alias("v"))
    whole = Window.partitionBy(*DAY, "at")
    seen = F.when(F.col("s") > 0, F.col("bin"))
    h = h.withColumns({"__hi": F.max(seen).over(whole), "__lo": F.min(seen).over(whole)})
    off, margin = F.col("bin") - F.col("now"), int(math.floor(near / width + 1e-9))
    part = lambda on, c: F.coalesce(F.sum(F.when(on, F.col(c))), F.lit(0.0))
    share = lambda on, c: ratio(part(on, c), F.sum(c))
    poc = lambda c: F.max_by(off, F.struct(F.round(c, 6), -F.col("bin"))) * width
    out = {}
    for suffix, c in (("", "s"), ("_faded", "w")):
        out |= {f"poc{suffix}": poc(c), f"time_above{suffix}": share(off > 0, c), f"dwell{suffix}": share(off == 0, c)}
    out |= {"accept": ratio(share(off == 0, "s"), share(off == 0, "v")), "linger_high": share(F.col("bin") >= F.col("__hi") - margin, "s"), "linger_low": share(F.col("bin") <= F.col("__lo") + margin, "s")}
    out |= {"volume_up": ratio(part((off > 0) & (off <= F.col("reach")), "v"), "typical"), "volume_down": ratio(part((off < 0) & (off >= -F.col("reach")), "v"), "typical")}
    return h.groupBy(*keys).agg(*[c.alias(n) for n, c in out.items()]).drop("now", "reach", "typical")
