"""As-of, snap, range and proximity joins.

An as-of join is a union and one window: both sides are shuffled once by the key and the last (or next) right row is carried along.
There is no nested loop, and sides may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, right_on: str | None = None, direction: str = "backward", strict: bool = False, tolerance=None, prefix: str = "") -> DataFrame:
    """O-22..O-27, O-33: each left row with the nearest right row at or before (backward) or after (forward) it.

    Columns of right other than `by` are added with a prefix; NULL without a match. strict leaves out equal times. tolerance is the
    largest distance. right must be unique in (by, on): reduce it before.
    """
    right_on = right_on or on
    extra = [c for c in right.columns if c not in by]
    left_cols = left.columns
    row = lambda names, df: F.struct(*[df[c].alias(c) for c in names])
    right_type = right.select(row(extra, right).alias("r")).schema["r"].dataType
    first = (direction == "backward") != strict  # on equal times the right row goes first
    a = left.select(*by, F.col(on).alias("__on"), F.lit(1).alias("__side"), row(left_cols, left).alias("__left"), F.lit(None).cast(right_type).alias("__right"))
    b = right.select(*by, F.col(right_on).alias("__on"), F.lit(0).alias("__side"), F.lit(None).cast(a.schema["__left"].dataType).alias("__left"), row(extra, right).alias("__right"))
    if direction == "backward":
        order = [F.col("__on").asc(), F.col("__side").asc() if first else F.col("__side").desc()]
    else:
        order = [F.col("__on").desc(), F.col("__side").desc() if strict else F.col("__side").asc()]
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = a.unionByName(b).filter(F.col("__on").isNotNull()).withColumn("__hit", F.last("__right", ignorenulls=True).over(w)).filter("__side = 1")
    if tolerance is not None:
        found = found.withColumn("__hit", F.when(F.abs(F.col(f"__hit.{right_on}") - F.col("__on")) <= tolerance, F.col("__hit")))
    return found.select("__left.*", *[F.col(f"__hit.{c}").alias(prefix + c) for c in extra])


def snap_to_session(df: DataFrame, date: str, sessions: DataFrame, name: str = "day_idx", direction: str = "forward") -> DataFrame:
    """O-28: index of the first session on or after a date (or the last on or before it).

    The calendar grows by one row a day, so it is laid out as one lookup row for each calendar day and broadcast. However far a date lies before the first
    session (or, backward, after the last one), that session is its own; beyond the calendar's other end there is none (NULL).
    """
    s = sessions.select("date", "day_idx")
    w = Window.orderBy("date")
    if direction == "forward":
        spans = s.withColumn("__from", F.coalesce(F.date_add(F.lag("date").over(w), 1), F.col("date"))).withColumn("__to", F.col("date"))
    else:
        spans = s.withColumn("__from", F.col("date")).withColumn("__to", F.coalesce(F.date_sub(F.lead("date").over(w), 1), F.col("date")))
    days = spans.select(F.explode(F.sequence("__from", "__to")).alias("__day"), F.col("day_idx").alias(name))
    edge = s.agg(*([F.min("date").alias("__edge"), F.min_by("day_idx", "date").alias("__out")] if direction == "forward" else [F.max("date").alias("__edge"), F.max_by("day_idx", "date").alias("__out")]))
    found = df.join(F.broadcast(days), F.col(date) == F.col("__day"), "left").crossJoin(F.broadcast(edge))  # edge is one row
    beyond = F.col(date) < F.col("__edge") if direction == "forward" else F.col(date) > F.col("__edge")
    return found.withColumn(name, F.when(beyond, F.col("__out")).otherwise(F.col(name))).drop("__day", "__edge", "__out")


def range_product(left: DataFrame, events: DataFrame, by: str, at: str, event_at: str, factor: str, name: str = "factor") -> DataFrame:
    """O-29: product of the factors of all events after each left row.

    Suffix products of an event table replace the range join: an as-of join forward then finds the product of the event that
    comes next and all after it. NULL where no event follows.
    """
    later = Window.partitionBy(by).orderBy(F.col(event_at).desc()).rowsBetween(Window.unboundedPreceding, 0)
    daily = events.groupBy(by, event_at).agg(F.sum(F.ln(factor)).alias("__ln"))
    suffix = daily.select(by, F.col(event_at).alias("__event_at"), F.exp(F.sum("__ln").over(later)).alias(name))
    return asof_join(left, suffix, [by], at, "__event_at", "forward", strict=True).drop("__event_at")


def near_join(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, within: int, how: str = "inner") -> DataFrame:
    """O-31: pairs of rows with equal `by` at most `within` seconds apart; how="left" keeps left rows without a pair.

    Times fall into buckets of that width and the right side is laid out over its own and both neighbouring buckets, so the join is
    an equality. right's columns must not clash with left's other than in `by`.
    """
    bucket = lambda c: F.floor(F.unix_seconds(c) / within)
    a = left.withColumn("__bucket", bucket(F.col(left_ts)))
    b = right.withColumn("__right_bucket", F.explode(F.array(*[bucket(F.col(right_ts)) + i for i in (-1, 0, 1)]))).withColumnsRenamed({c: f"__right_{c}" for c in by})
    near = F.abs(F.unix_micros(right_ts) - F.unix_micros(left_ts)) <= within * 1_000_000
    for c in [*by, "bucket"]:
        near &= F.col(c if c in by else "__bucket") == F.col(f"__right_{c}")
    return a.join(b, near, how).drop("__bucket", "__right_bucket", *[f"__right_{c}" for c in by])


def in_window(points: DataFrame, windows: DataFrame, at: str, start: str, end: str, strict: bool = False) -> DataFrame:
    """O-32, O-14: points with the window [start, end) that holds them, NULL columns if none. Windows must not overlap.

    Windows are laid out over the days that they touch, so the join is an equality on the day and a point meets one day's windows. strict
    fails on a point in no window, as publishing a finished day must.
    """
    last = F.to_date(F.timestamp_add("MICROSECOND", F.lit(-1), F.col(end)))
    laid = windows.withColumn("__day", F.explode(F.sequence(F.to_date(start), last)))
    day = F.to_date(at)
    inside = (day == F.col("__day")) & (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))
    found = points.join(laid, inside, "left").drop("__day")
    if strict:
        found = found.withColumn(start, F.when(F.col(start).isNull(), F.raise_error(F.lit("a point lies in no window"))).otherwise(F.col(start)))
    return found


def latest(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """O-71, O-20f: the first row of each key in an order that leaves no ties."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
