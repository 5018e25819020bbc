"""What happens after a decision: touches, races, averages, occupancy, resistance and normal volumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.functions.expr import ratio


def _after(minutes: DataFrame, entries: DataFrame, horizon: int, columns: list[str]) -> DataFrame:
    """Each entry (symbol, date, at, entry) with the minutes of its day that follow within the horizon: at most a day's minutes each."""
    at = F.unix_seconds("at")
    return entries.join(minutes.select("symbol", "date", "minute", *columns), ["symbol", "date"]).filter((F.unix_seconds("minute") > at) & (F.unix_seconds("minute") <= at + 60 * horizon))


def touches(minutes: DataFrame, entries: DataFrame, horizon: int, move: float) -> DataFrame:
    """O-150, O-160, O-161: first minute at which the price is up or down by a move, and which came first.

    race: win, loss, both (in the same minute), neither.
    """
    j = _after(minutes, entries, horizon, ["high", "low", "volume"])
    up, down = F.col("high") >= F.col("entry") * (1 + move), F.col("low") <= F.col("entry") * (1 - move)
    g = j.groupBy("symbol", "date", "at").agg(F.min(F.when(up, F.col("minute"))).alias("up_at"), F.min(F.when(down, F.col("minute"))).alias("down_at"))
    race = F.when(F.col("up_at").isNull() & F.col("down_at").isNull(), "neither").when(F.col("up_at") == F.col("down_at"), "both").when(F.col("down_at").isNull() | (F.col("up_at") < F.col("down_at")), "win").otherwise("loss")
    return g.withColumn("race", race)


def volume_until_touch(minutes: DataFrame, entries: DataFrame, horizon: int, move: float) -> DataFrame:
    """O-150: share of the horizon's volume traded before the price has moved either way (1 if it never does)."""
    hit = touches(minutes, entries, horizon, move).select("symbol", "date", "at", F.least("up_at", "down_at").alias("hit_at"))
    j = _after(minutes, entries, horizon, ["volume"]).join(hit, ["symbol", "date", "at"])
    before = F.col("hit_at").isNull() | (F.col("minute") < F.col("hit_at"))
    return j.groupBy("symbol", "date", "at").agg(F.coalesce(ratio(F.sum(F.when(before, F.col("volume")).otherwise(0.0)), F.sum("volume")), F.lit(1.0)).alias("share"))


def averages(minutes: DataFrame, entries: DataFrame, bins: list[tuple[int, int]]) -> DataFrame:
    """O-154, O-149: VWAP, mean close, last close and volume of each duration bin (from, to] in minutes after the entry."""
    j = _after(minutes, entries, max(b for _, b in bins), ["close", "vwap", "volume"])
    age = (F.unix_seconds("minute") - F.unix_seconds("at")) / 60
    which = F.when(F.lit(False), F.lit(0))
    for i, (a, b) in enumerate(bins):
        which = which.when((age > a) & (age <= b), F.lit(i))
    return j.withColumn("bin", which).filter("bin IS NOT NULL").groupBy("symbol", "date", "at", "bin").agg(ratio(F.sum(F.col("vwap") * F.col("volume")), F.sum("volume")).alias("vwap"), F.avg("close").alias("twap"), F.max_by("close", "minute").alias("last"), F.sum("volume").alias("volume"))


def bin_targets(minutes: DataFrame, entries: DataFrame, bins: list[tuple[int, int | None]], closes: int, least_mass: float = 0.05) -> DataFrame:
    """O-149: the pocket of each duration bin (from, to] in minutes after an entry, clipped at the close; to = None reaches the close. One row for each entry and bin.

    minutes: symbol, date, minute, vwap, volume, normal (may be NULL); entries: symbol, date, at, entry, sigma; closes: minute of the day. Places are log moves from the entry in sigmas. bulge and sag:
    volume-weighted moves up and down; cm_up, cm_dn: their centres where that side has at least least_mass of the volume; rvol: log of volume + 1 over normal volume + 1; pi_up, pi_dn: bulge and sag times
    the volume's ratio to the normal one, by minute (NULL without a normal volume). cut: the close comes before the bin ends. A bin without volume has NULL for its pocket, not for rvol.
    """
    at, left = F.unix_seconds("at"), F.lit(closes) - (F.hour("at") * 60 + F.minute("at"))
    spans = F.array(*[F.struct(F.lit(i + 1).alias("bin"), F.lit(a).alias("a"), F.least(F.lit(b), left).alias("b"), (F.lit(b) > left if b is not None else F.lit(False)).alias("cut")) for i, (a, b) in enumerate(bins)])
    asked = entries.select("symbol", "date", "at", "entry", "sigma", F.explode(spans).alias("x")).select("symbol", "date", "at", "entry", "sigma", "x.*")
    m = minutes.select(F.col("symbol").alias("__s"), F.col("date").alias("__d"), "minute", "vwap", "volume", "normal")
    inside = (F.unix_seconds("minute") > at + 60 * F.col("a")) & (F.unix_seconds("minute") <= at + 60 * F.col("b"))
    j = asked.join(m, (F.col("symbol") == F.col("__s")) & (F.col("date") == F.col("__d")) & inside, "left")
    j = j.withColumn("d", ratio(F.ln(ratio("vwap", "entry")), F.col("sigma")))
    j = j.withColumn("v", F.when(F.col("d").isNotNull(), F.col("volume")).otherwise(0.0))
    part = lambda on, x: F.coalesce(F.sum(F.when(on, x)), F.lit(0.0))
    up, down, d, v = F.col("d") > 0, F.col("d") < 0, F.col("d"), F.col("v")
    g = j.groupBy("symbol", "date", "at", "bin", "a", "b", "cut").agg(
        F.sum("v").alias("volume"), F.coalesce(F.sum("normal"), F.lit(0.0)).alias("__n"), part(up, d * v).alias("__u"), part(down, -d * v).alias("__d"), part(up, v).alias("__mu"), part(down, v).alias("__md"))
    vol = F.col("volume")
    g = g.withColumns({"bulge": ratio("__u", vol), "sag": ratio("__d", vol), "mass_up": ratio("__mu", vol), "mass_dn": ratio("__md", vol), "mins": F.greatest(F.col("b") - F.col("a"), F.lit(0)), "times": ratio(vol, "__n")})
    centre = lambda side, mass: F.when(F.col(mass) >= least_mass, ratio(side, mass))
    return g.select(
        "symbol", "date", "at", "bin", "volume", "bulge", "sag", "mass_up", "mass_dn", centre("bulge", "mass_up").alias("cm_up"), centre("sag", "mass_dn").alias("cm_dn"), (F.col("bulge") - F.col("sag")).alias("net"),
        F.ln((vol + 1) / (F.col("__n") + 1)).alias("rvol"), ratio(F.col("bulge") * F.col("times"), "mins").alias("pi_up"), ratio(F.col("sag") * F.col("times"), "mins").alias("pi_dn"), F.col("cut").cast("int").alias("cut"), "mins",
    )


def peak_bins(targets: DataFrame) -> DataFrame:
    """O-150: the bin with the most of pi_up, and of pi_dn, of each entry (the first of equal ones; NULL where no bin has any)."""
    best = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(c), -F.col("bin"))))
    return targets.groupBy("symbol", "date", "at").agg(*[(-best(f"pi_{s}")["col2"]).alias(f"peak_{s}") for s in ("up", "dn")])


def row_targets(minutes: DataFrame, entries: DataFrame, horizon: int, closes: int, move: float = 0.01, race: float = 0.5) -> DataFrame:
    """O-150: of the minutes within the horizon (and before the close): when half of the upward and of the downward mass has come, the share of a typical day's volume until the price touched +-move (1 if it never does), which
    of +-race sigmas came first (0 up, 1 down, 2 neither or both at once), and the pocket of them all. An entry without a later minute has no row.

    minutes: symbol, date, minute, high, low, vwap, volume; entries: symbol, date, at, entry, sigma, typical. Times are minutes after the entry.
    """
    j = _after(minutes, entries, horizon, ["high", "low", "vwap", "volume"]).filter(F.hour("minute") * 60 + F.minute("minute") <= closes)
    move_of = lambda c: F.ln(ratio(c, "entry"))
    # Prices are compared, not logs: a price of 0 is below any level.
    beyond = lambda c, sign, level: F.col(c) >= F.col("entry") * level if sign > 0 else F.col(c) <= F.col("entry") / level
    j = j.withColumns({"age": ((F.unix_seconds("minute") - F.unix_seconds("at")) / 60).cast("int"), "d": ratio(move_of("vwap"), F.col("sigma"))})
    j = j.withColumn("v", F.when(F.col("d").isNotNull(), F.col("volume")).otherwise(0.0))
    key = Window.partitionBy("symbol", "date", "at").orderBy("minute")
    upto, whole = key.rowsBetween(Window.unboundedPreceding, 0), key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = {"up": F.greatest(F.col("d") * F.col("v"), F.lit(0.0)), "dn": F.greatest(-F.col("d") * F.col("v"), F.lit(0.0))}
    side = {"up": (F.coalesce(w["up"], F.lit(0.0)), "high", 1), "dn": (F.coalesce(w["dn"], F.lit(0.0)), "low", -1)}
    j = j.withColumns({"cum": F.sum("volume").over(upto)} | {f"c_{s}": F.sum(x).over(upto) for s, (x, _, _) in side.items()} | {f"t_{s}": F.sum(x).over(whole) for s, (x, _, _) in side.items()})
    total = F.sum("v")
    out = [ratio(F.max(f"t_{s}"), total).alias(n) for s, n in (("up", "bulge"), ("dn", "sag"))] + [ratio(F.coalesce(F.sum(F.when(F.col("d") > 0, F.col("v"))), F.lit(0.0)), total).alias("mass_up")]
    for s, (_, extreme, sign) in side.items():
        out.append(F.min(F.when((F.col(f"c_{s}") >= 0.5 * F.col(f"t_{s}")) & (F.col(f"t_{s}") > 0), F.col("age"))).alias(f"t50_{s}"))
        touched = beyond(extreme, sign, F.lit(1 + move))
        out.append(F.coalesce(ratio(F.min_by("cum", F.when(touched, F.col("age"))), F.max("typical")), F.lit(1.0)).alias(f"vol_to_{s}"))
        out.append(F.min(F.when(beyond(extreme, sign, F.exp(race * F.col("sigma"))), F.col("age"))).alias(f"__r_{s}"))
    g = j.groupBy("symbol", "date", "at").agg(*out)
    far = lambda s: F.coalesce(F.col(f"__r_{s}"), F.lit(1 << 20))
    first = F.when(far("up") < far("dn"), 0).when(far("dn") < far("up"), 1).otherwise(2)
    return g.select("symbol", "date", "at", "t50_up", "t50_dn", "vol_to_up", "vol_to_dn", first.alias("race"), "mass_up", "bulge", "sag", (F.col("bulge") - F.col("sag")).alias("net"))


def occupancy(minutes: DataFrame, entries: DataFrame, horizon: int) -> DataFrame:
    """O-151: share of minutes that close above and below the entry."""
    j = _after(minutes, entries, horizon, ["close"])
    return j.groupBy("symbol", "date", "at").agg(F.avg((F.col("close") > F.col("entry")).cast("int")).alias("above"), F.avg((F.col("close") < F.col("entry")).cast("int")).alias("below"))


def persistence(minutes: DataFrame, entries: DataFrame, back: int) -> DataFrame:
    """O-152: the net volume-weighted move of the last minutes before each entry."""
    at = F.unix_seconds("at")
    j = entries.join(minutes.select("symbol", "date", "minute", "vwap", "volume"), ["symbol", "date"]).filter((F.unix_seconds("minute") <= at) & (F.unix_seconds("minute") > at - 60 * back))
    return j.groupBy("symbol", "date", "at").agg(ratio(F.sum(F.ln(ratio("vwap", "entry")) * F.col("volume")), F.sum("volume")).alias("net"))


def prior_normals(minutes: DataFrame, days: int, least: int) -> DataFrame:
    """O-67: median volume of the same minute over the `days` days before, where at least `least` are known."""
    m = minutes.withColumn("slot", F.hour("minute") * 60 + F.minute("minute"))
    w = Window.partitionBy("symbol", "slot").orderBy("date").rowsBetween(-days, -1)
    return m.select("symbol", "date", "minute", "volume", F.when(F.count("volume").over(w) >= least, F.percentile("volume", F.lit(0.5)).over(w)).alias("normal"))


def squared_changes(minutes: DataFrame, width: int = 15) -> DataFrame:
    """O-40: sum of squared log VWAP changes and their number in each block of minutes."""
    w = Window.partitionBy("symbol", "date").orderBy("minute")
    r = F.ln(ratio(F.col("vwap"), F.lag("vwap").over(w)))
    block = F.floor((F.hour("minute") * 60 + F.minute("minute")) / width)
    return minutes.select("symbol", "date", block.alias("block"), r.alias("r")).groupBy("symbol", "date", "block").agg(F.sum(F.col("r") * F.col("r")).alias("ssq"), F.count("r").alias("n"))


def resistance(series: DataFrame, minutes: list[int]) -> DataFrame:
    """O-143: for each poll the log balance of buying and selling volume for each unit of path on its side, over trailing spans.

    Spans count whole seconds, so polls are summed by second first, and the polls of a second share their balance.
    """
    by = Window.partitionBy("symbol", "date").orderBy("ts")
    step = F.ln(ratio(F.col("price"), F.lag("price").over(by)))
    sums = {"__u": F.when(F.col("side") > 0, F.col("volume")).otherwise(0.0), "__d": F.when(F.col("side") < 0, F.col("volume")).otherwise(0.0), "__pu": F.coalesce(F.when(step > 0, step), F.lit(0.0)), "__pd": F.coalesce(F.when(step < 0, -step), F.lit(0.0))}
    second = F.unix_seconds("ts").alias("__t")
    seconds = series.select("symbol", "date", second, *[c.alias(n) for n, c in sums.items()]).groupBy("symbol", "date", "__t").agg(*[F.sum(n).alias(n) for n in sums])
    out = series.select("symbol", "date", "ts", second)
    for m in minutes:
        per = lambda v, p: F.col(v) / (F.col(p) + 0.01)
        balance = trailing_sums(seconds, 60 * m, list(sums)).select(*[F.col(c).alias(f"__k_{c}") for c in ("symbol", "date", "__t")], F.ln((per("__u", "__pu") + 1) / (per("__d", "__pd") + 1)).alias(f"balance_{m}m"))
        same = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in ("symbol", "date", "__t")]
        out = out.join(balance, same[0] & same[1] & same[2]).drop("__k_symbol", "__k_date", "__k___t")
    return out.drop("__t")


def trailing_sums(seconds: DataFrame, span: int, sums: list[str]) -> DataFrame:
    """Sums over [__t - span, __t] for each row (symbol, date, __t) of a symbol's day.

    The day is cut into blocks as long as the span. A row's frame is then its block up to it, and the block before from the same place on: two running sums, whatever
    the number of rows in the span, and nothing is subtracted.
    """
    block = F.floor(F.col("__t") / span)
    own = seconds.select("symbol", "date", "__t", block.alias("__block"), F.lit(0).alias("__later"), *sums)
    before = seconds.filter("__t IS NOT NULL").select("symbol", "date", "__t", (block - 1).alias("__block"), F.lit(1).alias("__later"), *[F.lit(0.0).alias(c) for c in sums])
    place = F.col("__t") - (F.col("__block") + F.col("__later")) * span
    day = Window.partitionBy("symbol", "date", "__block")
    upto = day.orderBy("__later", "__t").rowsBetween(Window.unboundedPreceding, 0)
    onward = day.orderBy(place.desc(), "__later").rowsBetween(Window.unboundedPreceding, 0)
    halves = own.unionByName(before).select("symbol", "date", "__t", *[F.when(F.col("__later") == 0, F.sum(c).over(upto)).otherwise(F.sum(c).over(onward)).alias(c) for c in sums])
    return halves.groupBy("symbol", "date", "__t").agg(*[F.sum(c).alias(c) for c in sums])


def touch_rates(rows: DataFrame, by: list[str]) -> DataFrame:
    """O-160b, O-161b: number and share of each outcome of the race."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.avg((F.col("race") == r).cast("int")).alias(r) for r in ("win", "loss", "both", "neither")])


def slot_of(ts: str, width: int) -> Column:
    return F.floor((F.hour(ts) * 60 + F.minute(ts)) / width)
