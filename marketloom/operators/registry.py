"""Features by declaration: each names its role, group, tier, window and inputs, and all of a key are compiled into few passes that share one partitioning."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from marketloom.functions.expr import ratio


class Frames:
    """The windows of one key and order: they differ in their frames only, so Spark shuffles and sorts once for all of them."""

    def __init__(self, keys: tuple[str, ...], order: str):
        self.order = Window.partitionBy(*keys).orderBy(order)
        self.whole = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        self.so_far = self.order.rowsBetween(Window.unboundedPreceding, 0)
        self.after = self.order.rowsBetween(1, Window.unboundedFollowing)

    def last(self, n: int) -> WindowSpec:
        """The row and the n - 1 before it."""
        return self.order.rowsBetween(-(n - 1), 0)

    def lag(self, column: str, n: int) -> Column:
        return F.lag(column, n).over(self.order)

    def lead(self, column: str, n: int) -> Column:
        return F.lead(column, n).over(self.order)


@dataclass(frozen=True)
class Feature:
    """O-241. role: past (known at the row), known (of the future, too: clocks) or target. chunk: the group that is switched on and off together. tier: 1 for those of every run. window: what it reads,
    as text for the catalogue. needs: features that it is made of. build: its column, from the frames of the key."""

    name: str
    build: Callable[[Frames], Column]
    role: str = "past"
    chunk: str = "price"
    tier: int = 1
    window: str = "row"
    needs: tuple[str, ...] = field(default=())


class Registry:
    def __init__(self, features: Iterable[Feature] = ()):
        self.features: dict[str, Feature] = {}
        for f in features:
            self.add(f)

    def add(self, feature: Feature) -> None:
        """A new feature is one call. A name is taken once, and inputs have to be there before it, so that there are no cycles."""
        if feature.name in self.features:
            raise ValueError(f"{feature.name} is registered already")
        if missing := [n for n in feature.needs if n not in self.features]:
            raise ValueError(f"{feature.name} needs {missing}")
        if feature.role == "past" and (bad := [n for n in feature.needs if self.features[n].role == "target"]):
            raise ValueError(f"{feature.name} would look ahead by {bad}")
        self.features[feature.name] = feature

    def chosen(self, roles: Iterable[str] | None = None, chunks: Iterable[str] | None = None, tier: int = 9) -> list[str]:
        roles, chunks = set(roles or ("past", "known", "target")), set(chunks) if chunks else None
        return [f.name for f in self.features.values() if f.role in roles and f.tier <= tier and (chunks is None or f.chunk in chunks)]

    def layers(self, names: Iterable[str]) -> list[list[str]]:
        """The features and what they need, in layers: each needs earlier layers only."""
        level: dict[str, int] = {}

        def depth(name: str) -> int:
            if name not in level:
                level[name] = 1 + max((depth(n) for n in self.features[name].needs), default=-1)
            return level[name]

        for n in names:
            depth(n)
        return [[n for n in self.features if level.get(n) == i] for i in range(max(level.values(), default=-1) + 1)]

    def compiled(self, rows: DataFrame, keys: tuple[str, ...], order: str, names: Iterable[str] | None = None) -> DataFrame:
        """rows with the chosen features (all by default): one pass for each layer, one shuffle for all. What is only needed on the way is dropped again."""
        names = list(names) if names is not None else list(self.features)
        frames, out = Frames(keys, order), rows
        for layer in self.layers(names):
            out = out.withColumns({n: self.features[n].build(frames) for n in layer})
        extra = [n for layer in self.layers(names) for n in layer if n not in names]
        return out.drop(*extra)

    def catalogue(self) -> list[tuple]:
        return [(f.name, f.role, f.chunk, f.tier, f.window, ",".join(f.needs)) for f in self.features.values()]


def _log(a, b) -> Column:
    return F.ln(ratio(a, b))


def decision_features(steps: int) -> Registry:
    """O-134: the features of decision steps over dense rows: step (number in the day, `steps` of them a day), open, high, low, close, vwap, volume."""
    r = Registry()
    pv = lambda: F.col("vwap") * F.col("volume")
    for k in (1, 2, 3, 6, 12):
        r.add(Feature(f"ret_{k}", lambda w, k=k: _log("close", w.lag("close", k)), window=f"{k} steps back", tier=1 if k < 12 else 2))
    for k in (3, 6, 12):
        r.add(Feature(f"range_{k}", lambda w, k=k: ratio(F.max("high").over(w.last(k)) - F.min("low").over(w.last(k)), "close"), window=f"last {k}"))
        r.add(Feature(f"volume_{k}", lambda w, k=k: F.sum("volume").over(w.last(k)), chunk="volume", window=f"last {k}"))
        r.add(Feature(f"vwap_gap_{k}", lambda w, k=k: ratio("close", ratio(F.sum(pv()).over(w.last(k)), F.sum("volume").over(w.last(k)))) - 1, chunk="vwap", window=f"last {k}"))
        r.add(Feature(f"rv_{k}", lambda w, k=k: F.sqrt(F.sum(F.col("ret_1") * F.col("ret_1")).over(w.last(k))), chunk="path", window=f"last {k}", needs=("ret_1",)))
        r.add(Feature(f"up_{k}", lambda w, k=k: F.avg((F.col("ret_1") > 0).cast("int")).over(w.last(k)), chunk="path", window=f"last {k}", needs=("ret_1",)))
    day = [
        Feature("day_ret", lambda w: _log("close", F.first("close").over(w.so_far)), window="day so far"),
        Feature("day_volume", lambda w: F.sum("volume").over(w.so_far), chunk="volume", window="day so far"),
        Feature("day_vwap_gap", lambda w: ratio("close", ratio(F.sum(pv()).over(w.so_far), F.sum("volume").over(w.so_far))) - 1, chunk="vwap", window="day so far"),
        Feature("day_high", lambda w: F.max("high").over(w.so_far), tier=2, window="day so far"),
        Feature("day_low", lambda w: F.min("low").over(w.so_far), tier=2, window="day so far"),
        Feature("n_steps", lambda w: F.count("*").over(w.so_far), chunk="path", window="day so far"),
        Feature("in_range", lambda w: ratio(F.col("close") - F.col("day_low"), F.col("day_high") - F.col("day_low")), needs=("day_low", "day_high")),
        Feature("day_range", lambda w: ratio(F.col("day_high") - F.col("day_low"), "close"), needs=("day_low", "day_high")),
        Feature("since_high", lambda w: F.col("step") - F.last(F.when(F.col("high") == F.col("day_high"), F.col("step")), True).over(w.so_far), chunk="path", window="day so far", needs=("day_high",)),
        Feature("since_low", lambda w: F.col("step") - F.last(F.when(F.col("low") == F.col("day_low"), F.col("step")), True).over(w.so_far), chunk="path", window="day so far", needs=("day_low",)),
        Feature("day_rv", lambda w: F.sqrt(F.sum(F.col("ret_1") * F.col("ret_1")).over(w.so_far)), chunk="path", window="day so far", needs=("ret_1",)),
        Feature("day_up", lambda w: F.avg((F.col("ret_1") > 0).cast("int")).over(w.so_far), chunk="path", window="day so far", needs=("ret_1",)),
    ]
    for f in day:
        r.add(f)
    for k in (3, 6, 12):
        r.add(Feature(f"volume_share_{k}", lambda w, k=k: ratio(f"volume_{k}", "day_volume"), chunk="volume", needs=(f"volume_{k}", "day_volume")))
    for k in (1, 3, 6):
        r.add(Feature(f"z_ret_{k}", lambda w, k=k: ratio(f"ret_{k}", "rv_12"), chunk="path", tier=2, needs=(f"ret_{k}", "rv_12")))
    angle = 2 * 3.141592653589793 / steps
    r.add(Feature("to_close", lambda w: F.lit(steps - 1) - F.col("step"), role="known", chunk="clock"))
    r.add(Feature("clock_sin", lambda w: F.sin(F.col("step") * angle), role="known", chunk="clock"))
    r.add(Feature("clock_cos", lambda w: F.cos(F.col("step") * angle), role="known", chunk="clock"))
    for k in (1, 3, 6):
        r.add(Feature(f"fwd_{k}", lambda w, k=k: _log(w.lead("close", k), "close"), role="target", chunk="target", window=f"{k} steps ahead"))
    r.add(Feature("fwd_close", lambda w: _log(F.last("close").over(w.whole), "close"), role="target", chunk="target", window="rest of the day"))
    r.add(Feature("most_up", lambda w: _log(F.max("high").over(w.after), "close"), role="target", chunk="target", window="rest of the day"))
    r.add(Feature("most_down", lambda w: _log(F.min("low").over(w.after), "close"), role="target", chunk="target", window="rest of the day"))
    return r


def drop_reason(least_steps: int = 3, most_gap: float = 0.5) -> Column:
    """O-134: why a decision row is left out, or NULL: too early in the day, nothing traded in its last steps, a jump (a basis that doesn't match), or no later step."""
    return (
        F.when(F.col("n_steps") < least_steps, "early").when(F.coalesce("volume_3", F.lit(0)) <= 0, "no volume").when(F.abs("ret_1") > most_gap, "jump").when(F.col("fwd_1").isNull(), "last step")
    )
