"""O-244: table functions for SQL: causal zig-zag legs and value areas over `TABLE(...) PARTITION BY ... ORDER BY ...`.

They take a partition in Arrow batches and hold a state of a fixed size (legs) or a row a price bin (value areas), so a day of any length streams through.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf


class _Legs:
    """The rules of intraday.zigzag, a price at a time."""

    def __init__(self):
        self.dir = self.age = self.legs = 0
        self.pivot = self.extreme = None

    def take(self, x: float, threshold: float):
        if self.pivot is None:
            self.pivot = self.extreme = x
        up = x - min(self.extreme, self.pivot) if self.dir == 0 else x - self.extreme
        down = max(self.extreme, self.pivot) - x if self.dir == 0 else self.extreme - x
        turn_up, turn_down = self.dir <= 0 and up >= threshold, self.dir >= 0 and down >= threshold
        if turn_up or turn_down:
            if self.dir:
                self.pivot = self.extreme
            self.dir, self.extreme, self.age, self.legs = (1 if turn_up else -1), x, 0, self.legs + 1
        else:
            self.age += 1
            if (self.dir == 1 and x > self.extreme) or (self.dir == -1 and x < self.extreme) or (self.dir == 0 and abs(x - self.pivot) > abs(self.extreme - self.pivot)):
                self.extreme = x
        return self.dir, self.extreme - self.pivot, self.age, self.legs


class ZigzagLegs:
    """(symbol, date, at, dir, length, age, legs) of a table with symbol, date, at (the order) and price, partitioned by symbol and date and ordered by at. threshold: a log move."""

    def __init__(self):
        self.state = _Legs()

    def eval(self, rows: pa.RecordBatch, threshold: pa.Array):
        size = float(threshold[0].as_py())
        out = list(zip(*[self.state.take(math.log(p), size) for p in rows.column("price").to_pylist()])) or [[], [], [], []]
        yield pa.table({"symbol": rows.column("symbol"), "date": rows.column("date"), "at": rows.column("at"), "dir": pa.array(out[0], pa.int32()), "length": pa.array(out[1], pa.float64()), "age": pa.array(out[2], pa.int32()), "legs": pa.array(out[3], pa.int32())})


class ValueArea:
    """(symbol, date, low, high, held): the bins around the one with the most volume that hold a share of a partition's volume; table: symbol, date, bin, volume. The larger neighbour is
    taken first, the upper one of two equal ones; bins without volume lie between as empty ones."""

    def __init__(self):
        self.bins: dict[int, float] = {}
        self.key, self.share = None, 0.7

    def eval(self, rows: pa.RecordBatch, share: pa.Array):
        if rows.num_rows:
            self.key, self.share = (rows.column("symbol")[0].as_py(), rows.column("date")[0].as_py()), float(share[0].as_py())
        for b, v in zip(rows.column("bin").to_pylist(), rows.column("volume").to_pylist()):
            self.bins[b] = self.bins.get(b, 0.0) + v
        return iter(())

    def terminate(self):
        if not self.bins:
            return
        most = max(self.bins.values())
        low = high = min(b for b, v in self.bins.items() if v == most)
        bottom, top, held, total = min(self.bins), max(self.bins), most, sum(self.bins.values())
        while held < self.share * total and (low > bottom or high < top):
            below = self.bins.get(low - 1, 0.0) if low > bottom else None
            above = self.bins.get(high + 1, 0.0) if high < top else None
            if above is not None and (below is None or above >= below):
                high, held = high + 1, held + above
            else:
                low, held = low - 1, held + below
        yield pa.table({"symbol": [self.key[0]], "date": pa.array([self.key[1]], pa.date32()), "low": pa.array([low], pa.int32()), "high": pa.array([high], pa.int32()), "held": pa.array([held], pa.float64())})


def register(spark: SparkSession) -> SparkSession:
    """Makes zigzag_legs and value_area_of known to SQL."""
    spark.udtf.register("zigzag_legs", arrow_udtf(ZigzagLegs, returnType="symbol string, date date, at timestamp, dir int, length double, age int, legs int"))
    spark.udtf.register("value_area_of", arrow_udtf(ValueArea, returnType="symbol string, date date, low int, high int, held double"))
    return spark
