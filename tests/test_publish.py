"""Days are published whole or not at all."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketloom.sources import io

D = dt.datetime(2024, 3, 4)


def at(day, hour):
    return D + dt.timedelta(days=day, hours=hour)


def windows(spark, *spans):
    return spark.createDataFrame([(at(d, a), at(d, b), i) for i, (d, a, b) in enumerate(spans)], "s timestamp, e timestamp, win int")


def points(spark, *times):
    return spark.createDataFrame([(i, at(*t)) for i, t in enumerate(times)], "id int, ts timestamp")


def held(spark, path):
    return {(str(r.date), r.id) for r in spark.read.parquet(path).collect()}


def test_published_whole_or_not(spark, tmp_path):
    path = f"file://{tmp_path}/days"
    two = windows(spark, (0, 9, 16), (1, 9, 16))
    out = io.finalize_days(points(spark, (0, 9), (0, 15), (1, 10)), two, "ts", "s", "e", path, ("ts",))
    first = {("2024-03-04", 0), ("2024-03-04", 1), ("2024-03-05", 2)}
    assert {(str(r.date), r.id) for r in out.collect()} == first and sorted(out.columns) == ["date", "id", "ts", "win"]
    with pytest.raises(PySparkException, match="no window"):
        io.finalize_days(points(spark, (0, 10), (0, 16)), two, "ts", "s", "e", path)  # the end is outside
    with pytest.raises(ValueError, match="2 rows were written instead of 1"):
        io.finalize_days(points(spark, (0, 10)), windows(spark, (0, 9, 16), (0, 9, 11)), "ts", "s", "e", path)  # in two windows
    assert held(spark, path) == first and not [n for n in os.listdir(tmp_path / "days") if n.startswith("_writing")]
    io.finalize_days(points(spark, (1, 11), (1, 12)), two, "ts", "s", "e", path)  # a day again
    assert held(spark, path) == {("2024-03-04", 0), ("2024-03-04", 1), ("2024-03-05", 0), ("2024-03-05", 1)}


def test_compacted(spark, tmp_path):
    rows = spark.createDataFrame([(1, D.date(), 5, 2.0), (1, D.date(), 3, 1.0), (0, D.date(), 1, 7.0)], "symbol int, date date, seq int, price double")
    out, report = io.compact_days(rows, f"file://{tmp_path}/c", ["symbol", "date"], [F.col("seq")])
    assert [(r.symbol, r.price) for r in out.orderBy("symbol").collect()] == [(0, 7.0), (1, 1.0)] and report.first().n_duplicates == 1
