"""Table functions against the folds, on days of a reading each second; the registry's rules and its single shuffle."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketloom.operators import intraday, kernels, registry


def seconds(spark, n):
    rng = random.Random(3)
    rows = []
    for s in ("A", "B"):
        x = 100.0
        for i in range(n if s == "A" else 40):
            x *= 1 + rng.gauss(0, 0.0006)
            rows.append((s, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2) + dt.timedelta(seconds=i), x, float(rng.randrange(1, 9))))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, date date, at timestamp, price double, volume double").cache()


def test_zigzag_of_a_day_of_seconds(spark):
    df = seconds(spark, 23_400)
    kernels.register(spark)
    df.createOrReplaceTempView("zz")
    got = spark.sql("SELECT * FROM zigzag_legs(TABLE(zz) PARTITION BY (symbol, date) ORDER BY (at), 0.004D)").collect()
    by = {(r.symbol, r["at"]): (r.dir, round(r.length, 9), r.age, r.legs) for r in got}
    assert len(by) == 23_440 and max(r.legs for r in got) > 20
    short = df.filter(F.col("at") < "2024-01-02 00:20:00").groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("at", "price"))).alias("m"))
    legs = intraday.zigzag(F.transform("m", lambda x: x["price"]), 0.004)
    for r in short.select("symbol", F.transform("m", lambda x: x["at"]).alias("ats"), legs.alias("legs")).collect():
        for at, leg in zip(r.ats, r.legs):
            assert by[r.symbol, at] == (leg.dir, round(leg.length, 9), leg.age, leg.legs)


def test_value_area(spark):
    kernels.register(spark)
    df = seconds(spark, 5_000).withColumn("bin", F.floor(F.col("price") * 4).cast("int"))
    df.select("symbol", "date", "bin", "volume").createOrReplaceTempView("va")
    got = {r.symbol: (r.low, r.high, r.held) for r in spark.sql("SELECT * FROM value_area_of(TABLE(va) PARTITION BY (symbol, date), 0.7D)").collect()}
    h = df.groupBy("symbol", "bin").agg(F.sum("volume").alias("v")).groupBy("symbol").agg(F.min("bin").alias("b"), F.max("bin").alias("t"), F.map_from_entries(F.collect_list(F.struct("bin", "v"))).alias("m"))
    hist = F.transform(F.sequence("b", "t"), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))
    for r in h.select("symbol", "b", intraday.value_area(hist).alias("a")).collect():
        assert got[r.symbol] == (r.b + r.a.low, r.b + r.a.high, pytest.approx(r.a.held))


def test_registry_rules(spark):
    r = registry.decision_features(48)
    assert len(r.features) >= 45 and {f.role for f in r.features.values()} == {"past", "known", "target"}
    with pytest.raises(ValueError, match="already"):
        r.add(registry.Feature("ret_1", lambda w: F.lit(1)))
    with pytest.raises(ValueError, match="needs"):
        r.add(registry.Feature("x", lambda w: F.lit(1), needs=("nothing",)))
    with pytest.raises(ValueError, match="ahead"):
        r.add(registry.Feature("x", lambda w: F.col("fwd_1"), needs=("fwd_1",)))
    assert [n for n in r.layers(["z_ret_1"])] == [["ret_1"], ["rv_12"], ["z_ret_1"]]
    assert "day_high" not in r.chosen(tier=1) and r.chosen(roles=["known"]) == ["to_close", "clock_sin", "clock_cos"]
    assert len(r.catalogue()[0]) == 6
    rows = [("A", dt.date(2024, 1, 2), i, 1.0, 2.0, 0.5, 1.0 + i / 10, 1.0, 3.0) for i in range(9)]
    df = spark.createDataFrame(rows, "symbol string, date date, step int, open double, high double, low double, close double, vwap double, volume double")
    assert r.compiled(df, ("symbol", "date"), "step", ["in_range"]).columns == [*df.columns, "in_range"]


def test_one_shuffle_for_all_features(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("symbol"), F.date_add(F.current_date(), (F.col("id") % 3).cast("int")).alias("date"), F.col("id").alias("step"), *[F.rand().alias(c) for c in ("open", "high", "low", "close", "vwap", "volume")])
    out = registry.decision_features(48).compiled(df, ("symbol", "date"), "step")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [symbol") == 1
