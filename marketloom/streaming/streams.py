"""Structured Streaming jobs: ingest, redelivery, tumbling bars, latest values, validation, recommendation state and liveness."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

BATCH = "schema_version int, source string, kind string, ts_utc timestamp, feed_seq bigint, rows array<struct<symbol:string,price:double,volume:double>>, _key string"


def parsed(raw: DataFrame) -> DataFrame:
    """O-230: batch envelopes (value: JSON text) as structs, with the reason where one is bad."""
    rows = raw.select("value", F.from_json("value", BATCH).alias("b"))
    problem = F.when(F.col("b").isNull() | F.col("b.source").isNull(), "unparseable").when(F.col("b.schema_version") != 1, "version").when(F.col("b.rows").isNull(), "rows")
    return rows.withColumn("problem", problem)


def poll_rows(batches: DataFrame) -> DataFrame:
    """O-230: rows of good batches with their day and hour in New York."""
    good = batches.filter("problem IS NULL").select("b.*")
    ny = F.from_utc_timestamp("ts_utc", "America/New_York")
    return good.select("source", "kind", "ts_utc", "feed_seq", "_key", F.to_date(ny).alias("date"), F.hour(ny).alias("hour"), F.inline("rows"))


def once(batches: DataFrame, late: str = "10 minutes") -> DataFrame:
    """O-231, O-236: each batch key once within the watermark."""
    return batches.withWatermark("ts_utc", late).dropDuplicatesWithinWatermark(["_key"])


def sink(rows: DataFrame, path: str, checkpoint: str, partitions: tuple[str, ...] = ("source", "date", "hour")):
    """O-230: append to a partitioned table; the checkpoint makes restarts exact."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*partitions).trigger(availableNow=True)


def split_sink(batches: DataFrame, path: str, checkpoint: str, late: str = "10 minutes", per_epoch: int | None = None):
    """O-232, O-233: rows of good batches, bad messages and late rows in one table, in one read of the source, with counts.

    An epoch is written once, partitioned by kind: good (rows in time), late (rows more than `late` behind the newest row of all earlier epochs) and bad (messages,
    with the problem). Counts by kind and the newest time are observed while the rows are written, and stored beside the epoch (path/marks); the next epoch
    reads the newest time there. A repeated epoch overwrites its own folders from the same mark, so that the result is exact.
    """
    spark = batches.sparkSession

    def write(df: DataFrame, epoch: int) -> None:
        mark = spark.read.schema(MARKS).parquet(f"{path}/marks/epoch={epoch - 1}").first().newest if epoch else None
        behind = F.col("ts_utc") < F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {late}")
        ny = F.from_utc_timestamp("b.ts_utc", "America/New_York")
        rows = df.select("value", "problem", "b.source", "b.ts_utc", "b.feed_seq", "b._key", F.to_date(ny).alias("date"), F.hour(ny).alias("hour"), F.explode_outer(F.when(F.isnull("problem"), F.col("b.rows"))).alias("row"))
        kind = F.when(F.isnotnull("problem"), "bad").when(F.coalesce(behind, F.lit(False)), "late").otherwise("good")
        # A good batch without rows has none to write.
        rows = rows.filter("problem IS NOT NULL OR row IS NOT NULL").select(kind.alias("kind"), F.when(F.isnotnull("problem"), F.col("value")).alias("value"), *rows.columns[1:-1], "row.*")
        seen = Observation(f"split-{epoch}")
        counts = [F.count_if(F.col("kind") == k).alias(k) for k in ("good", "late", "bad")]
        rows.observe(seen, *counts, F.max(F.when(F.isnull("problem"), F.col("ts_utc"))).alias("newest")).write.partitionBy("kind").mode("overwrite").parquet(f"{path}/rows/epoch={epoch}")
        got = seen.get
        newest = max((x for x in (mark, got["newest"]) if x is not None), default=None)
        spark.createDataFrame([(got["good"], got["late"], got["bad"], newest)], MARKS).write.mode("overwrite").parquet(f"{path}/marks/epoch={epoch}")

    return batches.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)


MARKS = "good long, late long, bad long, newest timestamp"


def upsert_sink(rows: DataFrame, keys: list[str], path: str, checkpoint: str):
    """O-234, O-19: rows of an update-mode query into a table of the latest row for each key.

    Each epoch writes the table anew as version=<epoch>: rows of the version before whose keys don't come, and the epoch's own. A
    repeated epoch overwrites its version from the same predecessor, so the result is exact. Meant for key sets of modest size
    (symbols); state holds one row for each.
    """
    spark = rows.sparkSession
    schema = rows.schema

    def write(batch: DataFrame, epoch: int) -> None:
        if epoch:
            before = spark.read.schema(schema).parquet(f"{path}/version={epoch - 1}")
            batch = before.join(batch.select(*keys), keys, "left_anti").unionByName(batch)
        batch.write.mode("overwrite").parquet(f"{path}/version={epoch}")

    return rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def tumbling_bars(polls: DataFrame, width: str = "5 minutes", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """O-232, O-239: OHLC, volume and VWAP of tumbling (or sliding) windows; late rows go to their own window until the watermark."""
    order = F.struct("ts", "price")
    return polls.withWatermark("ts", late).groupBy("symbol", F.window("ts", width, slide or width).alias("w")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("volume").alias("volume"), (F.sum(F.col("price") * F.col("volume")) / F.sum("volume")).alias("vwap"), F.count("*").alias("n"),
    ).select("symbol", F.col("w.start").alias("start"), "open", "high", "low", "close", "volume", "vwap", "n")


def latest_values(polls: DataFrame) -> DataFrame:
    """O-234: the last known value of each field of each symbol, as a running aggregation (output mode complete or update)."""
    at = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ts")))
    return polls.groupBy("symbol").agg(at("price").alias("price"), at("volume").alias("volume"), F.max("ts").alias("ts"))


def problem_counts(messages: DataFrame, types: list[str], now: str) -> DataFrame:
    """O-237: counts of (type, problem) of messages (type, schema_version, ts, sent)."""
    skew = F.abs(F.unix_micros("ts") - F.unix_micros(now)) > 5_000_000
    problem = F.when(F.col("type").isNull(), "unparseable").when(~F.col("type").isin(types), "unknown type").when(F.col("schema_version") != 1, "version").when(skew, "clock")
    return messages.withColumn("problem", problem).filter("problem IS NOT NULL").groupBy("type", "problem").count()


def stale(status: DataFrame, now, seconds: int = 180) -> DataFrame:
    """O-238: parties and whether their last status is older than `seconds`."""
    last = status.groupBy("party").agg(F.max("ts").alias("last"))
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("last")
    return last.select("party", age.alias("age_s"), (age > seconds).alias("offline"))


def session_vwaps(polls: DataFrame, late: str = "10 minutes") -> DataFrame:
    """O-239: the VWAP of each symbol's session (day) so far, as a running aggregation (update or complete; append once the day is over)."""
    day = polls.withWatermark("ts", late).groupBy("symbol", F.window("ts", "1 day").alias("w"))
    return day.agg((F.sum(F.col("price") * F.col("volume")) / F.sum("volume")).alias("vwap"), F.sum("volume").alias("volume"), F.max("ts").alias("ts")).select("symbol", F.to_date("w.start").alias("date"), "vwap", "volume", "ts")


def rec_id(*parts) -> Column:
    """O-235: the id of a recommendation, the same wherever it is made."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24)


def with_expiry(polls: DataFrame, params: DataFrame, default_ttl_s: int) -> DataFrame:
    """O-235: polls (symbol, ts, price) with expires: ts + the time to live of the day's parameters, at most their greatest one, or the session's close if that comes
    first.

    params: date, version, ttl_s, max_s, close (each may be NULL): of a day's rows the highest version counts. A row a day and version: it is broadcast if
    counted small.
    """
    latest_ = params.groupBy("date").agg(F.max_by(F.struct("ttl_s", "max_s", "close"), "version").alias("p"))
    ttl = F.least(F.coalesce("p.ttl_s", F.lit(default_ttl_s)), F.col("p.max_s"))  # least skips NULL
    made = polls.withColumn("date", F.to_date("ts")).join(latest_, "date", "left")
    return made.select("symbol", "date", "ts", "price", F.least(F.timestamp_add("SECOND", ttl, F.col("ts")), "p.close").alias("expires"), F.col("p.close").alias("close"))


def recommend(polls: DataFrame, params: DataFrame, default_ttl_s: int = 3600) -> DataFrame:
    """O-235 over stored polls: (symbol, date, ts, price, expires, id): a symbol's polls in order of (ts, price), repeats left out while one is active.

    One is active until it expires, and at most to the close of its session, so that every (symbol, day) with a close stands by itself: its polls are folded in
    order inside the JVM, without state. Days without a close count as closed at midnight.
    """
    held = with_expiry(polls, params, default_ttl_s).withColumn("expires", F.least("expires", F.date_add("date", 1).cast("timestamp")))
    days = held.groupBy("symbol", "date").agg(F.sort_array(F.collect_list(F.struct("ts", "price", "expires"))).alias("xs"))
    kind = "array<struct<ts:timestamp,price:double,expires:timestamp>>"
    start = F.struct(F.lit(None).cast("timestamp").alias("until"), F.array().cast(kind).alias("made"))
    step = lambda a, x: F.when(a["until"].isNull() | (x["ts"] >= a["until"]), F.struct(x["expires"].alias("until"), F.concat(a["made"], F.array(x)).alias("made"))).otherwise(a)
    out = days.select("symbol", "date", F.inline(F.aggregate("xs", start, step)["made"]))
    return out.select("symbol", "date", "ts", "price", "expires", rec_id("symbol", F.unix_micros("ts")).alias("id"))


class Recommendations(StatefulProcessor):
    """O-235 as a stream: one active recommendation for each symbol (in map state, by its id), an event-time timer at its end.

    Rows of a symbol in one epoch are taken in order of (ts, price), however many Arrow batches they come in; rows of a later epoch that are older than an active
    recommendation are repeats of it. When the watermark passes the end, the timer fires, the state is dropped and a row of kind 'expired' is given out.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.active = handle.getMapState("active", "id string", "until timestamp, ts timestamp, price double")

    def handleInputRows(self, key, rows, timerValues):
        import hashlib

        polls = sorted((ts, price, end) for part in rows for ts, price, end in zip(part["ts"], part["price"], part["expires"]))
        until = max((pd.Timestamp(v[0]) for _, v in self.active.iterator()), default=None)
        out = []
        for ts, price, end in polls:
            if until is not None and ts < until:
                continue
            until = end
            name = hashlib.sha256(f"{key[0]}|{ts.value // 1000}".encode()).hexdigest()[:24]
            self.active.updateValue((name,), (end.to_pydatetime(), ts.to_pydatetime(), price))
            self.handle.registerTimer(int(end.value // 1_000_000))
            out.append((key[0], ts, price, end, name, "new"))
        yield pd.DataFrame(out, columns=["symbol", "ts", "price", "expires", "id", "kind"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        at = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        for (name,), (until, ts, price) in list(self.active.iterator()):
            if int(pd.Timestamp(until).value // 1_000_000) <= at:
                self.active.removeKey((name,))
                out.append((key[0], ts, price, until, name, "expired"))
        yield pd.DataFrame(out, columns=["symbol", "ts", "price", "expires", "id", "kind"])

    def close(self) -> None:
        pass


def recommend_stream(polls: DataFrame, late: str = "10 minutes") -> DataFrame:
    """O-235: (symbol, ts, price, expires, id, kind) of a stream of polls with their expiry (with_expiry over static parameters)."""
    kind = "symbol string, ts timestamp, price double, expires timestamp, id string, kind string"
    return polls.withWatermark("ts", late).groupBy("symbol").transformWithStateInPandas(statefulProcessor=Recommendations(), outputStructType=StructType.fromDDL(kind), outputMode="Append", timeMode="EventTime")
