"""Streaming jobs run over the events table as a file stream, with all available data, into memory or tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketloom.plans.base import query, read, rounded
from marketloom.plans.intraday import POLLS
from marketloom.streaming import streams


def _stream(spark, d):
    t = read(spark, d, "events")
    folder, name = d, "events.parquet"
    return spark.readStream.schema(t.schema).option("pathGlobFilter", f"{name}*").parquet(f"{folder}/{name}*").select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("volume"))


def _work(spark) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file:///tmp/marketloom"
    path = f"{root.rstrip('/')}/stream-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)  # when the session's JVM ends
    return path


def _appended(spark, df):
    """Runs an append-mode query over all available data; what every epoch appended, read back."""
    out = _work(spark)
    df.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/rows")


@query(POLLS + """, b AS (SELECT symbol, time_bucket(INTERVAL 1 HOUR, ts) AS start, arg_min(price, (ts, price)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, price)) AS close, sum(volume) AS volume, sum(price * volume) / sum(volume) AS vwap, count(*) AS n FROM polls GROUP BY ALL)
 SELECT symbol, start, f32(open) AS open, f32(high) AS high, f32(low) AS low, f32(close) AS close, volume, f32(vwap) AS vwap, n FROM b WHERE start + INTERVAL 70 MINUTES <= (SELECT max(ts) FROM polls)""")
def o239_streaming_bars(spark, d):
    """Append mode: a bar is final, and its state is dropped, once the watermark (10 minutes behind the newest row) has passed its end."""
    return rounded(_appended(spark, streams.tumbling_bars(_stream(spark, d), "1 hour")))


@query(POLLS + " SELECT symbol, f32(arg_max(price, ts)) AS price, arg_max(volume, ts) AS volume, max(ts) AS ts FROM polls GROUP BY symbol")
def o234_latest_values(spark, d):
    """Update mode into a table of the latest row for each symbol."""
    out, df = _work(spark), streams.latest_values(_stream(spark, d))
    run = streams.upsert_sink(df, ["symbol"], f"{out}/latest", f"{out}/checkpoint").start()
    run.awaitTermination()
    newest = max(p["batchId"] for p in run.recentProgress)
    return rounded(spark.read.schema(df.schema).parquet(f"{out}/latest/version={newest}"))


def _envelopes(spark, d):
    """Events as JSON envelopes of one poll; those of odd user ids in the hundreds are of a version that isn't known."""
    t = read(spark, d, "events")
    raw = spark.readStream.schema(t.schema).option("pathGlobFilter", "events.parquet*").parquet(f"{d}/events.parquet*")
    return _enveloped(raw)


def _enveloped(raw):
    row = F.array(F.struct(F.col("event_type").alias("symbol"), F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("volume")))
    version = F.when(F.col("user_id") % 7 == 3, 2).otherwise(1)
    body = F.struct(version.alias("schema_version"), F.lit("feed").alias("source"), F.lit("poll").alias("kind"), F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ts_utc"), F.col("event_id").alias("feed_seq"), row.alias("rows"), F.concat(F.lit("k"), F.col("event_id")).alias("_key"))
    return raw.select(F.to_json(body).alias("value"))


_NY = "ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York'"
_GOOD = rf"SELECT event_id AS feed_seq, ({_NY})::DATE AS date, hour({_NY})::INT AS hour, event_type AS symbol, f32(value) AS price, regexp_extract(props, '(\d+)', 1)::DOUBLE + 1 AS volume FROM events WHERE user_id % 7 <> 3"


@query(_GOOD)
def o230_ingest(spark, d):
    """Envelopes to rows, appended to a table by source, day and hour."""
    rows = streams.poll_rows(streams.parsed(_envelopes(spark, d)))
    out = _work(spark)
    streams.sink(rows, f"{out}/polls", f"{out}/checkpoint").start().awaitTermination()
    return rounded(spark.read.schema(rows.schema).parquet(f"{out}/polls").select("feed_seq", "date", "hour", "symbol", "price", "volume"))


@query(_GOOD.replace("SELECT event_id AS feed_seq, ", "SELECT event_id AS feed_seq, 'k' || event_id AS key, ").split(", (")[0] + " FROM events WHERE user_id % 7 <> 3")
def o231_redelivery(spark, d):
    """Every envelope is delivered twice; each key passes once."""
    twice = _envelopes(spark, d).select("value", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery")).drop("delivery")
    rows = streams.poll_rows(streams.parsed(twice))
    return _appended(spark, streams.once(rows)).select("feed_seq", F.col("_key").alias("key"))


@query("SELECT CASE WHEN user_id % 7 = 3 THEN 'version' ELSE 'good' END AS kind, count(*) AS n FROM events GROUP BY 1")
def o233_split_sink(spark, d):
    """Good rows and bad messages of one read; the table's counts."""
    out = _work(spark)
    streams.split_sink(streams.parsed(_envelopes(spark, d)), out, f"{out}/checkpoint").start().awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    return rows.groupBy(F.coalesce("problem", F.lit("good")).alias("kind")).agg(F.count("*").alias("n"))


PARTS = 3


@query(f"""WITH e AS (SELECT *, event_id % {PARTS} AS part FROM events), m AS (SELECT part, max(ts) FILTER (WHERE user_id % 7 <> 3) AS newest FROM e GROUP BY part),
 k AS (SELECT part, CASE WHEN user_id % 7 = 3 THEN 'bad' WHEN ts < (SELECT max(newest) FROM m WHERE m.part < e.part) - INTERVAL 7 DAYS THEN 'late' ELSE 'good' END AS kind FROM e)
 SELECT part::INT AS epoch, count(*) FILTER (WHERE kind = 'good') AS good, count(*) FILTER (WHERE kind = 'late') AS late, count(*) FILTER (WHERE kind = 'bad') AS bad FROM k GROUP BY part""")
def o232_late_rows(spark, d):
    """Events arrive in three parts, each an epoch; what is observed while they are written (rows more than seven days behind earlier parts are late)."""
    out = _work(spark)
    events = read(spark, d, "events")
    for part in range(PARTS):
        events.filter(F.col("event_id") % PARTS == part).write.mode("append").parquet(f"{out}/in/part={part}")
        raw = spark.readStream.schema(events.schema).parquet(f"{out}/in/part=*")
        streams.split_sink(streams.parsed(_enveloped(raw)), out, f"{out}/checkpoint", "7 DAYS").start().awaitTermination()
    return spark.read.parquet(f"{out}/marks").select("epoch", "good", "late", "bad")


@query(POLLS + " SELECT symbol, ts::DATE AS date, f32(sum(price * volume) / sum(volume)) AS vwap, sum(volume) AS volume, max(ts) AS ts FROM polls GROUP BY ALL")
def o239_session_vwap(spark, d):
    """Update mode into a table of the latest row for each symbol and day."""
    out, df = _work(spark), streams.session_vwaps(_stream(spark, d))
    run = streams.upsert_sink(df, ["symbol", "date"], f"{out}/latest", f"{out}/checkpoint").start()
    run.awaitTermination()
    newest = max(p["batchId"] for p in run.recentProgress)
    return rounded(spark.read.schema(df.schema).parquet(f"{out}/latest/version={newest}"))


@query(r"""WITH m AS (SELECT CASE WHEN user_id % 11 <> 0 THEN event_type END AS type, CASE WHEN user_id % 5 = 0 THEN 2 ELSE 1 END AS v, regexp_extract(props, '(\d+)', 1)::INT AS k FROM events)
 SELECT type, problem, count(*) AS count FROM (SELECT type, CASE WHEN type IS NULL THEN 'unparseable' WHEN type = 'error' THEN 'unknown type' WHEN v <> 1 THEN 'version' WHEN k * 100 > 5000 THEN 'clock' END AS problem FROM m) WHERE problem IS NOT NULL GROUP BY ALL""")
def o237_problem_counts(spark, d):
    e = read(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    ts = F.col("ts").cast("timestamp")
    m = e.select(F.when(F.col("user_id") % 11 != 0, F.col("event_type")).alias("type"), F.when(F.col("user_id") % 5 == 0, 2).otherwise(1).alias("schema_version"), ts.alias("ts"), F.timestamp_add("MILLISECOND", k * 100, ts).alias("sent"))
    return streams.problem_counts(m, ["view", "signup", "click", "purchase"], "sent")


@query("SELECT user_id AS party, epoch(TIMESTAMP '2024-01-31')::BIGINT - floor(epoch(max(ts)))::BIGINT AS age_s, epoch(TIMESTAMP '2024-01-31')::BIGINT - floor(epoch(max(ts)))::BIGINT > 86400 AS offline FROM events GROUP BY user_id")
def o238_liveness(spark, d):
    status = read(spark, d, "events").select(F.col("user_id").alias("party"), F.col("ts").cast("timestamp").alias("ts"))
    return streams.stale(status, "2024-01-31 00:00:00", 86400)


# Parameters of a day: two versions; on odd days the second one is shorter, and the session closes at 20:00 UTC on two days of three.
_RECS = """WITH RECURSIVE p AS (SELECT user_id::VARCHAR AS symbol, ts, value AS price, ts::DATE AS date FROM events),
 x AS (SELECT *, least(ts + to_seconds(CASE WHEN day(date) % 2 = 1 THEN 1800 ELSE 7200 END), CASE WHEN day(date) % 3 > 0 THEN date + INTERVAL 20 HOURS END, date + INTERVAL 24 HOURS) AS expires FROM p),
 o AS (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY ts, price) AS i FROM x),
 nx AS (SELECT a.symbol, a.date, a.i, a.ts, a.price, a.expires, min(b.i) AS nxt FROM o a LEFT JOIN o b ON a.symbol = b.symbol AND a.date = b.date AND b.i > a.i AND b.ts >= a.expires GROUP BY ALL),
 walk AS (SELECT * FROM nx WHERE i = 1 UNION ALL SELECT n.* FROM walk w JOIN nx n ON n.symbol = w.symbol AND n.date = w.date AND n.i = w.nxt)
 SELECT symbol, date, ts, f32(price) AS price, expires, substr(sha256(symbol || '|' || epoch_us(ts)), 1, 24) AS id FROM walk"""


def _rec_polls(spark, d):
    polls = read(spark, d, "events").select(F.col("user_id").cast("string").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"))
    days = polls.select(F.to_date("ts").alias("date")).distinct()
    close = F.when(F.day("date") % 3 > 0, F.timestamp_add("HOUR", F.lit(20), F.col("date").cast("timestamp")))
    first = days.select("date", F.lit(1).alias("version"), F.lit(9000).alias("ttl_s"), F.lit(7200).alias("max_s"), F.lit(None).cast("timestamp").alias("close"))
    second = days.select("date", F.lit(2).alias("version"), F.when(F.day("date") % 2 == 1, 1800).otherwise(9000).alias("ttl_s"), F.lit(7200).alias("max_s"), close.alias("close"))
    return polls, first.union(second)


@query(_RECS)
def o235_recommendations(spark, d):
    """Repeats are left out while a recommendation of the symbol is active."""
    return rounded(streams.recommend(*_rec_polls(spark, d)))
