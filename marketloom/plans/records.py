"""Queries of readers, writers and column functions, over records that are derived from the given tables."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import expr as X
from marketloom.operators import feeds, news
from marketloom.operators.scoring import TAUS
from marketloom.plans.base import query, read, rounded
from marketloom.plans.scoring import FORECASTS, cdf, forecasts
from marketloom.plans.streams import _work
from marketloom.sources import io

_DAY = "ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"


def _events(spark, d):
    e = read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select("event_id", "ts", "user_id", F.col("event_type").alias("symbol"), F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("volume"), F.to_date("ts").alias("date"))


@query(f"SELECT event_id, event_type AS symbol, f32(value) AS price, ts::DATE AS file_date FROM events WHERE {_DAY} AND user_id % 10 <> 0")
def o01_jsonl_by_date(spark, d):
    """Events as dated JSON lines, some without a symbol, read back between two dates."""
    out = _work(spark)
    e = _events(spark, d).select("event_id", F.when(F.col("user_id") % 10 != 0, F.col("symbol")).alias("symbol"), "price", F.concat(F.lit("bars-"), F.date_format("date", "yyyy-MM-dd")).alias("day"))
    e.repartition("day").write.partitionBy("day").json(out)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("symbol", T.StringType()), T.StructField("price", T.DoubleType())])
    rows = io.read_jsonl(spark, f"{out}/*", schema, "2024-01-05", "2024-01-20", "symbol", "file_path")
    return rounded(rows)


@query("SELECT event_id, ts::DATE AS date, event_type AS symbol, f32(value) AS price, CASE WHEN day(ts) % 2 = 0 THEN 'second' ELSE 'first' END AS run FROM events")
def o11_dated_sink(spark, d):
    """Every day is written, and the even days again by a second run, which replaces only those."""
    out = f"{_work(spark)}/{uuid.uuid4().hex}"
    e = _events(spark, d).select("event_id", "date", "symbol", "price")
    io.write_dated(e.withColumn("run", F.lit("first")), out, "date", ("symbol", "event_id"))
    io.write_dated(e.filter(F.dayofmonth("date") % 2 == 0).withColumn("run", F.lit("second")), out, "date", ("symbol", "event_id"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("symbol", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("run", T.StringType()), T.StructField("date", T.DateType())])
    return rounded(spark.read.schema(schema).parquet(out))


@query("SELECT event_id, event_type AS symbol, f32(value) AS price, CASE WHEN user_id % 3 = 0 THEN NULL ELSE regexp_extract(props, '(\\d+)', 1)::DOUBLE + 1 END AS volume FROM events")
def o06_drifting_csv(spark, d):
    """CSV files of three layouts: columns in another order, or one of them absent."""
    out = _work(spark)
    e = _events(spark, d)
    text = lambda *c: F.concat_ws(",", *[F.col(x).cast("string") for x in c])
    for k, names in enumerate((("event_id", "symbol", "price"), ("symbol", "volume", "event_id", "price"), ("price", "event_id", "volume", "symbol"))):
        rows = e.filter(F.col("user_id") % 3 == k)
        head = spark.range(1).select(F.lit(",".join(names)).alias("value"), F.lit(0).alias("o"))
        head.unionByName(rows.select(text(*names).alias("value"), F.lit(1).alias("o"))).coalesce(1).sortWithinPartitions("o").select("value").write.text(f"{out}/{k}")
    return rounded(io.drifting_csv(spark.read.text(f"{out}/*").select("value", F.col("_metadata.file_path").alias("file")), "event_id", ["event_id", "symbol", "price", "volume"]).select(F.col("event_id").cast("long").alias("event_id"), "symbol", X.number("price").alias("price"), X.number("volume").alias("volume")))


@query("""SELECT o_orderkey, code, position::INT AS position, f32(value) AS value FROM (
 SELECT o_orderkey, 'total' AS code, unnest([0, 1]) AS position, unnest([o_totalprice, o_totalprice * 2]) AS value FROM orders UNION ALL SELECT o_orderkey, 'part', 0, o_custkey FROM orders)""")
def o07_statement_tree(spark, d):
    cell = lambda x: F.struct(x.cast("string").alias("value"))
    child = F.struct(F.lit("part").alias("name"), F.array(cell(F.col("o_custkey"))).alias("data"))
    price = F.col("o_totalprice")
    node = F.array(F.struct(F.lit("total").alias("name"), F.array(cell(price), cell(price * 2)).alias("data"), F.array(child).alias("children")))
    return rounded(io.flatten_tree(read(spark, d, "orders").select("o_orderkey", F.to_json(node).alias("tree")), "o_orderkey", "tree"))


@query(r"SELECT ts, event_type AS symbol, f32(round(value, 2)) AS price, nullif(regexp_extract(props, '(\d+)', 1)::DOUBLE, 0) AS volume FROM events")
def o08_watchlist_rows(spark, d):
    """Polls of one row with headers in two orders, thousands separators, and a price header that is not always there."""
    e = _events(spark, d)
    price, volume = F.format_number("price", 2), (F.col("volume") - 1).cast("int").cast("string")
    a = F.struct(F.array(F.lit("Symbol"), F.lit("Last"), F.lit("Volume")).alias("headers"), F.array(F.array(F.concat(F.lit(" "), "symbol"), price, volume)).alias("rows"))
    b = F.struct(F.array(F.lit("Volume"), F.lit("Symbol"), F.lit("Mark")).alias("headers"), F.array(F.array(volume, F.col("symbol"), price)).alias("rows"))
    m = e.select("ts", F.when(F.col("event_id") % 2 == 0, a).otherwise(b).alias("m")).select("ts", "m.headers", "m.rows")
    return rounded(io.watchlist_rows(m, ["Last", "Mark"], ["Volume"]))


@query("SELECT event_id, event_type AS symbol FROM events WHERE user_id IN (SELECT o_custkey % 100 FROM orders WHERE o_totalprice > 100000)")
def o05_symbol_set(spark, d):
    """Rows of a set of keys: a semi join, so the set may be of any size."""
    wanted = read(spark, d, "orders").filter("o_totalprice > 100000").select((F.col("o_custkey") % 100).alias("user_id")).distinct()
    return _events(spark, d).join(wanted, "user_id", "left_semi").select("event_id", "symbol")


@query("SELECT strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m') AS month, event_type AS symbol, count(*) AS n, f32(sum(value)) AS total FROM events GROUP BY ALL")
def o13_month_publish(spark, d):
    """Rows published by New York month, sorted by symbol and time, read back by month."""
    out = _work(spark)
    io.write_dated(_events(spark, d).withColumn("month", io.month_of(F.col("ts"))), out, "month", ("symbol", "ts"))
    return rounded(spark.read.parquet(out).groupBy(F.col("month").cast("string").alias("month"), "symbol").agg(F.count("*").alias("n"), F.sum("price").alias("total")))


@query(r"SELECT event_type || user_id AS ticker, f32(value) AS open, f32(value) AS close, k + 0.0::DOUBLE AS volume, k % 4 AS trades, CASE WHEN k % 4 > 0 THEN round(k / (k % 4)::DOUBLE) END AS avg_trade_size FROM (SELECT *, regexp_extract(props, '(\d+)', 1)::BIGINT AS k FROM events) WHERE user_id % 9 <> 0")
def o10b_vendor_payload(spark, d):
    k = (F.col("volume") - 1).cast("long")
    raw = _events(spark, d).select(F.when(F.col("user_id") % 9 != 0, F.concat("symbol", F.col("user_id").cast("string"))).alias("t"), F.col("price").alias("o"), F.col("price").alias("c"), k.cast("double").alias("v"), (k % 4).alias("n"))
    return rounded(feeds.rest_bars(raw))


@query("""WITH l AS (SELECT l_suppkey AS ticker, l_linenumber = 1 AS active, l_shipdate::DATE AS delisted FROM lineitem) SELECT ticker, count(*) AS n FROM l WHERE active OR delisted >= DATE '1996-06-01' GROUP BY ticker""")
def o20e_survivors(spark, d):
    rows = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("ticker"), (F.col("l_linenumber") == 1).alias("active"), F.to_date("l_shipdate").alias("delisted"))
    return feeds.survivors(rows, "1996-06-01").groupBy("ticker").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, CASE WHEN max(o_orderdate) < TIMESTAMP '1998-03-01' THEN sum(o_totalprice) END AS value FROM orders GROUP BY 1)
 SELECT max(month) FILTER (WHERE value IS NOT NULL) AS newest, max(month) FILTER (WHERE value IS NOT NULL) < DATE '1998-06-01' AS due FROM s""")
def o20n_freshness(spark, d):
    o = read(spark, d, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    s = o.groupBy(F.to_date(F.date_trunc("month", "at")).alias("month")).agg(F.when(F.max("at") < F.lit("1998-03-01").cast("timestamp"), F.sum("o_totalprice")).alias("value"))
    return feeds.is_due(s, "month", "value", "1998-08-15")


_OUT = ", ".join(f"f32({c}) AS {n}" for n, c in (
    ("unit", "greatest(-10, least(10, ln((1 + actual) / 1) / sigma))"), ("volume_ratio", "ln((symbol + 1) / (grp + 1.0))"), ("band_now", f"CASE WHEN actual < q[1] THEN 0.025 WHEN actual > q[5] THEN 0.975 ELSE {cdf('actual')} END"),
    ("tail", f"CASE WHEN actual < q[1] THEN 0.05 * exp((actual - q[1]) / greatest(q[2] - q[1], 1e-9)) WHEN actual > q[5] THEN 1 - (1 - 0.95) * exp(-(actual - q[5]) / greatest(q[5] - q[4], 1e-9)) ELSE {cdf('actual')} END"),
    ("known", "CASE WHEN grp = 1 THEN actual END"), ("sorted_low", "q[1]"),
))


@query(FORECASTS + f" SELECT symbol, date, {_OUT} FROM fc")
def o92_o98_units_and_bands(spark, d):
    """Price units, log ratios, values behind a flag, quantiles put in order, and a price's place in its forecast with and without tails."""
    f = forecasts(spark, d).withColumn("q", X.monotone(F.reverse("q")))
    return rounded(f.select("symbol", "date", X.price_unit(1 + F.col("actual"), F.lit(1.0), "sigma").alias("unit"), X.log_ratio("symbol", "grp").alias("volume_ratio"), X.percentile_of("q", "actual", TAUS).alias("band_now"), X.cdf_tails("q", "actual", TAUS).alias("tail"), X.known("grp", "actual").alias("known"), F.get("q", F.lit(0)).alias("sorted_low")))


@query("""SELECT l_orderkey, l_linenumber, a >= greatest(o, c) AND b <= least(o, c) AND b > 0 AS fits FROM (SELECT *, l_extendedprice AS o, l_extendedprice * (1 + l_discount) AS c, l_extendedprice * (1 + l_tax) AS a, l_extendedprice * (1 - l_tax) AS b FROM lineitem)""")
def o20i_coherent_bars(spark, d):
    t, p = read(spark, d, "lineitem"), F.col("l_extendedprice")
    return t.select("l_orderkey", "l_linenumber", X.coherent(p, p * (1 + F.col("l_tax")), p * (1 - F.col("l_tax")), p * (1 + F.col("l_discount"))).alias("fits"))


@query("SELECT event_id, CASE user_id % 3 WHEN 0 THEN user_id WHEN 1 THEN user_id * 60 ELSE user_id * 1440 END AS minutes FROM events")
def o102_relative_ages(spark, d):
    unit = F.get(F.array(F.lit("m ago"), F.lit("h ago"), F.lit(" d ago")), (F.col("user_id") % 3).cast("int"))
    text = _events(spark, d).select("event_id", F.concat(F.col("user_id").cast("string"), unit).alias("age"))
    return text.select("event_id", news.age_minutes("age").cast("long").alias("minutes"))


@query("SELECT event_id, ts - INTERVAL 15 MINUTES AS data_until, ts - INTERVAL 15 MINUTES >= date_trunc('day', ts) + INTERVAL 9 HOURS + INTERVAL 30 MINUTES AS complete FROM events")
def o125_completeness(spark, d):
    rows = _events(spark, d).select("event_id", F.col("ts").alias("fetched_at"), F.timestamp_add("MINUTE", F.lit(570), F.date_trunc("day", "ts")).alias("cutoff"))
    return feeds.complete(rows, "cutoff", 15).select("event_id", "data_until", "complete")


@query("""SELECT event_id, k * u AS least, (k + 1) * u AS most, CASE WHEN ts - to_minutes((k * u)::INT) >= stated AND ts - to_minutes(((k + 1) * u)::INT) < stated THEN 'agrees' WHEN stated > ts THEN 'future' ELSE 'differs' END AS verdict FROM (
 SELECT event_id, ts, user_id AS k, CASE user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 60 ELSE 1440 END AS u, CASE event_id % 3 WHEN 0 THEN ts - to_minutes((user_id * CASE user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 60 ELSE 1440 END)::INT) WHEN 1 THEN ts + INTERVAL 1 HOUR ELSE ts - INTERVAL 400 DAYS END AS stated FROM events)""")
def o102_age_bounds(spark, d):
    """The bounds of a relative age, and whether a stated time lies within them."""
    unit = F.get(F.array(F.lit("m ago"), F.lit("h ago"), F.lit(" d ago")), (F.col("user_id") % 3).cast("int"))
    size = F.get(F.array(F.lit(1), F.lit(60), F.lit(1440)), (F.col("user_id") % 3).cast("int"))
    e = _events(spark, d)
    stated = F.when(F.col("event_id") % 3 == 0, F.timestamp_add("MINUTE", -(F.col("user_id") * size).cast("int"), F.col("ts"))).when(F.col("event_id") % 3 == 1, F.timestamp_add("HOUR", F.lit(1), F.col("ts"))).otherwise(F.timestamp_add("DAY", F.lit(-400), F.col("ts")))
    rows = e.select("event_id", "ts", F.concat(F.col("user_id").cast("string"), unit).alias("age"), stated.alias("stated"))
    bounds = news.age_bounds("age")
    return rows.select("event_id", bounds["least"].cast("long").alias("least"), bounds["most"].cast("long").alias("most"), news.reconciled("ts", "age", "stated").alias("verdict"))


@query("""WITH l AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS site, CASE WHEN page_id % 5 = 0 THEN 'stored' WHEN row_number() OVER (PARTITION BY md5(coalesce(html, '')) ORDER BY page_id) > 1 THEN 'duplicate' WHEN length(coalesce(html, '')) < 200 THEN 'failed' ELSE 'new' END AS fate FROM pages)
 SELECT coalesce(site, 'all') AS page, count(*) AS listed, count(*) FILTER (WHERE fate = 'stored') AS stored, count(*) FILTER (WHERE fate = 'new') AS new, count(*) FILTER (WHERE fate = 'duplicate') AS duplicate, count(*) FILTER (WHERE fate = 'failed') AS failed FROM l GROUP BY GROUPING SETS ((site), ())""")
def o222_listing_report(spark, d):
    from pyspark.sql.window import Window

    html = F.coalesce("html", F.lit(""))
    again = F.row_number().over(Window.partitionBy(F.md5(F.encode(html, "UTF-8"))).orderBy("page_id")) > 1
    fate = F.when(F.col("page_id") % 5 == 0, "stored").when(again, "duplicate").when(F.length(html) < 200, "failed").otherwise("new")
    return news.listing_report(read(spark, d, "pages").select(F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1).alias("page"), fate.alias("fate")))
