"""Queries of readers' and writers' table work."""

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marketloom.operators import asof, feeds
from marketloom.plans.base import BARS, bars, query, read, rounded, trades
from marketloom.sources import io
from marketloom.staging import shared_path


@query("WITH v AS (SELECT o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_totalprice IS NOT NULL) SELECT a.o_custkey, f32(a.p) AS first_price, f32(b.p) AS last_price FROM (SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_totalprice)) AS p FROM v GROUP BY 1) a JOIN (SELECT o_custkey, arg_min(o_totalprice, (-epoch_us(o_orderdate), o_totalprice)) AS p FROM v GROUP BY 1) b USING (o_custkey)")
def o18_vintages(spark, d):
    o = read(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    first, last = (io.vintages(o, "o_custkey", "o_orderdate", "o_totalprice", f) for f in (True, False))
    return rounded(first.select("o_custkey", F.col("o_totalprice").alias("first_price")).join(last.select("o_custkey", F.col("o_totalprice").alias("last_price")), "o_custkey"))


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey, f32(min(o_totalprice)) AS least, f32(max(o_totalprice)) AS most FROM orders GROUP BY 1")
def o19_upsert(spark, d):
    o = read(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("least"), F.col("o_totalprice").alias("most"))
    return rounded(io.upsert(o, "o_custkey", {"o_orderkey": "last", "least": "least", "most": "greatest"}, "o_orderkey"))


@query("""WITH o AS (SELECT c_custkey AS k, c_acctbal AS v, c_mktsegment AS s FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal * 2 END AS v FROM customer WHERE c_custkey % 5 = 0)
 SELECT coalesce(o.k, n.k) AS k, f32(coalesce(n.v, o.v)) AS v, o.s FROM o FULL JOIN n ON o.k = n.k""")
def o02_coalesce_merge(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.col("c_mktsegment").alias("s"))
    new = c.filter("k % 5 = 0").select("k", F.when(F.col("k") % 2 == 0, F.col("v") * 2).alias("v"))
    return rounded(io.coalesce_merge(c.filter("k % 3 <> 0"), new, ["k"]))


@query("SELECT c_custkey AS k, f32(CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END) AS v FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def o12_partition_merge(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return rounded(io.merge_keep_old(c.filter("k % 3 = 0"), c.filter("k % 2 = 0").withColumn("v", F.col("v") + 1), ["k"]))


@query("""WITH o AS (SELECT o_custkey AS k, o_orderdate::DATE AS date, o_orderkey AS id FROM orders), f AS (SELECT * FROM o WHERE k % 4 = 0 AND id % 2 = 0)
 SELECT * FROM o WHERE k NOT IN (SELECT k FROM f) OR date < DATE '1997-01-01' UNION ALL SELECT * FROM f WHERE date >= DATE '1997-01-01'""")
def o19b_refresh_window(spark, d):
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("id"))
    return io.refresh_window(o, o.filter("k % 4 = 0 AND id % 2 = 0"), "k", "date", F.to_date(F.lit("1997-01-01")))


@query("""SELECT l_orderkey, rule, count(*) AS n FROM (SELECT l_orderkey, unnest([CASE WHEN NOT l_quantity BETWEEN 1 AND 40 THEN 'l_quantity: range' END, CASE WHEN NOT l_returnflag IN ('A', 'N') THEN 'l_returnflag: enum' END, CASE WHEN l_shipdate IS NULL THEN 'l_shipdate: required' END]) AS rule FROM lineitem) WHERE rule IS NOT NULL GROUP BY ALL""")
def o17_schema_violations(spark, d):
    return io.violations(read(spark, d, "lineitem"), "l_orderkey", ["l_shipdate"], {"l_quantity": (1, 40)}, {"l_returnflag": ["A", "N"]}).groupBy("l_orderkey", "rule").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT s_suppkey AS k, s_acctbal AS v, s_nationkey AS n FROM supplier WHERE s_suppkey % 5 <> 0), b AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 7 = 0 THEN s_acctbal + 1 ELSE s_acctbal END AS v, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE s_nationkey END AS n FROM supplier WHERE s_suppkey % 3 <> 0)
 SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'only_left' WHEN a.k IS NULL THEN 'only_right' ELSE 'both' END AS status,
 CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN concat_ws(',', CASE WHEN a.v IS DISTINCT FROM b.v THEN 'v' END, CASE WHEN a.n IS DISTINCT FROM b.n THEN 'n' END) END AS changed FROM a FULL JOIN b ON a.k = b.k""")
def o85_root_diff(spark, d):
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"), F.col("s_nationkey").cast("long").alias("n"))
    right = s.filter("k % 3 <> 0").select("k", F.when(F.col("k") % 7 == 0, F.col("v") + 1).otherwise(F.col("v")).alias("v"), F.when(F.col("k") % 4 == 0, F.lit(0)).otherwise(F.col("n")).alias("n"))
    return io.diff(s.filter("k % 5 <> 0"), right, ["k"], ["v", "n"])


@query("SELECT event_id, ts::DATE AS date, dense_rank() OVER (PARTITION BY ts::DATE ORDER BY ts)::INT - 1 AS feed_seq, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m') AS month FROM events")
def o06_o13_poll_index(spark, d):
    e = read(spark, d, "events").select("event_id", F.to_date("ts").alias("date"), F.col("ts").cast("timestamp").alias("ts"))
    return io.poll_index(e, "date", "ts").select("event_id", "date", "feed_seq", io.month_of(F.col("ts")).alias("month"))


@query("SELECT count(*) AS n_rows, count(DISTINCT (l_suppkey, l_shipdate)) AS n_distinct, count(*) - count(DISTINCT (l_suppkey, l_shipdate)) AS n_duplicates FROM lineitem")
def o15_compaction_report(spark, d):
    t = read(spark, d, "lineitem")
    return io.compact(t, ["l_suppkey", "l_shipdate"], [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice")])[1]


@query("SELECT event_id, value AS price, NULL::BIGINT AS trades, user_id::INT AS user_id FROM events")
def o16_conform(spark, d):
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("trades", T.LongType()), T.StructField("user_id", T.IntegerType())])
    return io.conform(read(spark, d, "events").withColumnRenamed("value", "price"), schema)


@query("""WITH w AS (SELECT day AS start_ts, day + INTERVAL 8 HOURS AS end_ts, row_number() OVER (ORDER BY day) AS win FROM (SELECT DISTINCT date_trunc('day', ts) + INTERVAL 9 HOURS AS day FROM events)) SELECT e.event_id, w.win FROM events e LEFT JOIN w ON e.ts >= w.start_ts AND e.ts < w.end_ts""")
def o14_o32_window_lookup(spark, d):
    from pyspark.sql.window import Window

    e = read(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    days = e.select(F.timestamp_add("HOUR", F.lit(9), F.date_trunc("day", "ts")).alias("start_ts")).distinct()
    w = days.select("start_ts", F.timestamp_add("HOUR", F.lit(8), F.col("start_ts")).alias("end_ts"), F.row_number().over(Window.orderBy("start_ts")).cast("long").alias("win"))
    return asof.in_window(e, w, "ts", "start_ts", "end_ts").select("event_id", "win")


@query(BARS + " SELECT symbol, arg_max(date, (trades, date)) AS busiest FROM bars GROUP BY symbol")
def o20f_listing_pick(spark, d):
    return asof.latest(bars(spark, d), ["symbol"], [F.desc("trades"), F.desc("date")]).select("symbol", F.col("date").alias("busiest"))


_KINDS = ["Corp", "Notes due 2031", "6.5% Pfd Series A", "Growth Fund", "Rights", "Brights and Prefunded Co", "Depositary Shares", "Subordinated Debenture"]


@query(r"""WITH n AS (SELECT p_partkey, p_name || ' ' || (""" + str(_KINDS) + r""")[p_partkey % 8 + 1] AS name FROM part)
 SELECT p_partkey, CASE WHEN regexp_matches(name, '(?i)\bnotes?\b|\bdue \d{4}\b|debenture|subordinated') THEN 'note' WHEN regexp_matches(name, '(?i)preferred|depositary|\bpfd\b') THEN 'preferred' WHEN regexp_matches(name, '(?i)\bfund\b') THEN 'fund' WHEN regexp_matches(name, '(?i)\brights?\b') THEN 'rights' END AS reason FROM n""")
def o20b_exclusions(spark, d):
    kind = F.get(F.array(*[F.lit(k) for k in _KINDS]), (F.col("p_partkey") % 8).cast("int"))
    named = read(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", kind).alias("name"))
    return named.select("p_partkey", feeds.exclusion("name").alias("reason"))


@query("SELECT event_id, ts, ts::DATE AS date, dense_rank() OVER (ORDER BY ts::DATE) AS win FROM events")
def o14_published_days(spark, d):
    """Every event in its day's window, published by day and read back."""
    e = read(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    days = e.select(F.date_trunc("day", "ts").alias("start_ts")).distinct()  # a row a day
    w = days.select("start_ts", F.timestamp_add("DAY", F.lit(1), F.col("start_ts")).alias("end_ts"), F.row_number().over(Window.orderBy("start_ts")).cast("long").alias("win"))
    return io.finalize_days(e, w, "ts", "start_ts", "end_ts", shared_path(spark, "days"), ("ts", "event_id"))


@query(BARS + " SELECT symbol, date, f32(arg_min(price, (seq1, seq2, price))) AS price, min(seq1) AS seq1 FROM t GROUP BY symbol, date")
def o15_compacted_days(spark, d):
    """The first trade of each symbol and day, published by month (the days are many and small) and read back."""
    t = trades(spark, d).withColumn("month", F.date_trunc("month", "date").cast("date"))
    out, _ = io.compact_days(t, shared_path(spark, "compacted"), ["symbol", "date"], [F.col("seq1"), F.col("seq2"), F.col("price")], "month")
    return rounded(out.select("symbol", "date", "price", "seq1"))
