"""Registration of queries, and the market tables that queries derive from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import daily

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def expanded(sql: str) -> str:
    """SQL with f32(x) and lnp(x) written out.

    f32: x in single precision, so that sums in another order compare equal. lnp: the logarithm of a ratio, NULL where the ratio is 0 or its divisor is 0: a price of
    0 has no log change. It is the rule of F.ln(ratio(a, b)); DuckDB's ln gives infinities there.
    """
    for name, written in (("f32(", "CAST(CAST(ROUND({0}, 10) AS FLOAT) AS DOUBLE)"), ("lnp(", "CASE WHEN isfinite({0}) AND {0} > 0 THEN ln({0}) END")):
        while (at := sql.find(name)) >= 0:
            end, depth = at + 4, 1
            while depth:
                depth += {"(": 1, ")": -1}.get(sql[end], 0)
                end += 1
            sql = sql[:at] + written.replace("{0}", f"({sql[at + 4 : end - 1]})") + sql[end:]
    return sql


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name, with SQL for the same rows."""

    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = expanded(sql)
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame) -> DataFrame:
    """Doubles in single precision, as f32() in the SQL."""
    return df.select(*[F.round(F.col(c), 10).cast("float").cast("double").alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as trades: supplier = symbol, ship date = date."""
    t = read(spark, sf_dir, "lineitem")
    return t.select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("volume"), F.col("l_orderkey").alias("seq1"), F.col("l_linenumber").alias("seq2"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.calendar(trades(spark, sf_dir).select("date"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The calendar has one row for each session.
    return daily.daily_bars(trades(spark, sf_dir)).join(F.broadcast(sessions(spark, sf_dir).select("date", "day_idx")), "date")


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, weight, industry, sector) from supplier, nation and region."""
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    nations = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return s.join(F.broadcast(nations), s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").alias("symbol"), F.col("s_acctbal").alias("weight"), F.col("n_name").alias("industry"), F.col("r_name").alias("sector"))


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, order, at, form) from orders, through their line items."""
    o, t = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    # Dealt by order once: both the distinct lines and the join keep it.
    lines = t.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("symbol")).repartition("o_orderkey").distinct()
    return o.join(lines, "o_orderkey").select("symbol", F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("at"), F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("form"))


BARS = """
WITH t AS (
  SELECT l_suppkey AS symbol, l_shipdate::DATE AS date, l_extendedprice / l_quantity AS price, l_quantity AS volume, l_orderkey AS seq1, l_linenumber AS seq2 FROM lineitem
), sessions AS (
  SELECT date, row_number() OVER (ORDER BY date)::INT AS day_idx FROM (SELECT DISTINCT date FROM t)
), bars AS (
  SELECT b.*, s.day_idx FROM (
    SELECT symbol, date, arg_min(price, (seq1, seq2, price)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (seq1, seq2, price)) AS close,
           sum(volume) AS volume, sum(price * volume) / sum(volume) AS vwap, count(*) AS trades FROM t GROUP BY symbol, date) b JOIN sessions s USING (date)
), sectors AS (
  SELECT s_suppkey AS symbol, s_acctbal AS weight, n_name AS industry, r_name AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), releases AS (
  SELECT DISTINCT l_suppkey AS symbol, o_orderkey AS order_key, o_orderdate AS rel_at, o_orderdate::DATE AS date, o_orderpriority AS form FROM orders JOIN lineitem ON o_orderkey = l_orderkey
)"""
