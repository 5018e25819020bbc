"""Readers and writers of feeds: column maps, schema evolution, vintages, upserts, dated partitions, compaction and checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marketloom.functions.expr import null_if_nan, number
from marketloom.operators.asof import in_window, latest


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, since: str | None = None, until: str | None = None, key: str | None = None, dated: str = "file_name") -> DataFrame:
    """O-01: JSON lines whose file names (or paths: dated) carry a date, within [since, until]; rows without a key are dropped."""
    df = spark.read.schema(schema).json(path)
    day = F.to_date(F.regexp_extract(F.col(f"_metadata.{dated}"), r"(\d{4}-\d{2}-\d{2})", 1).try_cast("date"))
    df = df.select("*", day.alias("file_date"))
    for bound, keep in ((since, F.col("file_date") >= F.lit(since)), (until, F.col("file_date") <= F.lit(until))):
        df = df.filter(keep) if bound else df
    return df.filter(F.col(key).isNotNull()) if key else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """O-16: exactly the columns of a schema; absent ones are typed NULLs, NaN becomes NULL."""
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType)
        out.append((null_if_nan(c) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c).alias(f.name))
    return df.select(*out)


def with_provenance(df: DataFrame, source: str, run_id: str) -> DataFrame:
    """O-11: provenance columns."""
    return df.withColumns({"_source": F.lit(source), "_ingested_at": F.current_timestamp(), "_run_id": F.lit(run_id)})


def write_dated(df: DataFrame, path: str, date: str = "date", sort: tuple[str, ...] = (), most_rows: int = 20_000_000) -> None:
    """O-11..O-14, O-80: a folder for each date; a date that is written again replaces the old one, others stay.

    With a sort order, rows are range-partitioned by date and that order, so a large day is spread over tasks; its files are sorted, and follow one another in the order. No file has more than
    most_rows rows.
    """
    out = df.repartitionByRange(F.col(date), *[F.col(c) for c in sort]).sortWithinPartitions(date, *sort) if sort else df.repartition(F.col(date))
    out.write.option("maxRecordsPerFile", most_rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def publish_dated(rows: DataFrame, path: str, expected: int, date: str = "date", sort: tuple[str, ...] = ()) -> DataFrame:
    """O-14, O-15: the days of rows, published under path only if exactly `expected` rows were written; a day that is published again replaces its old folder, others stay. Returns what the path then holds.

    Days are written beside the published ones, in a folder that readers skip, counted from the files, and then renamed one by one (the driver renames a folder a day; a reader of the very day that is renamed may miss it).
    A wrong count raises ValueError and leaves the published days as they were.
    """
    spark = rows.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root, work = hadoop(path), hadoop(f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        write_dated(rows, work.toString(), date, sort)
        written = spark.read.schema(rows.schema).parquet(work.toString()).count()
        if written != expected:
            raise ValueError(f"{written} rows were written instead of {expected}")
        for day in fs.listStatus(work):
            if day.isDirectory():
                target = hadoop(root, day.getPath().getName())
                fs.delete(target, True)
                if not fs.rename(day.getPath(), target):
                    raise OSError(f"{target.toString()} was not published")
    finally:
        fs.delete(work, True)
    return spark.read.schema(rows.schema).parquet(path)


def finalize_days(points: DataFrame, windows: DataFrame, at: str, start: str, end: str, path: str, sort: tuple[str, ...] = ()) -> DataFrame:
    """O-14: points routed to the session windows [start, end) that hold them and published by the window's date.

    A point in no window fails the job, and so does one in two (the count of rows differs): nothing is published then.
    """
    routed = in_window(points, windows, at, start, end, strict=True).withColumn("date", F.to_date(start)).drop(start, end)
    return publish_dated(routed, path, points.count(), "date", sort)


def compact_days(rows: DataFrame, path: str, keys: list[str], order: list[Column], date: str = "date") -> tuple[DataFrame, DataFrame]:
    """O-15: rows without repeated keys, published by day and sorted by key, and the report of `compact`, whose distinct count they have to match."""
    out, report = compact(rows, keys, order)
    return publish_dated(out, path, report.first()["n_distinct"] or 0, date, tuple(k for k in keys if k != date)), report


def merge_keep_old(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """O-12: new rows win for their keys; keys that only old has are kept."""
    both = old.withColumn("__p", F.lit(1)).unionByName(new.withColumn("__p", F.lit(0)), allowMissingColumns=True)
    return latest(both, keys, [F.col("__p")]).drop("__p")


def coalesce_merge(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """O-02, O-126: new non-null values win, NULLs never wipe old ones, keys of either side stay."""
    values = [c for c in old.columns if c not in keys]
    a, b = old.alias("a"), new.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    pick = lambda c: F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) if c in new.columns else F.col(f"a.{c}").alias(c)
    return a.join(b, on, "full").select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys], *map(pick, values))


def upsert(rows: DataFrame, key: str, rules: dict[str, str], order: str) -> DataFrame:
    """O-19: one row for each key with a rule for each column: last (by order), least, greatest or first_known."""
    make = {
        "last": lambda c: F.max_by(c, order),
        "least": lambda c: F.min(c),
        "greatest": lambda c: F.max(c),
        "first_known": lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))),
    }
    return rows.groupBy(key).agg(*[make[rule](c).alias(c) for c, rule in rules.items()])


def refresh_window(old: DataFrame, fetched: DataFrame, key: str, date: str, since) -> DataFrame:
    """O-19b: for fetched keys, rows from `since` on become what was fetched; other keys and earlier rows stay."""
    inside = fetched.select(key).distinct().withColumn("__hit", F.lit(True))
    kept = old.join(inside, key, "left").filter(F.col("__hit").isNull() | (F.col(date) < F.lit(since))).drop("__hit")
    return kept.unionByName(fetched.filter(F.col(date) >= F.lit(since)))


def vintages(rows: DataFrame, key: str, fetched: str, value: str, first: bool) -> DataFrame:
    """O-18: the first (or latest) vintage of each key that has a value."""
    order = F.col(fetched).asc() if first else F.col(fetched).desc()
    return latest(rows.filter(F.col(value).isNotNull()), [key], [order, F.col(value)])


def compact(rows: DataFrame, keys: list[str], order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """O-15: rows without repeated keys, and a report (rows, distinct rows, duplicates) as a DataFrame."""
    out = latest(rows, keys, order)
    report = rows.groupBy(*keys).count().agg(F.sum("count").alias("n_rows"), F.count("*").alias("n_distinct"), (F.sum("count") - F.count("*")).alias("n_duplicates"))
    return out, report


def violations(rows: DataFrame, key: str, required: list[str], ranges: dict[str, tuple[float, float]], enums: dict[str, list[str]]) -> DataFrame:
    """O-17: every broken rule of every row: key, rule."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c}: required")) for c in required]
    checks += [F.when(~F.col(c).between(a, b), F.lit(f"{c}: range")) for c, (a, b) in ranges.items()]
    checks += [F.when(~F.col(c).isin(v), F.lit(f"{c}: enum")) for c, v in enums.items()]
    return rows.select(key, F.explode(F.array_compact(F.array(*checks))).alias("rule"))


def diff(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """O-85: for each key whether it is on both sides, and the names of the fields that differ."""
    a, b = left.withColumn("__l", F.lit(1)).alias("a"), right.withColumn("__r", F.lit(1)).alias("b")
    j = a.join(b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "full")
    status = F.when(F.col("__r").isNull(), "only_left").when(F.col("__l").isNull(), "only_right").otherwise("both")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]))
    return j.select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys], status.alias("status"), F.when(status == "both", F.array_join(changed, ",")).alias("changed"))


def watchlist_rows(messages: DataFrame, prices: list[str], zero_is_null: list[str]) -> DataFrame:
    """O-08: polls with named headers and rows of texts (ts, headers, rows) as one row for each symbol.

    Columns are found by header, the first price header that is present wins, and 0 means NULL in some fields.
    """
    rows = messages.select("ts", "headers", F.explode("rows").alias("row"))
    cell = lambda name: F.get("row", (F.array_position("headers", name) - 1).cast("int"))
    value = lambda name: F.nullif(number(cell(name)), F.lit(0.0)) if name in zero_is_null else number(cell(name))
    price = F.coalesce(*[F.when(F.array_contains("headers", p), value(p)) for p in prices])
    return rows.select("ts", F.btrim(cell("Symbol")).alias("symbol"), price.alias("price"), value("Volume").alias("volume")).filter("symbol <> ''")


def flatten_tree(rows: DataFrame, key: str, tree: str) -> DataFrame:
    """O-07: (key, code, position, value) of a two-level statement tree given as JSON text."""
    node = "struct<name:string,data:array<struct<value:string>>,children:array<struct<name:string,data:array<struct<value:string>>>>>"
    parsed = rows.select(key, F.explode(F.from_json(tree, f"array<{node}>")).alias("n"))
    flat = parsed.select(key, F.explode(F.concat(F.array(F.struct(F.col("n.name").alias("name"), F.col("n.data").alias("data"))), F.coalesce(F.col("n.children"), F.array().cast("array<struct<name:string,data:array<struct<value:string>>>>")))).alias("x"))
    return flat.select(key, F.col("x.name").alias("code"), F.posexplode("x.data").alias("position", "v")).select(key, "code", "position", number("v.value").alias("value"))


def month_of(ts: Column) -> Column:
    """O-13: New York month of a UTC time, the partition of published bars."""
    return F.date_format(F.from_utc_timestamp(ts, "America/New_York"), "yyyy-MM")


def poll_index(rows: DataFrame, day: str, ts: str) -> DataFrame:
    """O-06: feed_seq, the dense index of a poll's time in its day, from 0."""
    return rows.withColumn("feed_seq", F.dense_rank().over(Window.partitionBy(day).orderBy(ts)) - 1)


def drifting_csv(lines: DataFrame, key: str, names: list[str]) -> DataFrame:
    """O-06: rows of CSV files whose headers drift: each file's own header says where a column is; absent columns are NULL.

    lines: file, value (plain cells without quotes). A line that holds the key column's name as a cell is a header; one row for each file,
    so headers meet the lines by an equality join on the file.
    """
    cells = lines.select("file", F.split("value", ",").alias("cells"))
    is_head = F.array_contains("cells", key)
    heads = cells.filter(is_head).groupBy("file").agg(F.first("cells").alias("head"))
    rows = cells.filter(~is_head).join(heads, "file")
    at = lambda n: F.when(F.array_contains("head", n), F.nullif(F.get("cells", (F.array_position("head", n) - 1).cast("int")), F.lit("")))
    return rows.select(*[at(n).alias(n) for n in names])
