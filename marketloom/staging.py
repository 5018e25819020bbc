"""Tables that are written once to the folder that driver and executors share, and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes of a table that is broadcast, as its rows take in a hash relation.
MOST_BROADCAST_BYTES = 32 << 20


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under spark.checkpoint.dir (a local master may leave it unset); it is deleted when the session's JVM ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/marketloom"
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of df, computed once: lineage is cut, and later uses read the table."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, most_bytes: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its rows, counted, take at most most_bytes (64 each, and 16 with the text itself for a string column); else unchanged, so that the join shuffles."""
    strings = [F.octet_length(c) + 16 for c, t in df.dtypes if t == "string"]
    held = df.agg(F.sum(sum((F.coalesce(x, F.lit(16)) for x in strings), F.lit(64)).cast("long"))).first()[0] or 0
    return F.broadcast(df) if held <= most_bytes else df
