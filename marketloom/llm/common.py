"""Pieces that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, StructType, TimestampType

#: Code points 0x20 and 0x09-0x0D, the white space of the text contracts.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir. Only a local master (one machine) may leave it unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[\d*, ]+\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/marketloom"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; it is deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read again.

    It cuts the lineage: what follows does not depend on shuffle files of executors that may be lost, and a table that
    is used twice is computed once.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Most bytes of a table that is broadcast, as its rows take in a hash relation.
MOST_BROADCAST_BYTES = 32 << 20


def row_bytes(kind: DataType) -> int:
    """About the bytes of a value in a hash relation; strings, binaries and arrays count as 64 (the sides are keys and digests)."""
    if isinstance(kind, StructType):
        return 48 + sum(row_bytes(f.dataType) for f in kind.fields)
    return 8 if isinstance(kind, (NumericType, BooleanType, DateType, TimestampType)) else 64


def small_side(df: DataFrame, most_bytes: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its rows, counted, take at most most_bytes; else unchanged (Spark then shuffles).

    Meant for staged tables of fixed-width columns and short keys, never for texts: the count reads little more than file footers,
    and what is broadcast never exceeds the bound, whatever the input.
    """
    return F.broadcast(df) if df.count() * row_bytes(df.schema) <= most_bytes else df


#: Hadoop's names of object stores, and those of Arrow's file systems.
STORES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfs"}


def store_of(folder: str):
    """(Arrow file system, path) of a folder that is named as Spark names it."""
    from pyarrow import fs

    scheme, mark, rest = folder.partition("://")
    return fs.FileSystem.from_uri(f"{STORES.get(scheme, scheme)}://{rest}" if mark else folder)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def hash32(*parts: Column | str) -> Column:
    """A portable 32-bit hash (first 8 hex digits of MD5 over '|'-joined parts), the same in other SQL engines."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *columns)), 1, 8), 16, 10).cast("long")


def gives_back(make):
    """make, a generator over the Arrow batches of a partition, that returns freed memory to the system when the partition ends.

    Python workers are reused: without it each keeps the peak of every kind of task that it ever ran (about 100 MB more).
    """

    @wraps(make)
    def run(*args, **kwargs):
        try:
            yield from make(*args, **kwargs)
        finally:
            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim:
                trim(0)

    return run
