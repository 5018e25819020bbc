"""Sessions, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ARROW_ROWS = 1000

_shipped: set[str] = set()


def session(master: str = "local[8]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings that the operators assume: UTC and adaptive execution."""
    builder = SparkSession.builder.master(master).appName("marketloom")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to executors, once in each application, so that tasks can import it.

    Batches for Python are set to ARROW_ROWS rows where the session has Spark's default: texts can be long, and a batch is held on
    both sides.
    """
    app = spark.sparkContext.applicationId
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    if app not in _shipped:
        top = Path(__file__).resolve().parent
        fd, name = tempfile.mkstemp(prefix="marketloom-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(name, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        spark.sparkContext.addPyFile(name)
        _shipped.add(app)
    return spark
