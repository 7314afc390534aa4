"""A session with the settings this library expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, name: str = "waybill") -> SparkSession:
    """A local session for tests and measurements.

    On a cluster use the session at hand: the library relies on adaptive
    execution (Spark's default) and on ``spark.checkpoint.dir``.
    """
    cores = cores or os.cpu_count() or 1
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.caseSensitive", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "localhost")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
