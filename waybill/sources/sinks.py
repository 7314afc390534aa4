"""Writing modelled tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCEPTED = "accepted"
# Files that a task keeps open; unless set, it sorts its rows by folder instead.
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write one table as parquet and return it as read back."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_flagged(flagged: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write checked rows once, kept and rejected rows in folders of their own.

    No shuffle and no sort: every task writes at most two files, side by side.
    ``accepted=true`` below ``path`` is the clean table.
    """
    spark = flagged.sparkSession
    marked = flagged.withColumn(ACCEPTED, F.col("reject_reason").isNull())
    given = spark.conf.get(_WRITERS, None)
    spark.conf.set(_WRITERS, 2)
    try:
        marked.write.mode(mode).partitionBy(ACCEPTED).parquet(path)
    finally:
        spark.conf.unset(_WRITERS) if given is None else spark.conf.set(_WRITERS, given)
    return spark.read.schema(marked.schema).parquet(path)
