"""Runs of the pipeline that are visible as a whole or not at all.

The tables of a run are written first. Last comes one small file in the folder
``runs``, which names them all: readers follow these files, so a run that ends
half-way leaves data that nobody sees.
"""

from __future__ import annotations

import json
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import ACCEPTED

_SCHEMA = "run string, at bigint, replaces boolean, kind string, name string, path string, table string"
TABLE, EXTRA = "table", "extra"


def _folder(output: str) -> str:
    return f"{output.rstrip('/')}/runs"


def commit_run(
    spark: SparkSession,
    output: str,
    run: str,
    tables: dict[str, tuple[str, DataFrame]],
    extras: dict[str, tuple[str, DataFrame]],
    replaces: bool,
) -> None:
    """Make a run visible: ``{name: (path, table written there)}``, in one file.

    ``replaces`` hides all runs before it.
    """
    at = time.time_ns()
    rows = [
        (run, at, replaces, kind, name, path, df.schema.json())
        for kind, found in ((TABLE, tables), (EXTRA, extras))
        for name, (path, df) in found.items()
    ]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(_folder(output))


def committed_runs(spark: SparkSession, output: str) -> list:
    """The rows of the runs that count, oldest first: a row per table of a run."""
    try:
        listed = spark.read.schema(_SCHEMA).parquet(_folder(output))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    rows = listed.orderBy("at", "run", "kind", "name").collect()  # a few per run
    start = max((r.at for r in rows if r.replaces), default=0)
    return [r for r in rows if r.at >= start]


def read_table(spark: SparkSession, row) -> DataFrame:
    """The table that a row of ``committed_runs`` names."""
    schema = T.StructType.fromJson(json.loads(row.table))
    if row.kind == EXTRA:
        return spark.read.schema(schema).parquet(row.path)
    # Only the folders of this run: others may lie below the same path.
    found = None
    for value in ("true", "false"):
        try:
            rest = T.StructType([f for f in schema if f.name != ACCEPTED])
            part = spark.read.schema(rest).parquet(f"{row.path}/{ACCEPTED}={value}")
        except AnalysisException as e:  # no row was kept, or none was rejected
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        part = part.withColumn(ACCEPTED, F.lit(value == "true"))
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)
