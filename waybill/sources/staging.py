"""Intermediate tables kept in the shared folder of the cluster.

A staged table is computed once and survives the loss of executors, and what
is read back from it has a short plan. The folder is the session's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


_TOGETHER = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders made for local sessions without a setting, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The folder for this application's staged tables."""
    application = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: staged tables need a folder "
                "that every executor can reach"
            )
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="waybill-")
        root = _LOCAL_FOLDERS[application]
    return f"{root.rstrip('/')}/waybill/{application}"


def new_staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _unless_set(spark: SparkSession, settings: dict) -> Iterator[None]:
    ours = {k: v for k, v in settings.items() if spark.conf.get(k, None) is None}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in ours:
            spark.conf.unset(k)


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, what an action has shuffled is deleted after it, unless the session says otherwise.

    Else it stays on the executors' disks until the driver happens to collect its garbage.
    """
    return _unless_set(spark, {_FREED: "true"})


def stage(df: DataFrame, label: str, task_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once as parquet and return a DataFrame reading it back.

    ``task_bytes``: up to how much adaptive execution puts small shuffled parts
    together for a task of this write, unless the session says how much.
    """
    spark = df.sparkSession
    path = new_staging_path(spark, label)
    together = {} if task_bytes is None else {_TOGETHER: task_bytes}
    with shuffles_freed(spark), _unless_set(spark, together):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the staged files that ``df`` reads; of other files nothing is touched."""
    spark = df.sparkSession
    root = staging_root(spark)
    context = spark.sparkContext
    for name in df.inputFiles():
        at = name.find(root.removeprefix("file:").lstrip("/"))
        if at >= 0:
            path = context._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, False)


def clear_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables; results read from them end too."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
