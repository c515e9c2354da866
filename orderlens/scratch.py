"""Intermediate tables in the folder that every executor can reach.

A staged table is a committed Parquet write: losing an executor afterwards costs
nothing, and later passes read the very same rows in the very same blocks.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_staged: dict[str, list[str]] = {}
_MACHINE_FOLDERS = ("/tmp/", "/var/tmp/", "/dev/shm/")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured and not context.master.startswith("local"):
        if configured.removeprefix("file://").removeprefix("file:").startswith(_MACHINE_FOLDERS):
            raise RuntimeError(f"{configured} is a folder of one machine; name a shared one")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="orderlens-")
    folder = _local_folders[context.applicationId]
    context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` once and return a reader of the written table."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the staged tables of this application once its results are committed.

    Frames that still read a staged table cannot be used afterwards.
    """
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove(spark, path)
    return len(paths)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one folder below the shared folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    folder.getFileSystem(settings).delete(folder, True)
