"""Shared scratch space for tables a job writes and reads back, and for stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the one named by ``spark.checkpoint.dir``, else the context's checkpoint folder. Only a
    local session (one machine) may do without and gets a temporary folder; on a cluster that
    would lose data without a word, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    given = context.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not context.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="clickloom-")


def work_path(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A new path under ``root``, by default the shared folder."""
    return f"{(root or shared_root(spark)).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path that this library wrote, on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder that this library wrote; its new parent is made if missing."""
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    if fs.exists(source) and not fs.rename(source, target):
        raise OSError(f"cannot rename {path} to {to}")


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write a frame that several results share to a table and read it back.

    Unlike a cached frame the table outlives lost executors, and it cuts the lineage. The
    schema is taken from the frame, so reading it back infers nothing.
    """
    path = path or work_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder for the tables of one job, deleted when the job has used them."""
    path = work_path(spark, label)
    try:
        yield path
    finally:
        remove(spark, path)
