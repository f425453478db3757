"""Lineage cuts that survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's ``spark.checkpoint.dir``, or the one its context was given.

    Only a local-mode session (tests) may go without; there a fresh temporary folder is used.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spineloom-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def passing_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate data: its filesystem deletes what is there when the session's JVM ends."""
    path = fresh_path(spark, purpose)
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(df: DataFrame, purpose: str = "table") -> DataFrame:
    """Compute a table once, as Parquet in the shared folder, and read it back with a short lineage."""
    path = passing_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """Compute a small fitted table once and keep it on shared storage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
