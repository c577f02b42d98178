"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where none is set (tests), a folder of this machine."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="llm-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(frame: DataFrame, name: str) -> DataFrame:
    """The rows of ``frame``, written once as Parquet; cuts the lineage and survives lost executors."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    rows = frame.sparkSession.read.schema(frame.schema).parquet(path)
    _paths[rows] = path
    return rows


def discard(*tables: DataFrame) -> None:
    """Deletes saved tables once everything made of them is saved itself; a retried task reads what is left."""
    for rows in tables:
        delete(rows.sparkSession, _paths.pop(rows))


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of what is written by now; it waits for the driver's garbage collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
