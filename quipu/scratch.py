"""Shared scratch folders."""

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir).

    Only a local session may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="quipu-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def enable_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def release_shuffles(spark: SparkSession) -> None:
    """Collects the driver's garbage: only then Spark removes the shuffle files of what has ended."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
