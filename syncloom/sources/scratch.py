"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that spark.checkpoint.dir names; only a local session without that setting (tests) gets a temporary folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return f"{context.getCheckpointDir()}/{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
