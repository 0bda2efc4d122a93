"""Scratch storage that every executor can reach and that outlives any of them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tablewright.sources.folders import Folders


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the one the context was given.

    Only a local session that names neither gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tablewright-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/scratch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove all that this application has set aside; for its end, when no DataFrame reads it any more."""
    folder = f"{shared_folder(spark)}/scratch/{spark.sparkContext.applicationId}"
    Folders(spark, folder).remove(folder)


def set_aside(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once, and go on from the table.

    Unlike a checkpoint it computes nothing twice and is read by column.
    """
    spark, names = df.sparkSession, [f"c{i}" for i in range(len(df.columns))]
    path = scratch_path(spark, "rows")
    plain = df.toDF(*names)
    plain.write.parquet(path)
    return spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared_folder(df.sparkSession)
    return df.checkpoint()
