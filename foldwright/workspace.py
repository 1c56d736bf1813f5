"""Intermediate tables in the shared folder of the cluster.

A fitted encoder is read many times, so it is written once as parquet: the
lineage ends there, its size is known before a join is planned, and a lost
executor costs a re-read and not a re-fit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir_setting(spark: SparkSession) -> str | None:
    context = spark.sparkContext
    return spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING) or context.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor must be able to reach."""
    folder = shared_dir_setting(spark)
    if not folder:
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/foldwright/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and return the stored table."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
