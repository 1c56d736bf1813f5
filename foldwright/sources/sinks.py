"""Feature tables and submissions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_features(df: DataFrame, path: str) -> None:
    """One table for train and test, partitioned by ``split`` so either reads alone."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def load_features(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.filter(F.col("split") == split) if split else table


def submission(predictions: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Long predictions as one column per target, with the row key kept."""
    return predictions.groupBy("row_id").pivot("target", list(targets)).agg(F.avg("prediction"))


def write_submission(predictions: DataFrame, targets: Sequence[str], path: str) -> None:
    """CSV files in row order; the range sort keeps the part files in that order too."""
    submission(predictions, targets).orderBy("row_id").write.mode("overwrite").csv(path, header=True)
