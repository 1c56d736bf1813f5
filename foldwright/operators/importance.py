"""Feature importance of fitted models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import box_summary


def top_features(importance: DataFrame, k: int = 50) -> DataFrame:
    """``feature, total`` of the ``k`` features with the highest importance summed over models."""
    return (
        importance.groupBy("feature")
        .agg(F.sum("importance").alias("total"))
        .orderBy(F.desc("total"), "feature")
        .limit(k)
    )


def importance_topk(importance: DataFrame, k: int = 50) -> DataFrame:
    """The rows (feature, model_no, importance) of the ``k`` top features."""
    # at most k rows
    return importance.join(F.broadcast(top_features(importance, k).select("feature")), "feature", "left_semi")


def importance_boxes(importance: DataFrame, k: int = 50) -> DataFrame:
    """Box summary of the top features' importance over models."""
    return box_summary(importance_topk(importance, k), "importance", ["feature"])
