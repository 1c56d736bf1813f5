"""Regression metrics as aggregates, one pass for all targets."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import quantiles

Pair = Callable[[Column, Column], Column]


def _share_explained(left: Column, whole: Column) -> Column:
    """``1 - left / whole``; a constant truth is explained fully (1) or not at all (0)."""
    constant = F.when(left == 0, 1.0).when(left.isNotNull(), 0.0)
    return F.when(whole == 0, constant).otherwise(1 - F.try_divide(left, whole))


def _r2(y: Column, p: Column) -> Column:
    return _share_explained(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))


def _explained(y: Column, p: Column) -> Column:
    return _share_explained(F.var_pop(y - p), F.var_pop(y))


# Fixed value: smallest denominator of the relative error, as for 64-bit floats.
EPSILON = 2.220446049250313e-16

METRICS: dict[str, Pair] = {
    "mean_absolute_error": lambda y, p: F.avg(F.abs(y - p)),
    "mean_squared_error": lambda y, p: F.avg((y - p) * (y - p)),
    "mean_absolute_percentage_error": lambda y, p: F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(EPSILON))),
    "mean_squared_log_error": lambda y, p: F.avg(F.pow(F.log1p(y) - F.log1p(p), 2.0)),
    "max_error": lambda y, p: F.max(F.abs(y - p)),
    "r2_score": _r2,
    "explained_variance_score": _explained,
}
# needs an order, so it goes through quantiles()
ORDER_METRICS = ("median_absolute_error",)


def check_metric(name: str) -> str:
    if name not in METRICS and name not in ORDER_METRICS:
        raise ValueError(f"unknown metric {name!r}; known: {sorted((*METRICS, *ORDER_METRICS))}")
    return name


def columnwise_scores(df: DataFrame, pairs: dict[str, tuple[str, str]], metric: str) -> DataFrame:
    """``target, score`` for each target's (truth, prediction) columns, and the mean as target ``mean``."""
    check_metric(metric)
    double = lambda c: F.col(c).cast("double")
    if metric == "median_absolute_error":
        errors = df.select(*[F.abs(double(y) - double(p)).alias(t) for t, (y, p) in pairs.items()])
        per_target = quantiles(errors, list(pairs), [0.5]).select(
            F.col("column").alias("target"), F.col("q_0").alias("score")
        )
    else:
        wide = df.agg(*[METRICS[metric](double(y), double(p)).alias(t) for t, (y, p) in pairs.items()])
        per_target = wide.unpivot([], list(pairs), "target", "score")
    return _with_mean(per_target, len(pairs))


def _with_mean(per_target: DataFrame, targets: int) -> DataFrame:
    """Add the mean of several targets' scores; the input has one row per target."""
    if targets == 1:
        return per_target
    return per_target.unionByName(per_target.agg(F.avg("score").alias("score")).withColumn("target", F.lit("mean")))


def long_scores(predictions: DataFrame, metric: str, targets: int) -> DataFrame:
    """Like :func:`columnwise_scores` for rows ``target, truth, prediction``: no shuffle of rows."""
    check_metric(metric)
    truth, guess = F.col("truth"), F.col("prediction")
    if metric == "median_absolute_error":
        errors = predictions.select("target", F.abs(truth - guess).alias("error"))
        per_target = quantiles(errors, ["error"], [0.5], by=["target"]).select("target", F.col("q_0").alias("score"))
    else:
        per_target = predictions.groupBy("target").agg(METRICS[metric](truth, guess).alias("score"))
    return _with_mean(per_target, targets)


def metric_table(df: DataFrame, truth: str, prediction: str, metrics: Sequence[str]) -> DataFrame:
    """``metric, score`` for one target."""
    for m in metrics:
        check_metric(m)
    y, p = F.col(truth).cast("double"), F.col(prediction).cast("double")
    plain = [m for m in metrics if m in METRICS]
    tables = []
    if plain:
        tables.append(df.agg(*[METRICS[m](y, p).alias(m) for m in plain]).unpivot([], plain, "metric", "score"))
    if "median_absolute_error" in metrics:
        errors = df.select(F.abs(y - p).alias("median_absolute_error"))
        median = quantiles(errors, ["median_absolute_error"], [0.5]).select(
            F.col("column").alias("metric"), F.col("q_0").alias("score")
        )
        tables.append(median)
    if not tables:
        raise ValueError("no metric is named")
    return reduce(DataFrame.unionByName, tables)


def ensemble_mean(predictions: DataFrame, keys: Sequence[str] = ("row_id", "target")) -> DataFrame:
    """Mean prediction over seeds or models of a long prediction table."""
    return predictions.groupBy(*keys).agg(F.avg("prediction").alias("prediction"))
