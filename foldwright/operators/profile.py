"""Table profiling: schema, missing rates, top groups, first rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _is_float(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("double", "float")


def _present(df: DataFrame, column: str) -> Column:
    ok = F.col(f"`{column}`").isNotNull()
    return ok & ~F.isnan(F.col(f"`{column}`")) if _is_float(df, column) else ok


def profile(df: DataFrame) -> DataFrame:
    """``column, type, non_null, rows`` of every column, by one aggregate."""
    cells = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(_present(df, c)).alias(f"p_{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col(f"p_{i}").alias("non_null"),
            )
            for i, field in enumerate(df.schema)
        ]
    )
    return cells.select("rows", F.explode(entries).alias("e")).select("e.*", "rows")


def missing_rate(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Percentage of missing values per column, highest first; null in a table without rows."""
    chosen = list(cols or df.columns)
    shares = df.agg(
        *[
            (F.try_divide(F.count_if(~_present(df, c)).cast("double"), F.count(F.lit(1)).cast("double")) * 100.0).alias(c)
            for c in chosen
        ]
    )
    return shares.unpivot([], chosen, "column", "missing_rate").orderBy(F.desc("missing_rate"), "column")


def group_mean_topk(df: DataFrame, keys: Sequence[str], value: str, k: int = 20) -> DataFrame:
    """The ``k`` groups with the highest mean; rows with a missing key form no group."""
    exact = df.schema[value].dataType.typeName() == "decimal"
    mean = F.sum(value).cast("double") / F.count(value) if exact else F.avg(value)
    return (
        df.filter(reduce(and_, [F.col(c).isNotNull() for c in keys]))
        .groupBy(*keys)
        .agg(mean.alias(value))
        .orderBy(F.desc_nulls_last(value), *keys)
        .limit(k)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def head(df: DataFrame, n: int = 5, row_id: str = "row_id") -> DataFrame:
    return df.orderBy(row_id).limit(n)


def filter_equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def flipped(df: DataFrame, row_id: str, cols: Sequence[str]) -> DataFrame:
    """The transposed view in long form: ``column, row_id, value`` as text, for any number of rows."""
    return df.select(row_id, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [row_id], list(cols), "column", "value"
    )
