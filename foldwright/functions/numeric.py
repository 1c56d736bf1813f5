"""Numeric features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def low_defects(first: Column, second: Column, most: int = 5) -> Column:
    """1 if ``first`` is zero and ``second`` at most ``most``; 0 otherwise and where unknown."""
    return F.coalesce((first == 0) & (second <= most), F.lit(False)).cast("int")


def log1p(value: Column) -> Column:
    return F.log1p(value.cast("double"))


def present(df: DataFrame, column: str) -> Column:
    """The column with NaN as null."""
    value = F.col(f"`{column}`")
    return F.when(~F.isnan(value), value) if df.schema[column].dataType.typeName() in ("double", "float") else value
