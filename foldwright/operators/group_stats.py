"""Grouped statistics of train rows, joined back to rows. NaN is missing, in keys and values."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import present
from .lookup import TABLE_BYTES, TableSize, attach, heavy_keys, store, visible
from .persist import load_table, save_table
from .quantiles import quantiles

METHODS: dict[str, Callable[[Column], Column]] = {
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "sum": F.sum,
    "count": F.count,
    "nunique": F.count_distinct,
}
# the median needs an order, not an aggregate buffer: see quantiles()
ORDER_METHODS = ("median",)


def stat_name(method: str, cat_cols: Sequence[str], target: str) -> str:
    return f"agg_{method}_{'_and_'.join(cat_cols)}_by_{target}"


def _exact_mean(df: DataFrame, column: str) -> Column:
    """Mean as one division, exact in the sum for decimal columns."""
    if df.schema[column].dataType.typeName() == "decimal":
        return F.sum(column).cast("double") / F.count(column)
    return F.avg(present(df, column))


@dataclass(frozen=True)
class FittedStats:
    cat_cols: tuple[str, ...]
    names: tuple[str, ...]
    table: DataFrame
    size: TableSize

    def transform(self, df: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
        """Add the statistics of each row's group; a null key or unseen group gives nulls."""
        small = self.size.bytes <= table_bytes
        keys = [F.col(c) for c in self.cat_cols]
        joined = attach(
            df,
            self.table,
            list(zip(keys, self.cat_cols)),
            {n: n for n in self.names},
            null_safe=False,
            small=small,
            weight="__n",
            total_weight=self.size.weight,
            heavy=() if small or df.isStreaming else heavy_keys(df, keys),
        )
        return joined.select(*visible(joined))

    def save(self, path: str) -> None:
        save_table(self.table, {"cat_cols": self.cat_cols, "names": self.names, "size": vars(self.size)}, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedStats:
        table, about = load_table(spark, path)
        return cls(tuple(about["cat_cols"]), tuple(about["names"]), table, TableSize(**about["size"]))


class GroupStats:
    """``methods`` of each target column per value of ``cat_cols``; rows with a null key form no group."""

    def __init__(self, cat_cols: Sequence[str], target_cols: Sequence[str], methods: Sequence[str]):
        unknown = [m for m in methods if m not in METHODS and m not in ORDER_METHODS]
        if unknown:
            raise ValueError(f"unknown methods {unknown}; known: {sorted((*METHODS, *ORDER_METHODS))}")
        self.cat_cols, self.target_cols, self.methods = tuple(cat_cols), tuple(target_cols), tuple(methods)

    def statistics(self, train: DataFrame) -> DataFrame:
        """The group table: keys, ``__n`` and one column per (method, target)."""
        rows = train.filter(reduce(and_, [present(train, c).isNotNull() for c in self.cat_cols]))
        plain = [m for m in self.methods if m in METHODS]
        made = []
        for target in self.target_cols:
            for method in plain:
                value = _exact_mean(train, target) if method == "mean" else METHODS[method](present(train, target))
                made.append(value.alias(stat_name(method, self.cat_cols, target)))
        stats = rows.groupBy(*self.cat_cols).agg(F.count(F.lit(1)).alias("__n"), *made)
        if "median" in self.methods:
            stats = self._with_medians(rows, stats)
        return stats.select(*self.cat_cols, "__n", *self._names())

    def _with_medians(self, rows: DataFrame, stats: DataFrame) -> DataFrame:
        middle = quantiles(rows, self.target_cols, [0.5], by=self.cat_cols)
        wide = middle.groupBy(*self.cat_cols).agg(
            *[
                F.max(F.when(F.col("column") == t, F.col("q_0"))).alias(stat_name("median", self.cat_cols, t))
                for t in self.target_cols
            ]
        )
        return stats.join(wide, list(self.cat_cols), "left")

    def _names(self) -> tuple[str, ...]:
        return tuple(stat_name(m, self.cat_cols, t) for t in self.target_cols for m in self.methods)

    def fit(self, train: DataFrame) -> FittedStats:
        table, size = store(self.statistics(train), "group-stats", "__n")
        return FittedStats(self.cat_cols, self._names(), table, size)
