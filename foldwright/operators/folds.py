"""Cross-validation splitters and fold roles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import materialise
from .lookup import TABLE_BYTES, TableSize, attach, store, visible
from .persist import load_table, save_table
from .running import ROWS_PER_TASK, running_total

MISSING_GROUP = "<missing>"


def _order_hash(group: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(group.cast("string"), F.lit(MISSING_GROUP))).cast("binary"))


def fold_of_position(position: Column, total: int, n_splits: int) -> Column:
    """Fold of the 0-based ``position`` among ``total``: contiguous runs, the first get the extra one."""
    size, extra = divmod(total, n_splits)
    wide = extra * (size + 1)
    in_wide = F.floor(position / F.lit(size + 1))
    in_rest = F.lit(extra) + F.floor((position - F.lit(wide)) / F.lit(max(size, 1)))
    return F.when(position < F.lit(wide), in_wide).otherwise(in_rest).cast("int")


@dataclass(frozen=True)
class GroupFolds:
    """Fold of each group value; ``table`` has ``group``, ``n`` (rows) and ``fold``."""

    group_col: str
    n_splits: int
    table: DataFrame
    size: TableSize

    def transform(self, df: DataFrame, out: str = "fold", table_bytes: int = TABLE_BYTES) -> DataFrame:
        """Give every row the fold of its group. A missing group is a group."""
        placed = attach(
            df,
            self.table,
            [(F.col(self.group_col).cast("string"), "group")],
            {out: "fold"},
            null_safe=True,
            small=self.size.bytes <= table_bytes,
            weight="n",
            total_weight=self.size.weight,
        )
        return placed.select(*visible(placed))

    def save(self, path: str) -> None:
        about = {"group_col": self.group_col, "n_splits": self.n_splits, "size": vars(self.size)}
        save_table(self.table, about, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GroupFolds:
        table, about = load_table(spark, path)
        return cls(about["group_col"], about["n_splits"], table, TableSize(**about["size"]))


def group_kfold(
    df: DataFrame,
    group_col: str,
    n_splits: int = 5,
    shuffle: bool = True,
    seed: int = 1234,
    rows_per_task: int = ROWS_PER_TASK,
) -> GroupFolds:
    """Cut the distinct groups of ``df`` into ``n_splits`` near-equal runs.

    The order of groups is that of a seeded hash, or the group value itself
    without ``shuffle``. Rows of one group share a fold.
    """
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    group = F.col(group_col).cast("string")
    order = _order_hash(F.col("group"), seed) if shuffle else F.lit("")
    counted = df.groupBy(group.alias("group")).agg(F.count(F.lit(1)).alias("n")).withColumn("order", order)
    groups, size = store(counted, "groups", "n")
    if size.rows < n_splits:
        raise ValueError(f"{size.rows} groups cannot fill {n_splits} folds")
    placed = running_total(groups, [], ["order", "group"], None, "position", size.rows, rows_per_task)
    fold = fold_of_position(F.col("position") - 1, size.rows, n_splits)
    table = materialise(placed.select("group", "n", fold.alias("fold")), "group-folds")
    return GroupFolds(group_col, n_splits, table, size)


def row_kfold(df: DataFrame, row_id: str, n_splits: int = 5, shuffle: bool = True, seed: int = 42) -> GroupFolds:
    """K-fold over rows: each row is its own group."""
    return group_kfold(df, row_id, n_splits, shuffle, seed)


def hash_fold(group: Column | str, n_splits: int = 5, seed: int = 1234) -> Column:
    """Fold from the group's hash alone: no shuffle and no fit, sizes equal only on average."""
    column = F.col(group) if isinstance(group, str) else group
    head = F.conv(F.substring(_order_hash(column, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(n_splits)).cast("int")


def expand_folds(df: DataFrame, n_splits: int, fold_col: str = "fold") -> DataFrame:
    """Each row once per round: ``round`` and whether the row validates or trains in it."""
    role = F.when(F.col(fold_col) == F.col("round"), F.lit("valid")).otherwise(F.lit("train"))
    return df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1)))).withColumn("role", role)
