"""Running totals over an order, without putting a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import materialise

ROWS_PER_TASK = 1_000_000
# ranges of one table: each is a task and takes 100 sampled rows, and the driver hears of both
MOST_RANGES = 1000


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    weight: str | None,
    out: str,
    rows: int,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``out``: inclusive running sum of ``weight`` (1 if None) per group, by ``order``.

    ``rows`` is the measured row count of ``df``. Up to ``rows_per_task`` one
    window per group does it. Above, rows are range-partitioned by (group, order),
    so a large group spans many tasks; the stored partition number keeps
    that assignment fixed, and each task adds the total of the earlier ones.
    There are at most ``MOST_RANGES`` ranges: beyond that many times ``rows_per_task``, ranges grow
    and are sorted with spill, while what reaches the driver stays bounded.
    ``(group, order)`` must be unique and ``order`` ascending with nulls first.
    """
    amount = F.col(weight) if weight else F.lit(1).cast("long")
    ordered = [F.col(c).asc_nulls_first() for c in order]
    if rows <= rows_per_task:
        window = (
            Window.partitionBy(*group).orderBy(*ordered).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return df.withColumn(out, F.sum(amount).over(window))

    parts = min(MOST_RANGES, ceil(rows / rows_per_task))
    ranged = df.repartitionByRange(parts, *group, *order).withColumn("__part", F.spark_partition_id())
    stored = materialise(ranged, "ranged")
    # a range partition continues at most one group that began before it, so at
    # most `parts` rows have earlier totals: safe to broadcast
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        stored.groupBy("__part", *group)
        .agg(F.sum(amount).alias("__sum"))
        .withColumn("__before", F.sum("__sum").over(before))
        .filter(F.col("__before").isNotNull())
        .select(
            F.col("__part").alias("__p"),
            *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
            "__before",
        )
    )
    match = F.col("__part") == F.col("__p")
    for i, g in enumerate(group):
        match = match & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    inside = (
        Window.partitionBy("__part", *group)
        .orderBy(*ordered)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        stored.withColumn("__local", F.sum(amount).over(inside))
        .join(F.broadcast(earlier), match, "left")
        .withColumn(out, F.col("__local") + F.coalesce(F.col("__before"), F.lit(0)))
        .select(*df.columns, out)
    )
