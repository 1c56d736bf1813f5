"""Exact quantiles without collecting a column or a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import present
from .lookup import TABLE_BYTES, attach, store
from .running import ROWS_PER_TASK, running_total
from .sketches import quantile_sketches, sketched_quantiles

EXACT, SKETCH = "exact", "sketch"


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
    table_bytes: int = TABLE_BYTES,
    method: str = EXACT,
) -> DataFrame:
    """Linearly interpolated quantiles ``q_0..`` of each column, per ``by`` group.

    Equal values are counted before any shuffle, the distinct ones get running
    totals over their order, and the two ranks around each quantile are picked
    by a plain aggregate. Nulls and NaN are left out. Result: ``by`` columns, ``column``, ``n``, ``q_i``.
    ``method='sketch'`` reads them from KLL sketches: seen values, not interpolated, within :func:`.sketches.rank_error`.
    """
    if method not in (EXACT, SKETCH):
        raise ValueError(f"method must be {EXACT!r} or {SKETCH!r}, got {method!r}")
    if method == SKETCH:
        return sketched_quantiles(quantile_sketches(df, cols, by), probs)
    ids = [f"__id_{b}" for b in by]
    long = (
        df.select(
            *[F.col(b).alias(i) for b, i in zip(by, ids)], *[present(df, c).cast("double").alias(c) for c in cols]
        )
        .unpivot(ids, list(cols), "column", "value")
        .filter(F.col("value").isNotNull())
    )
    group = [*ids, "column"]
    counts = long.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n"))
    counted, size = store(counts, "value-counts")
    ranked = running_total(counted, group, ["value"], "n", "upto", size.rows, rows_per_task)
    if size.rows <= rows_per_task:
        ranked = ranked.withColumn("total", F.sum("n").over(Window.partitionBy(*group)))
    else:
        sums = counted.groupBy(*group).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"))
        totals, total_size = store(sums, "totals", "distinct")
        ranked = attach(
            ranked,
            totals,
            [(F.col(g), g) for g in group],
            {"total": "total"},
            null_safe=True,
            small=total_size.bytes <= table_bytes,
            weight="distinct",
            total_weight=total_size.weight,
            few_null_rows=False,
        )

    def at(rank: Column) -> Column:
        inside = (rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n"))
        return F.max(F.when(inside, F.col("value")))

    picks = []
    for i, p in enumerate(probs):
        place = (F.col("total") - 1) * F.lit(float(p))
        picks += [at(F.floor(place)).alias(f"lo_{i}"), at(F.ceil(place)).alias(f"hi_{i}")]
    picked = ranked.groupBy(*group, "total").agg(*picks)

    def between(i: int, p: float) -> Column:
        place = (F.col("total") - 1) * F.lit(float(p))
        share = place - F.floor(place)
        return F.col(f"lo_{i}") * (1 - share) + F.col(f"hi_{i}") * share

    return picked.select(
        *[F.col(i).alias(b) for b, i in zip(by, ids)],
        "column",
        F.col("total").alias("n"),
        *[between(i, p).alias(f"q_{i}") for i, p in enumerate(probs)],
    )


def letter_value_probs(depth: int = 4) -> list[float]:
    """1/2, 1/4, 1/8 … and their mirrors, ascending."""
    low = [0.5**k for k in range(1, depth + 1)]
    return sorted({*low, *[1 - p for p in low]})


def letter_values(df: DataFrame, cols: Sequence[str], depth: int = 4, method: str = EXACT) -> DataFrame:
    """Letter values of each column: ``column``, ``prob``, ``value``."""
    probs = letter_value_probs(depth)
    wide = quantiles(df, cols, probs, method=method)
    pairs = F.explode(F.array(*[F.struct(F.lit(p).alias("prob"), F.col(f"q_{i}").alias("value")) for i, p in enumerate(probs)]))
    return wide.select("column", pairs.alias("pair")).select("column", "pair.prob", "pair.value")


def box_summary(df: DataFrame, value: str, by: Sequence[str], method: str = EXACT) -> DataFrame:
    """Minimum, quartiles and maximum of ``value`` per group."""
    return quantiles(df, [value], [0.0, 0.25, 0.5, 0.75, 1.0], by=by, method=method).select(
        *by,
        F.col("n"),
        F.col("q_0").alias("low"),
        F.col("q_1").alias("q25"),
        F.col("q_2").alias("q50"),
        F.col("q_3").alias("q75"),
        F.col("q_4").alias("high"),
    )
