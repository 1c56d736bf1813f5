"""Quantiles of very many distinct values, from sketches that merge.

The exact way (:mod:`quantiles`) counts every distinct value and orders them.
A sketch keeps a few thousand values whatever it has seen: one pass, partial
sketches per task, and one shuffle of them. Its answers are off by a stated share of the
ranks, so the caller asks for it by name; no size switches to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import present

SKETCH_K = 800

# fixed values: the rank error of a KLL sketch of parameter k is ERROR_SCALE / k ** ERROR_POWER, at 99 % confidence
ERROR_SCALE = 2.296
ERROR_POWER = 0.9723


def rank_error(k: int = SKETCH_K) -> float:
    """Share of the rows by which the rank of an answer may be off, at 99 % confidence: 0.0035 for 800."""
    return ERROR_SCALE / k**ERROR_POWER


def quantile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """A KLL sketch of each column, per ``by`` group: ``by`` columns, ``column``, ``n``, ``sketch``.

    Nulls and NaN are left out; a group without any other value has no row. The
    table can be stored, and merged with that of other rows.
    """
    ids = [f"__id_{b}" for b in by]
    long = (
        df.select(*[F.col(b).alias(i) for b, i in zip(by, ids)], *[present(df, c).cast("double").alias(c) for c in cols])
        .unpivot(ids, list(cols), "column", "value")
        .filter(F.col("value").isNotNull())
    )
    made = long.groupBy(*ids, "column").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", k).alias("sketch"))
    return made.select(*[F.col(i).alias(b) for b, i in zip(by, ids)], "column", "n", "sketch")


def merge_sketches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The sketches of the rows of all, with the same error as one sketch of them."""
    keys = [F.col(f"`{c}`") for c in first.columns if c not in ("n", "sketch")]
    rows = reduce(DataFrame.unionByName, others, first)
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Values ``q_0..`` at the ranks ``probs``, one of the seen values each: other columns and ``n`` as they are.

    The probabilities 0 and 1 give the exact minimum and maximum.
    """
    kept = [F.col(f"`{c}`") for c in sketches.columns if c != "sketch"]
    return sketches.select(
        *kept, *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q_{i}") for i, p in enumerate(probs)]
    )
