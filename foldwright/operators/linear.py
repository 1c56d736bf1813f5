"""Linear fits of all targets and folds from one pass over the rows.

A fold's rows are summed up as products of their columns with each other. The sums
of the other folds, added up, are all that a fit without that fold needs, so
neither the number of folds nor that of targets takes another pass. Values are
taken relative to one row's, so large means do not eat the digits of small spreads.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Features up to which the sums (a square of them for each fold) are small enough for the driver.
MOST_FEATURES = 1024
#: Directions whose share of the spread is below this are left out, as columns that follow from others.
TINY = 1e-11


@dataclass(frozen=True)
class FoldSums:
    """Per fold, the sums of the products of (1, features, targets), all relative to ``origin``."""

    origin: np.ndarray
    sums: dict[int, np.ndarray]
    n_targets: int

    def without(self, fold: int | None) -> np.ndarray:
        """The sums of all folds but one."""
        return np.sum([s for f, s in self.sums.items() if f != fold], axis=0)

    def solve(self, fold: int | None, intercept: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(coefficients per feature and target, intercepts) of the least squares fit without a fold."""
        total = self.without(fold)
        p = len(total) - 1 - self.n_targets
        if not total.shape or not total[0, 0]:
            raise ValueError(f"no train rows outside fold {fold}")
        if intercept:
            means = total[0, 1:] / total[0, 0]
            spread = total[1:, 1:] / total[0, 0] - np.outer(means, means)
        else:
            means, spread = np.zeros(len(total) - 1), total[1:, 1:] / total[0, 0]
        scale = np.sqrt(np.maximum(np.diag(spread)[:p], 0))
        scale[scale <= TINY * np.abs(total).max() ** 0.5] = 0
        by = np.divide(1.0, scale, out=np.zeros(p), where=scale > 0)
        values, vectors = np.linalg.eigh(spread[:p, :p] * by[:, None] * by)
        used = values > TINY * max(values.max(initial=0), 1e-300)
        inverse = (vectors[:, used] / values[used]) @ vectors[:, used].T
        coefficients = by[:, None] * (inverse @ (by[:, None] * spread[:p, p:]))
        if not intercept:
            return coefficients, np.zeros(self.n_targets)
        return coefficients, self.origin[p:] + means[p:] - (self.origin[:p] + means[:p]) @ coefficients


def _columns(table: DataFrame, targets: Sequence[str]) -> DataFrame:
    return table.select("row_id", "fold", vector_to_array("features").alias("x"), F.array(*[F.col(f"y_{t}") for t in targets]).alias("y"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def fold_sums(table: DataFrame, targets: Sequence[str], intercept: bool = True) -> FoldSums:
    """One pass over the train rows of ``table`` (from ``assemble``): a task sends one small square per fold."""
    rows = _columns(table.filter(F.col("fold") >= 0), targets).select("fold", "x", "y")
    lacking = rows.filter(F.exists("y", lambda v: v.isNull()))
    first = rows.first()
    if first is None:
        raise ValueError("no train rows")
    if not lacking.isEmpty():
        raise ValueError("train rows without a target")
    p, t = len(first["x"]), len(targets)
    origin = np.array([*first["x"], *first["y"]]) if intercept else np.zeros(p + t)

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            z = np.hstack([np.ones((len(fold), 1)), np.hstack([_matrix(batch.column(1), p), _matrix(batch.column(2), t)]) - origin])
            for f in np.unique(fold).tolist():
                own = z[fold == f]
                sums[f] = sums.get(f, 0) + own.T @ own
        for f, square in sums.items():
            lines = [pa.array([f] * len(square), pa.int32()), pa.array(range(len(square)), pa.int32()), pa.array(square.tolist(), pa.list_(pa.float64()))]
            yield pa.record_batch(lines, names=["fold", "i", "line"])

    lines = rows.mapInArrow(run, "fold int, i int, line array<double>").select("fold", "i", F.posexplode("line").alias("j", "v"))
    sums: dict[int, np.ndarray] = {}
    for r in lines.groupBy("fold", "i", "j").agg(F.sum("v").alias("v")).collect():
        sums.setdefault(r["fold"], np.zeros((p + t + 1, p + t + 1)))[r["i"], r["j"]] = r["v"]
    return FoldSums(origin, sums, t)


def predict(table: DataFrame, targets: Sequence[str], fits: dict[int, tuple[np.ndarray, np.ndarray]], rest: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(row_id, fold, target, truth, prediction), a row for each target; ``fits`` by fold, ``rest`` for rows of other folds."""
    p, t = rest[0].shape

    def run(batches):
        for batch in batches:
            fold, x = batch.column(1).to_numpy(zero_copy_only=False), _matrix(batch.column(2), p)
            out = np.empty((len(fold), t))
            for f in np.unique(fold).tolist():
                coefficients, intercepts = fits.get(f, rest)
                out[fold == f] = x[fold == f] @ coefficients + intercepts
            made = pa.array(out.tolist(), pa.list_(pa.float64()))
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(3), made], names=["row_id", "fold", "y", "p"])

    key = table.schema["row_id"].dataType.simpleString()
    made = _columns(table, targets).mapInArrow(run, f"row_id {key}, fold int, y array<double>, p array<double>")
    names = F.array(*[F.lit(n) for n in targets])
    each = F.explode(F.arrays_zip(names.alias("target"), F.col("y").alias("truth"), F.col("p").alias("prediction")))
    return made.select("row_id", "fold", each.alias("e")).select("row_id", "fold", "e.target", "e.truth", "e.prediction")
