"""Boosting that goes on: every round adds one tree to each model, and no round is fitted twice.

All models of a target grow side by side over one table of rows. A row carries its
prediction by each model so far, so the next round's residuals are an expression over it and
the held-out error of a round is one aggregate for all models. A model leaves when its
held-out rows have passed ``patience`` rounds without a new low; its predictions at the
best round are kept in the row, so nothing is scored again afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import materialise

#: Rounds after which the rows are stored again; between, each row passes the trees of these rounds anew.
STORED_EVERY = 4

#: loss -> (what the next tree is fitted on, error of a row), of truth and prediction
LOSSES: dict[str, tuple[Callable[[Column, Column], Column], Callable[[Column, Column], Column]]] = {
    "squared": (lambda y, p: 2.0 * (y - p), lambda y, p: (y - p) * (y - p)),
    "absolute": (lambda y, p: F.when(y - p < 0, -1.0).otherwise(1.0), lambda y, p: F.abs(y - p)),
}
#: Parameters of boosting itself; the others are a tree's.
OWN = ("maxIter", "stepSize", "lossType")


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Round (from 1) with the lowest error before ``patience`` rounds pass without a new low, and whether they did."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


@dataclass
class Boosted:
    """A boosted model: its trees by round (the first counts whole, the later ones by ``step``) and its held-out errors."""

    fold: int
    seed: int
    step: float
    trees: list[DecisionTreeRegressionModel] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    #: Of each tree, the variance of its predictions on its training rows: what its splits took from that of the residuals.
    spreads: list[float] = field(default_factory=list)
    rounds: int = 0

    def kept(self) -> list[tuple[float, DecisionTreeRegressionModel]]:
        """(weight, tree) up to the best round."""
        return [(self.step if i else 1.0, tree) for i, tree in enumerate(self.trees[: self.rounds])]

    def transform(self, rows: DataFrame, out: str = "prediction") -> DataFrame:
        """Add the prediction for rows with ``features``."""
        total, made = F.lit(0.0), rows
        for i, (weight, tree) in enumerate(self.kept()):
            made = tree.copy({tree.predictionCol: f"__tree_{i}"}).transform(made)
            total = total + weight * F.col(f"__tree_{i}")
        return made.select(*rows.columns, total.alias(out))

    def importances(self) -> np.ndarray:
        """Per feature, the shares of the trees' splits, each tree weighing as much as its splits explain, brought to the sum 1."""
        total = np.sum([spread * tree.featureImportances.toArray() for spread, (_, tree) in zip(self.spreads, self.kept())], axis=0)
        return total / total.sum() if total.sum() > 0 else total


def tree_learner(params: Mapping[str, object], seed: int, label: str) -> RandomForestRegressor:
    """One tree on all rows, with the tree's share of the parameters."""
    forest = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=5, seed=seed)
    for key, value in params.items():
        if key not in OWN:
            forest.set(forest.getParam(key), value)
    return forest


def boost(
    table: DataFrame,
    target: str,
    models: Sequence[tuple[int, int]],
    params: Mapping[str, object],
    patience: int,
    parallelism: int = 4,
    held_out: Callable[[int], Column] = lambda fold: F.col("fold") == fold,
    trained_on: Callable[[int], Column] = lambda fold: (F.col("fold") != fold) & (F.col("fold") >= 0),
) -> tuple[DataFrame, list[Boosted]]:
    """Boost a model for each (seed, fold) of ``models`` on ``table`` (row_id, fold, features, y_<target>).

    Gives the rows with ``best``, the predictions of all models in their order,
    each at its best round, and the models. A round fits one tree for each model
    that still runs, at most ``parallelism`` at a time, and takes one pass over the rows for all errors.
    """
    loss = params.get("lossType", "squared")
    if loss not in LOSSES:
        raise ValueError(f"unknown loss {loss!r}; known: {sorted(LOSSES)}")
    residual, error = LOSSES[loss]
    most, step = int(params.get("maxIter", 20)), float(params.get("stepSize", 0.1))
    grown = [Boosted(fold, seed, step) for seed, fold in models]
    sampled = params.get("subsamplingRate", 1.0) != 1.0 or params.get("featureSubsetStrategy", "all") != "all"
    truth = F.col(f"y_{target}")
    none = F.array(*[F.lit(0.0) for _ in models])
    rows = table.select("row_id", "fold", "features", truth, none.alias("now"), none.alias("best"))
    running, improved = list(range(len(models))), set()
    spark = table.sparkSession

    def fit(i: int) -> DecisionTreeRegressionModel:
        model, number = grown[i], len(grown[i].trees)
        label = residual(truth, F.col("now")[i]) if number else truth
        train = rows.filter(trained_on(model.fold)).select("features", label.alias("label"))
        # where a tree sees all rows and features, one seed gives every round the same candidate splits
        return tree_learner(params, model.seed + (number if sampled else 0), "label").fit(train).trees[0]

    def settled(value: str = "now") -> Column:
        """The predictions to keep: those of now where the last round was a model's best so far."""
        return F.array(*[F.col(value)[i] if i in improved else F.col("best")[i] for i in range(len(models))])

    with ThreadPoolExecutor(parallelism) as pool:
        for number in range(most):
            trees = dict(zip(running, pool.map(inheritable_thread_target(spark)(fit), running)))
            for i, tree in trees.items():
                grown[i].trees.append(tree)
                rows = tree.copy({tree.predictionCol: f"__tree_{i}"}).transform(rows)
            weight = step if number else 1.0
            now = F.array(*[F.col("now")[i] + weight * F.col(f"__tree_{i}") if i in trees else F.col("now")[i] for i in range(len(models))])
            grew = F.array(*[F.col(f"__tree_{i}") for i in running])
            rows = rows.select("row_id", "fold", "features", truth, now.alias("now"), settled().alias("best"), grew.alias("grew"))
            if (number + 1) % STORED_EVERY == 0:
                rows = materialise(rows, "boosted", ("fold",))
            told = rows.agg(
                *[F.avg(F.when(held_out(grown[i].fold), error(truth, F.col("now")[i]))).alias(f"e_{i}") for i in running],
                *[F.var_pop(F.when(trained_on(grown[i].fold), F.col("grew")[place])).alias(f"s_{i}") for place, i in enumerate(running)],
            ).first()
            rows = rows.drop("grew")
            improved = set()
            for i in list(running):
                model, own = grown[i], told[f"e_{i}"]
                model.errors.append(float("inf") if own is None else own)
                model.spreads.append(told[f"s_{i}"] or 0.0)
                model.rounds, stopped = best_round(model.errors, patience)
                if model.rounds == len(model.errors):
                    improved.add(i)
                if stopped:
                    running.remove(i)
            if not running:
                break
    return rows.withColumn("best", settled()).drop("now"), grown
