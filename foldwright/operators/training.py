"""Cross-validated regression: one fit per target, seed and fold, scored on the held-out fold.

The learners are those of ``pyspark.ml``, or grow the same trees (``together``); this module builds the
cross-validation around them. For the former the assembled rows are stored once, partitioned
by fold, so each fit reads only its folds. Predictions are written as
they are made, and seeds are averaged inside one pass over the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import regression
from pyspark.ml.base import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import fresh_path, materialise, shared_dir
from .boosting import boost
from .linear import MOST_FEATURES, fold_sums, predict
from .reshape import TRAIN, fill_below_min, is_vector
from .together import PARAMS, boost_together, only_numbers

TEST_FOLD = -1

LEARNERS: dict[str, Callable[..., Estimator]] = {
    "gbt": regression.GBTRegressor,
    "random_forest": regression.RandomForestRegressor,
    "linear": regression.LinearRegression,
}
STOPS = (None, "tolerance", "patience")


@dataclass(frozen=True)
class FitKey:
    target: str
    seed: int
    fold: int


@dataclass(frozen=True)
class CVResult:
    """Long tables.

    ``oof``: row_id, target, seed, fold, truth, prediction, seed_mean (one per train row, target and seed;
    ``seed_mean`` is the row's prediction averaged over the seeds).
    ``test``: row_id, target, prediction, averaged over all models of the target.
    ``importance``: target, seed, fold, model_no, feature, importance.
    ``rounds``: target, seed, fold, rounds (trees kept).
    """

    oof: DataFrame
    test: DataFrame
    importance: DataFrame
    rounds: DataFrame


def assemble(
    rows: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    row_id: str = "row_id",
    least: Mapping[str, float | None] | None = None,
    stored: bool = True,
) -> DataFrame:
    """Store ``row_id, split, fold, targets, features`` with a vector column, partitioned by fold (-1 in test).

    ``least``: the train minima of the number features, if an earlier job has found them. Without ``stored``, number
    features become an array that is made as it is read, for models that grow together: these store its bins.
    """
    train = rows.filter(F.col("split") == TRAIN)
    filled = fill_below_min(rows, features, train, least)
    in_array = not stored and not any(is_vector(rows, f) for f in features)
    if in_array:
        slots = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": f} for i, f in enumerate(features)]}, "num_attrs": len(features)}}
        joined = filled.withColumn("features", F.array(*[F.col(f"`{f}`") for f in features]).alias("features", metadata=slots))
    else:
        joined = VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)
    kept = joined.select(
        F.col(row_id).alias("row_id"),
        *[F.col(t).cast("double").alias(f"y_{t}") for t in targets],
        "features",
        F.coalesce(F.col("fold"), F.lit(TEST_FOLD)).cast("int").alias("fold"),
    )
    return kept if in_array else materialise(kept, "assembled", ("fold",))


def grow_together(width: int, learner: str, params: Mapping[str, object], stop: str | None) -> bool:
    """Whether the models of all targets, seeds and folds can grow side by side on so many features."""
    return learner == "gbt" and stop in (None, "patience") and set(params) <= set(PARAMS) and 0 < width <= MOST_FEATURES


def slot_names(table: DataFrame, features: Sequence[str]) -> list[str]:
    """A name for each place of the vector: a feature that is a vector itself has several."""
    stated = table.schema["features"].metadata.get("ml_attr", {})
    named = {a["idx"]: a.get("name", f"features_{a['idx']}") for group in stated.get("attrs", {}).values() for a in group}
    width = stated.get("num_attrs", len(features))
    if width == len(features) and len(named) != width:
        return list(features)
    return [named.get(i, f"features_{i}") for i in range(width)]


def make_learner(name: str, params: Mapping[str, object], target: str, seed: int) -> Estimator:
    if name not in LEARNERS:
        raise ValueError(f"unknown learner {name!r}; known: {sorted(LEARNERS)}")
    estimator = LEARNERS[name](featuresCol="features", labelCol=f"y_{target}", predictionCol="prediction")
    for key, value in params.items():
        estimator.set(estimator.getParam(key), value)
    if estimator.hasParam("seed"):
        estimator.set(estimator.getParam("seed"), seed)
    return estimator


def fit_one(table: DataFrame, key: FitKey, learner: str, params: Mapping[str, object], stop: str | None) -> Model:
    """Fit on the other folds; with ``stop`` the held-out fold decides the number of trees."""
    estimator = make_learner(learner, params, key.target, key.seed)
    if stop == "tolerance" and learner == "gbt":
        marked = table.filter(F.col("fold") != TEST_FOLD).withColumn("valid", F.col("fold") == key.fold)
        estimator.set(estimator.getParam("validationIndicatorCol"), "valid")
        return estimator.fit(marked)
    return estimator.fit(table.filter((F.col("fold") != key.fold) & (F.col("fold") != TEST_FOLD)))


def _scored(rows: DataFrame, models: Sequence[Model]) -> tuple[DataFrame, list[str]]:
    names = [f"p_{i}" for i in range(len(models))]
    for name, model in zip(names, models):
        rows = model.copy({model.predictionCol: name}).transform(rows)
    return rows, names


def _write_oof(rows: DataFrame, path: str, target: str, fold: int, models: Mapping[int, Model]) -> None:
    scored, names = _scored(rows.filter(F.col("fold") == fold), list(models.values()))
    entries = F.array(
        *[F.struct(F.lit(seed).alias("seed"), F.col(n).alias("prediction")) for seed, n in zip(models, names)]
    )
    long = scored.select(
        "row_id", F.col(f"y_{target}").alias("truth"), _mean(names).alias("seed_mean"), F.explode(entries).alias("e")
    )
    kept = long.select("row_id", "e.seed", "truth", "e.prediction", "seed_mean")
    kept.write.parquet(f"{path}/target={_escaped(target)}/fold={fold}")


def _escaped(name: str) -> str:
    """A value in a partition path: Spark reads %XX back as the character."""
    return "".join(c if c.isalnum() or c in "_-." else "".join(f"%{b:02X}" for b in c.encode()) if ord(c) < 128 else c for c in name)


def _mean(names: Sequence[str]) -> Column:
    return reduce(add, [F.col(n) for n in names]) / F.lit(float(len(names)))


def _write_test(rows: DataFrame, path: str, target: str, models: Sequence[Model]) -> None:
    scored, names = _scored(rows.filter(F.col("fold") == TEST_FOLD), models)
    scored.select("row_id", _mean(names).alias("prediction")).write.parquet(f"{path}/target={_escaped(target)}")


def cross_validate(
    table: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    seeds: Sequence[int] = (0, 1),
    n_folds: int = 5,
    learner: str = "gbt",
    params: Mapping[str, object] | None = None,
    stop: str | None = None,
    patience: int = 100,
    parallelism: int = 4,
) -> CVResult:
    """Cross-validate ``table`` (from :func:`assemble`) for every target.

    Plainly boosted models of all targets, seeds and folds grow side by side
    (``together``), and plain linear fits come from one pass over the rows (``linear``).
    Other fits run as concurrent Spark jobs, at most ``parallelism`` at a time. One
    target is done at a time, so the driver holds that target's models only. Each
    fit of trees that runs caches its training rows (label, weight and vector) on
    the executors: they need room for ``parallelism`` copies. With
    ``stop='patience'`` such boosted models grow round by round (``boosting``).
    """
    if learner not in LEARNERS:
        raise ValueError(f"unknown learner {learner!r}; known: {sorted(LEARNERS)}")
    if stop not in STOPS:
        raise ValueError(f"stop must be one of {STOPS}")
    spark = table.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    params, slots = dict(params or {}), slot_names(table, features)
    if learner == "linear" and set(params) <= {"fitIntercept"} and len(slots) <= MOST_FEATURES:
        return _cross_validate_linear(table, slots, targets, seeds, n_folds, params.get("fitIntercept", True))
    if grow_together(len(slots), learner, params, stop) and only_numbers(table):
        return _cross_validate_together(table, slots, targets, seeds, n_folds, params, patience if stop else None)
    oof_path, test_path = fresh_path(spark, "oof"), fresh_path(spark, "test-predictions")
    importance: list[tuple] = []
    rounds: list[tuple] = []
    for target in targets:
        keys = [FitKey(target, seed, fold) for seed in seeds for fold in range(n_folds)]
        if learner == "gbt" and stop == "patience":
            scored, grown = boost(table, target, [(k.seed, k.fold) for k in keys], params, patience, parallelism)
            _write_boosted(scored, oof_path, test_path, target, seeds, n_folds)
            told = [(model.importances(), model.rounds) for model in grown]
        else:

            def fit(key: FitKey) -> Model:
                return fit_one(table, key, learner, params, stop)

            with ThreadPoolExecutor(parallelism) as pool:
                models = dict(zip(keys, pool.map(inheritable_thread_target(spark)(fit), keys)))
                score = inheritable_thread_target(spark)(
                    lambda fold: _write_oof(table, oof_path, target, fold, {s: models[FitKey(target, s, fold)] for s in seeds})
                )
                list(pool.map(score, range(n_folds)))
                _write_test(table, test_path, target, list(models.values()))
            told = [(_importances(model, len(slots)), getattr(model, "getNumTrees", 1)) for model in models.values()]
        for number, (key, (shares, kept)) in enumerate(zip(keys, told)):
            place = (key.target, key.seed, key.fold)
            importance += [(*place, number, f, float(v)) for f, v in zip(slots, shares)]
            rounds.append((*place, kept))
    oof = spark.read.schema(
        "row_id long, seed int, truth double, prediction double, seed_mean double, target string, fold int"
    ).parquet(oof_path)
    test = spark.read.schema("row_id long, prediction double, target string").parquet(test_path)
    return _result(spark, oof, test, importance, rounds)


def _result(spark: SparkSession, oof: DataFrame, test: DataFrame, importance: list[tuple], rounds: list[tuple]) -> CVResult:
    """The tables of importances and rounds have (models x features) rows, made by the driver from the models it holds."""
    shares = "target string, seed int, fold int, model_no int, feature string, importance double"
    return CVResult(oof, test, spark.createDataFrame(importance, shares), spark.createDataFrame(rounds, "target string, seed int, fold int, rounds int"))


def _write_boosted(scored: DataFrame, oof_path: str, test_path: str, target: str, seeds: Sequence[int], n_folds: int) -> None:
    """Out-of-fold and test predictions from rows that carry those of all models, seed by seed and fold by fold."""
    scored = materialise(scored.drop("features"), "scored", ("fold",))
    own = [F.get("best", F.lit(i * n_folds) + F.col("fold")) for i in range(len(seeds))]
    entries = F.array(*[F.struct(F.lit(seed).alias("seed"), p.alias("prediction")) for seed, p in zip(seeds, own)])
    mean = reduce(add, own) / F.lit(float(len(own)))
    long = scored.filter(F.col("fold") != TEST_FOLD).select(
        "row_id", "fold", F.col(f"y_{target}").alias("truth"), mean.alias("seed_mean"), F.explode(entries).alias("e")
    )
    kept = long.select("row_id", "e.seed", "truth", "e.prediction", "seed_mean", "fold")
    kept.write.partitionBy("fold").parquet(f"{oof_path}/target={_escaped(target)}")
    all_models = [F.col("best")[i] for i in range(len(seeds) * n_folds)]
    test = scored.filter(F.col("fold") == TEST_FOLD).select("row_id", (reduce(add, all_models) / F.lit(float(len(all_models)))).alias("prediction"))
    test.write.parquet(f"{test_path}/target={_escaped(target)}")


def _cross_validate_together(
    table: DataFrame, slots: Sequence[str], targets: Sequence[str], seeds: Sequence[int], n_folds: int, params: Mapping[str, object], patience: int | None
) -> CVResult:
    """The boosted models of all targets side by side; the rows of the long tables are made from the stored scores as they are read."""
    keys = [(seed, fold) for seed in seeds for fold in range(n_folds)]
    oof, test, importance, rounds = [], [], [], []
    for group, scored, grown in boost_together(table, targets, keys, params, patience):
        oof.append(_long_oof(scored, group, seeds))
        test.append(_long_test(scored, group))
        for model in grown:
            place = (group[model.target], model.seed, model.fold)
            importance += [(*place, model.number, f, float(v)) for f, v in zip(slots, model.importances())]
            rounds.append((*place, model.rounds))
    return _result(table.sparkSession, reduce(DataFrame.unionByName, oof), reduce(DataFrame.unionByName, test), importance, rounds)


def _long_oof(scored: DataFrame, targets: Sequence[str], seeds: Sequence[int]) -> DataFrame:
    """A row for each target and seed of a train row."""
    target, seed = F.floor(F.col("at") / len(seeds)).cast("int"), (F.col("at") % len(seeds)).cast("int")
    each = scored.filter(F.col("fold") != TEST_FOLD).select("row_id", "fold", "truth", "mean", F.posexplode("own").alias("at", "prediction"))
    return each.select(
        "row_id",
        F.get(F.array(*[F.lit(s) for s in seeds]), seed).alias("seed"),
        F.get("truth", target).alias("truth"),
        "prediction",
        F.get("mean", target).alias("seed_mean"),
        F.get(F.array(*[F.lit(t) for t in targets]), target).alias("target"),
        "fold",
    )


def _long_test(scored: DataFrame, targets: Sequence[str]) -> DataFrame:
    """A row for each target of a test row."""
    each = scored.filter(F.col("fold") == TEST_FOLD).select("row_id", F.posexplode("mean").alias("at", "prediction"))
    return each.select("row_id", "prediction", F.get(F.array(*[F.lit(t) for t in targets]), F.col("at")).alias("target"))


def _cross_validate_linear(
    table: DataFrame, slots: Sequence[str], targets: Sequence[str], seeds: Sequence[int], n_folds: int, intercept: bool
) -> CVResult:
    """Least squares has one solution, whatever the seed: the sums of one pass give it for all folds and targets."""
    spark, sums = table.sparkSession, fold_sums(table, targets, intercept)
    fits = {fold: sums.solve(fold, intercept) for fold in range(n_folds)}
    # the mean of the models' predictions is the prediction of their mean
    mean = tuple(np.mean(parts, axis=0) for parts in zip(*fits.values()))
    made = materialise(predict(table, targets, fits, mean), "linear", ("fold",))
    each = F.explode(F.array(*[F.lit(s) for s in seeds])).alias("seed")
    oof = made.filter(F.col("fold") != TEST_FOLD).select(
        "row_id", each, "truth", "prediction", F.col("prediction").alias("seed_mean"), "target", "fold"
    )
    test = made.filter(F.col("fold") == TEST_FOLD).select("row_id", "prediction", "target")
    importance, rounds = [], []
    for i, target in enumerate(targets):
        for number, (seed, fold) in enumerate((s, f) for s in seeds for f in range(n_folds)):
            importance += [(target, seed, fold, number, name, float(abs(c))) for name, c in zip(slots, fits[fold][0][:, i])]
            rounds.append((target, seed, fold, 1))
    return _result(spark, oof, test, importance, rounds)


def _importances(model: Model, width: int) -> list[float]:
    vector = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    values = [abs(v) for v in vector.toArray()]
    return values + [0.0] * (width - len(values))
