"""Boosting of all targets, seeds and folds together."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from foldwright.operators import together
from foldwright.operators.boosting import best_round
from foldwright.operators.together import Tree, boost_together, only_numbers, thresholds
from foldwright.operators.training import assemble, cross_validate, grow_together

from .conftest import rows

COLUMNS = ["a", "b", "c"]
PARAMS = {"maxIter": 6, "maxDepth": 3, "stepSize": 0.7}
MODELS = [(seed, fold) for seed in (0, 5) for fold in range(4)]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(500).selectExpr(
        "id AS row_id", "CASE WHEN id % 5 = 4 THEN 'test' ELSE 'train' END AS split", "CASE WHEN id % 5 <> 4 THEN CAST(hash(id) & 3 AS INT) END AS fold",
        "CAST(hash(id, 1) % 100 AS DOUBLE) AS a", "CAST(hash(id, 2) % 10 AS DOUBLE) + 1e6 AS b", "CAST(hash(id, 3) % 7 AS DOUBLE) AS c",
    ).withColumns({
        "y": F.when(F.col("split") == "train", F.col("a") * F.col("c") + 3 * F.abs("a") + F.col("b")),
        "z": F.when(F.col("split") == "train", 2 * F.col("a") - F.col("b") + F.col("c") / 3 + F.hash("row_id") % 5),
    })
    return assemble(df, COLUMNS, ["y", "z"])


@pytest.mark.parametrize("loss", ["squared", "absolute"])
def test_models_are_those_of_spark(table, loss):
    params = {**PARAMS, "lossType": loss}
    result = cross_validate(table, COLUMNS, ["y", "z"], (0, 5), 4, params=params, stop="patience", patience=100)
    rounds = {(r.target, r.seed, r.fold): r.rounds for r in result.rounds.collect()}
    shares = {(r.target, r.seed, r.fold, r.feature): r.importance for r in result.importance.collect()}
    oof = {(r.target, r.seed, r.row_id): (r.truth, r.prediction, r.seed_mean) for r in result.oof.collect()}
    assert len(oof) == result.oof.count() == 400 * 2 * 2 and result.test.count() == 100 * 2
    for (target, _, row_id), (_, _, mean) in oof.items():
        assert mean == pytest.approx(np.mean([oof[target, seed, row_id][1] for seed in (0, 5)]))
    for target, seed, fold in (("y", 0, 0), ("z", 5, 3)):
        train = table.filter(f"fold NOT IN ({fold}, -1)")
        whole = GBTRegressor(labelCol=f"y_{target}", seed=seed, **params).fit(train)
        errors = whole.evaluateEachIteration(table.filter(f"fold = {fold}").withColumn("label", F.col(f"y_{target}")), loss)
        best, _ = best_round(errors, 100)
        assert rounds[target, seed, fold] == best
        cut = GBTRegressor(labelCol=f"y_{target}", seed=seed, **{**params, "maxIter": best}).fit(train)
        made = cut.transform(table).collect()
        assert {r.row_id: oof[target, seed, r.row_id][:2] for r in made if r.fold == fold} == {
            r.row_id: pytest.approx((r[f"y_{target}"], r.prediction)) for r in made if r.fold == fold
        }
        assert [shares[target, seed, fold, c] for c in COLUMNS] == pytest.approx(cut.featureImportances.toArray())
        # alone, a model gives the mean of the test rows
        (_, scored, (model,)), = boost_together(table, [target], [(seed, fold)], params, 100)
        assert model.errors == pytest.approx(errors)
        tests = {r.row_id: r["mean"] for r in scored.filter("fold = -1").collect()}
        assert tests == {r.row_id: [pytest.approx(r.prediction)] for r in made if r.fold == -1}


def test_passes_do_not_grow_with_targets_seeds_and_folds(spark, table):
    def jobs(targets, seeds, folds):
        name = f"together-{len(targets)}-{len(seeds)}-{folds}"
        spark.sparkContext.setJobGroup(name, "")
        params = {"maxIter": 1, "maxDepth": 1, "lossType": "squared"}
        cross_validate(table, COLUMNS, targets, seeds, folds, params=params, stop="patience", patience=1)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    assert jobs(["y"], (0,), 2) == jobs(["y", "z"], (0, 1), 4) < 25


def test_bounds_on_passes_change_nothing(table, monkeypatch):
    def made():
        params = {"maxIter": 3, "maxDepth": 3, "stepSize": 0.7, "lossType": "squared"}
        result = cross_validate(table, COLUMNS, ["y", "z"], (0,), 2, params=params, stop="patience", patience=2)
        return rows(result.oof), rows(result.test), rows(result.rounds)

    whole = made()
    monkeypatch.setattr(together, "HISTOGRAM_BYTES", 3_000)
    monkeypatch.setattr(together, "MOST_MODELS", 2)
    monkeypatch.setattr(together, "STORED_EVERY", 1)
    parts = made()
    assert parts[2] == whole[2]
    for some, all_ in zip(parts[:2], whole[:2]):
        for r, s in zip(some, all_, strict=True):
            assert [v if isinstance(v, str) else pytest.approx(v) for v in r] == list(s)


def test_a_sample_by_seed_gives_the_thresholds(table, monkeypatch):
    monkeypatch.setattr(together, "SAMPLED", 40)
    params = {"maxIter": 1, "maxDepth": 2, "maxBins": 6, "lossType": "squared"}
    (group, _, grown), = boost_together(table, ["y"], MODELS, params, 1)
    assert group == ["y"] and [(m.seed, m.fold) for m in grown] == MODELS
    assert len({tuple(m.trees[0].cut) for m in grown}) > 1
    for m in grown:
        tree = m.trees[0]
        leaves = [i for i, f in enumerate(tree.feature) if f < 0]
        assert sum(tree.count[i] for i in leaves) == tree.count[0] == table.filter(f"fold NOT IN ({m.fold}, -1)").count()


def test_thresholds():
    assert thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 3).tolist() == [1.5, 2.5]
    assert thresholds(np.array([7.0, 7.0]), 3).tolist() == []
    assert thresholds(np.arange(8.0), 4).tolist() == [1.5, 3.5, 5.5]
    assert thresholds(np.array([0.0] * 9 + [1.0, 2.0, 3.0]), 3).tolist() == [0.5, 1.5]


def test_rows_pass_a_tree():
    tree = Tree(feature=[1, -1, 0, -1, -1], cut=[2, -1, 0, -1, -1], left=[1, -1, 3, -1, -1], gain=[3.0, 0, 1.0, 0, 0], count=[4, 1, 3, 1, 2], value=[0, 5, 0, 6, 7])
    assert tree.predict(np.array([[0, 2], [0, 3], [1, 3], [9, 9]], np.uint8)).tolist() == [5, 6, 7, 7]
    assert tree.importances(2).tolist() == [0.2, 0.8]
    assert tree.spread() == pytest.approx(np.var([5, 6, 7, 7]))


def test_what_cannot_be_fitted_is_told(spark, table):
    options = {"params": {"maxIter": 1}, "stop": "patience"}
    df = spark.createDataFrame([(0, "train", 0, 1.0, None), (1, "train", 1, 2.0, 2.0)], "row_id long, split string, fold int, a double, y double")
    with pytest.raises(ValueError, match="without a target"):
        cross_validate(assemble(df, ["a"], ["y"]), ["a"], ["y"], (0,), 2, **options)
    with pytest.raises(ValueError, match="no train rows outside fold 0"):
        cross_validate(assemble(df.filter("fold = 0").fillna(1.0), ["a"], ["y"]), ["a"], ["y"], (0,), 2, **options)
    with pytest.raises(ValueError, match="unknown loss"):
        cross_validate(table, COLUMNS, ["y"], (0,), 4, params={"lossType": "huber"}, stop="patience")


def test_what_grows_together(spark, table):
    assert only_numbers(table) and grow_together(3, "gbt", PARAMS, "patience") and grow_together(3, "gbt", PARAMS, None)
    assert not grow_together(3, "gbt", {"subsamplingRate": 0.5}, "patience") and not grow_together(3, "linear", {}, None)
    assert not grow_together(3, "gbt", PARAMS, "tolerance") and not grow_together(100_000, "gbt", PARAMS, None)


@pytest.mark.parametrize("stop", [None, "patience"])
def test_arrays_give_what_vectors_give(spark, stop):
    df = spark.range(200).selectExpr(
        "id AS row_id", "CASE WHEN id % 5 = 4 THEN 'test' ELSE 'train' END AS split", "CASE WHEN id % 5 <> 4 THEN CAST(id % 3 AS INT) END AS fold",
        "CASE WHEN id % 7 > 0 THEN CAST(hash(id) % 50 AS DOUBLE) END AS a", "CAST(id % 4 AS INT) AS b", "CAST(hash(id) % 50 + id % 4 AS DOUBLE) AS y",
    )
    made = []
    for stored in (True, False):
        vectors = assemble(df, ["a", "b"], ["y"], stored=stored)
        made.append(cross_validate(vectors, ["a", "b"], ["y"], (0,), 3, params={"maxIter": 2, "maxDepth": 2}, stop=stop, patience=5))
    for part in ("oof", "test", "importance", "rounds"):
        assert rows(getattr(made[0], part)) == rows(getattr(made[1], part))
