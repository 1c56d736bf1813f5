"""Boosting round by round, and linear fits from sums."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from foldwright.operators import boosting
from foldwright.operators.boosting import best_round, boost
from foldwright.operators.linear import fold_sums
from foldwright.operators.training import assemble, cross_validate

from .conftest import rows

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(500).selectExpr(
        "id AS row_id", "CASE WHEN id % 5 = 4 THEN 'test' ELSE 'train' END AS split", "CASE WHEN id % 5 <> 4 THEN CAST(hash(id) & 3 AS INT) END AS fold",
        "CAST(hash(id, 1) % 100 AS DOUBLE) AS a", "CAST(hash(id, 2) % 10 AS DOUBLE) + 1e6 AS b", "CAST(hash(id, 3) % 7 AS DOUBLE) AS c",
    ).withColumns({
        "y": F.col("a") * F.col("c") + 3 * F.abs("a") + F.col("b"), "z": 2 * F.col("a") - F.col("b") + F.col("c") / 3 + F.hash("row_id") % 5,
    })
    return assemble(df, COLUMNS, ["y", "z"])


@pytest.mark.parametrize("loss", ["squared", "absolute"])
def test_round_by_round_is_one_long_fit(table, loss):
    params = {"maxIter": 10, "maxDepth": 3, "stepSize": 0.7, "lossType": loss}
    scored, grown = boost(table, "y", [(0, 0), (0, 1), (5, 1)], params, patience=100)
    kept = scored.select("row_id", "best").collect()
    for i, (seed, fold) in enumerate([(0, 0), (0, 1), (5, 1)]):
        whole = GBTRegressor(labelCol="y_y", seed=seed, **params).fit(table.filter(f"fold NOT IN ({fold}, -1)"))
        errors = whole.evaluateEachIteration(table.filter(f"fold = {fold}").withColumn("label", F.col("y_y")), loss)
        assert grown[i].errors == pytest.approx(errors)
        best, _ = best_round(errors, 100)
        assert grown[i].rounds == best
        cut = GBTRegressor(labelCol="y_y", seed=seed, **{**params, "maxIter": best}).fit(table.filter(f"fold NOT IN ({fold}, -1)"))
        want = {r.row_id: r.prediction for r in cut.transform(table).select("row_id", "prediction").collect()}
        assert {r.row_id: r.best[i] for r in kept} == pytest.approx(want)
        again = {r.row_id: r.prediction for r in grown[i].transform(table).select("row_id", "prediction").collect()}
        assert again == pytest.approx(want)
        assert grown[i].importances() == pytest.approx(cut.featureImportances.toArray())


def test_no_round_is_fitted_twice_and_all_stop(table, monkeypatch):
    fits = []

    class Counted(boosting.RandomForestRegressor):
        def fit(self, *args, **kwargs):
            fits.append(1)
            return super().fit(*args, **kwargs)

    monkeypatch.setattr(boosting, "RandomForestRegressor", Counted)
    params = {"maxIter": 50, "maxDepth": 2, "stepSize": 1.0, "lossType": "squared"}
    _, grown = boost(table, "y", [(0, f) for f in range(4)], params, patience=2)
    assert len(fits) == sum(len(m.trees) for m in grown)
    for m in grown:
        assert len(m.trees) == len(m.errors) < 50
        assert (m.rounds, True) == best_round(m.errors, 2) and len(m.errors) == m.rounds + 2


def test_unknown_loss(table):
    with pytest.raises(ValueError, match="unknown loss"):
        boost(table, "y", [(0, 0)], {"lossType": "huber"}, 1)


@pytest.mark.parametrize("intercept", [True, False])
def test_sums_give_the_fits_of_all_folds_and_targets(table, intercept):
    sums = fold_sums(table, ["y", "z"], intercept)
    data = np.array([(r.fold, *r.features, r.y_y, r.y_z) for r in table.filter("fold >= 0").collect()])
    for fold in range(4):
        x, y = data[data[:, 0] != fold, 1:4], data[data[:, 0] != fold, 4:]
        middle = x.mean(0) if intercept else np.zeros(3)
        want = np.linalg.lstsq(np.hstack([x - middle, np.ones((len(x), int(intercept)))]), y, rcond=None)[0]
        coefficients, intercepts = sums.solve(fold, intercept)
        assert coefficients == pytest.approx(want[:3], rel=1e-7)
        if intercept:
            assert intercepts == pytest.approx(want[3] - middle @ want[:3], rel=1e-7)


def test_as_the_learner_of_spark(table):
    coefficients, intercepts = fold_sums(table.withColumn("fold", F.when(F.col("fold") >= 0, 0).otherwise(-1)), ["y"]).solve(None)
    want = LinearRegression(labelCol="y_y").fit(table.filter("fold >= 0"))
    assert coefficients[:, 0] == pytest.approx(want.coefficients.toArray(), rel=1e-3)


def test_linear_cross_validation_reads_the_rows_a_fixed_number_of_times(spark, table):
    def jobs(targets, folds):
        spark.sparkContext.setJobGroup(f"linear-{len(targets)}-{folds}", "")
        result = cross_validate(table, COLUMNS, targets, (0, 1), folds, "linear", {})
        group = spark.sparkContext.statusTracker().getJobIdsForGroup(f"linear-{len(targets)}-{folds}")
        return len(group), result

    few, _ = jobs(["y"], 2)
    many, result = jobs(["y", "z"], 4)
    assert few == many
    assert result.oof.count() == 400 * 2 * 2 and result.test.count() == 100 * 2
    row = result.oof.filter("target = 'z' AND fold = 2 AND seed = 1").orderBy("row_id").first()
    want = LinearRegression(labelCol="y_z").fit(table.filter("fold NOT IN (2, -1)")).transform(table.filter(F.col("row_id") == row.row_id)).first()
    assert row.prediction == pytest.approx(want.prediction) and row.truth == want.y_z == pytest.approx(row.truth)
    tests = result.test.filter("target = 'y'").orderBy("row_id").limit(5).collect()
    models = [LinearRegression(labelCol="y_y").fit(table.filter(f"fold NOT IN ({f}, -1)")) for f in range(4)]
    for r in tests:
        parts = [m.transform(table.filter(F.col("row_id") == r.row_id)).first().prediction for m in models]
        assert r.prediction == pytest.approx(np.mean(parts))


def test_columns_that_follow_from_others_and_constants(spark):
    df = spark.range(60).selectExpr(
        "id AS row_id", "'train' AS split", "CAST(id % 3 AS INT) AS fold", "CAST(id AS DOUBLE) AS a", "2.0D * id + 1 AS twice", "CAST(7 AS DOUBLE) AS same",
        "5.0D * id - 4 AS y",
    )
    made = cross_validate(assemble(df, ["a", "twice", "same"], ["y"]), ["a", "twice", "same"], ["y"], (0,), 3, "linear", {})
    assert all(r.prediction == pytest.approx(r.truth) for r in made.oof.collect())
    assert rows(made.oof, "row_id") == [(i,) for i in range(60)]


def test_missing_targets_are_told(spark):
    df = spark.createDataFrame([(0, "train", 0, 1.0, None), (1, "train", 1, 2.0, 2.0)], "row_id long, split string, fold int, a double, y double")
    with pytest.raises(ValueError, match="without a target"):
        cross_validate(assemble(df, ["a"], ["y"]), ["a"], ["y"], (0,), 2, "linear", {})
