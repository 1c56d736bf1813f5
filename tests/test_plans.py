import pytest
from pyspark.sql import functions as F

from foldwright.operators.boosting import best_round
from foldwright.operators.training import assemble, cross_validate, make_learner
from foldwright.plans import features
from foldwright.plans.config import Learner, Split, TargetEncoding
from foldwright.plans.experiment import run
from foldwright.plans.features import FeatureTable, build_features, feature_table, with_folds
from foldwright.plans.preprocess import STEPS, preprocess, run_steps, step
from foldwright.plans.presets import EXPERIMENTS, SOURCE_SCHEMA, TARGETS, TEXT_COLS
from foldwright.sources.sinks import load_features
from foldwright.streaming.apply import apply_available

from .conftest import rows


@pytest.fixture(scope="module")
def raw(spark):
    """Rows with the source columns, made from the row number."""
    made = {
        "row_id": "id",
        "split": "CASE WHEN id % 5 = 4 THEN 'test' ELSE 'train' END",
        **{c: f"CASE WHEN id % 17 = {i} THEN NULL ELSE concat('{c} ', id % {i + 3}) END" for i, c in enumerate(TEXT_COLS)},
        "farm_name": "concat('farm ', id % 23)",
        "category_one_defects": "CAST(id % 3 AS INT)",
        "category_two_defects": "CAST(id % 8 AS INT)",
        "numberof_bags": "CAST(id % 9 AS INT)",
        "bag_weight": "concat(id % 70, ' kg')",
        "harvest_year": "CASE WHEN id % 2 = 0 THEN '2012' ELSE 'mmm' END",
        "grading_date": "'April 4th, 2015'",
        "expiration": "'2016-04-03'",
        **{c: "CAST(id % 50 AS DOUBLE)" for c in ("altitude_low_meters", "altitude_high_meters", "altitude_mean_meters", "moisture", "quakers")},
        **{t: f"CASE WHEN id % 5 = 4 THEN NULL ELSE CAST(id % {i + 5} + id % 23 AS DOUBLE) END" for i, t in enumerate(TARGETS)},
    }
    assert set(made) == {f.name for f in SOURCE_SCHEMA} | {"row_id", "split"}
    return spark.range(500).selectExpr(*[f"{e} AS {n}" for n, e in made.items()])


@pytest.mark.parametrize(
    "name, width", [("exp_002", 50), ("exp_003", 33), ("exp_004", 61), ("exp_005", 62), ("exp_006", 73), ("exp_007", 84)]
)
def test_feature_widths(raw, name, width):
    table = feature_table(EXPERIMENTS[name], raw)
    assert len(table.features) == width == len(set(table.features))
    assert table.rows.columns[:3] == ["row_id", "split", "fold"]


def test_every_block_together(raw, tmp_path, spark):
    spec = EXPERIMENTS["exp_007"].change(
        features=(
            "get_ordinal_encoding_features", "get_onehot_encoding_features", "get_altitude_features", "get_numberof_bags_feature",
            "get_bag_weight_feature", "get_hervest_year_features", "get_grading_date_features", "get_expiration_features",
            "get_moisture_features", "get_defects_features", "get_quakers_features", "get_cross_num_features",
            "get_agg_region_features", "get_agg_company_features",
        ),
        targets=("aroma",),
    )
    table = feature_table(spec, raw, f"{tmp_path}/features")
    assert sum(c.startswith("agg_") for c in table.features) == 56
    assert "yield" in table.features and "grading_date_julian" in table.features
    stored = FeatureTable.load(spark, f"{tmp_path}/features")
    assert stored.features == table.features and stored.least == table.least
    test = load_features(spark, f"{tmp_path}/features/table", "test")
    assert test.count() == 100 and test.filter("fold IS NOT NULL").count() == 0


def test_a_block_that_changes_the_rows_is_told(raw, tmp_path):
    spec = EXPERIMENTS["exp_002"]
    table = build_features(spec, with_folds(spec, run_steps(raw, spec.preprocess)))
    doubled = FeatureTable(table.rows.unionByName(table.rows.limit(3)), table.features, table.targets)
    with pytest.raises(ValueError, match="500 before, 503 after"):
        doubled.save(f"{tmp_path}/doubled", 500)
    assert table.save(f"{tmp_path}/whole", 500).rows.count() == 500


def test_source_is_scanned_a_fixed_number_of_times(raw, spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    feature_table(EXPERIMENTS["exp_007"], raw.mapInArrow(count, raw.schema))
    assert seen.value == 2 * 500  # for the groups, and for the stored copy


@pytest.mark.parametrize("name", ["exp_005", "exp_007"])
def test_the_stored_rows_hold_what_the_features_read(raw, monkeypatch, name):
    spec, stored, store = EXPERIMENTS[name], {}, features.materialise
    monkeypatch.setattr(features, "materialise", lambda df, to: stored.update({to: df.columns}) or store(df, to))
    made = feature_table(spec, raw)
    assert "moisture" not in stored["folded"] and "grading_date_julian" not in stored["folded"]
    assert {"row_id", "split", "fold", "farm_name", "is_specialty", *spec.targets, *spec.count_cols} <= {*stored["folded"]}
    whole = build_features(spec, with_folds(spec, run_steps(raw, spec.preprocess)))
    assert made.features == whole.features and rows(made.rows) == rows(whole.rows.select(*made.rows.columns))


def test_columns_read_by_every_kind_of_feature(raw, monkeypatch):
    columns = run_steps(raw, EXPERIMENTS["exp_007"].preprocess).columns
    spec = EXPERIMENTS["exp_007"].change(features=("get_ordinal_encoding_features", "get_agg_region_features", "get_moisture_features"))
    kept = features.read_columns(spec, columns)
    assert {*spec.ordinal_cols, "region", "yield", "altitude_mean_meters", "moisture"} <= {*kept} and "owner" not in kept
    monkeypatch.setitem(features.BLOCKS, "own", lambda spec, train: lambda df: df)
    assert features.read_columns(spec.change(features=("own",)), columns) == columns


def test_onehot_vectors_in_a_configured_run(raw):
    spec = EXPERIMENTS["exp_002"].change(
        features=("get_onehot_encoding_features", "get_quakers_features"), onehot_cols=("farm_name", "region"), onehot_form="vectors",
        targets=("aroma",), seeds=(0,), split=Split("farm_name", 3), learner=Learner("gbt", PARAMS, None),
    )
    outcome = run(spec, raw)
    named = {r.feature for r in outcome.result.importance.select("feature").distinct().collect()}
    assert "quakers" in named and len(named) > 23


def test_names_in_paths(signal):
    odd = signal.withColumnRenamed("y_y", "y_a/b=c %")
    result = cross_validate(odd, ["a", "b"], ["a/b=c %"], (0,), 3, "linear", {})
    assert {r.target for r in result.oof.select("target").distinct().collect()} == {"a/b=c %"}
    assert {r.target for r in result.test.select("target").distinct().collect()} == {"a/b=c %"}


def test_configuration_errors_come_early(raw):
    spec = EXPERIMENTS["exp_007"]
    with pytest.raises(ValueError, match="unknown steps"):
        run_steps(raw, ["uniform_bag_weight", "nothing"])
    rows_ = run_steps(raw, spec.preprocess).withColumn("fold", F.lit(0))
    with pytest.raises(ValueError, match="unknown features"):
        build_features(spec.change(features=("get_x",)), rows_)
    with pytest.raises(ValueError, match="processing_method_OE"):
        build_features(spec.change(features=("get_agg_region_features",)), rows_)


def test_own_step_and_split(raw):
    @step("double_quakers")
    def double(df):
        return df.withColumn("quakers", F.col("quakers") * 2)

    try:
        train, test = preprocess(
            raw.filter("split = 'train'").drop("split"), raw.filter("split = 'test'").drop("split", *TARGETS), ["double_quakers"]
        )
        assert (train.count(), test.count()) == (400, 100)
        assert train.agg(F.max("quakers")).first()[0] == 96.0
    finally:
        del STEPS["double_quakers"]


def test_result_does_not_depend_on_partitioning(raw):
    spec = EXPERIMENTS["exp_005"].change(targets=("aroma",))
    assert rows(feature_table(spec, raw).rows) == rows(feature_table(spec, raw.repartition(5)).rows)


def test_best_round_and_learners():
    errors = [5, 4, 4.5, 4.2, 3, 9, 9, 9, 1]
    assert best_round(errors, 2) == (2, True)
    assert best_round(errors, 3) == (5, True)
    assert best_round(errors, 100) == (9, False)
    with pytest.raises(ValueError, match="unknown learner"):
        make_learner("boost", {}, "y", 0)


@pytest.fixture(scope="module")
def signal(spark):
    df = spark.range(600).selectExpr(
        "id AS row_id", "CASE WHEN id % 5 = 4 THEN 'test' ELSE 'train' END AS split",
        "CASE WHEN id % 5 <> 4 THEN CAST(id % 3 AS INT) END AS fold",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(id % 11 AS DOUBLE) END AS a", "CAST(id % 4 AS DOUBLE) AS b",
        "CASE WHEN id % 5 <> 4 THEN CAST(id % 11 * 3 + id % 4 AS DOUBLE) END AS y",
    )
    return assemble(df, ["a", "b"], ["y"])


PARAMS = {"maxIter": 6, "maxDepth": 3, "stepSize": 0.4, "lossType": "absolute"}


def test_each_row_is_predicted_once_and_well(signal):
    result = cross_validate(signal, ["a", "b"], ["y"], (0, 1), 3, params=PARAMS)
    oof = result.oof.cache()
    assert oof.count() == 480 * 2
    assert oof.groupBy("row_id", "seed").count().filter("count > 1").count() == 0
    assert result.test.count() == 120
    means = oof.groupBy("row_id").agg(F.avg("prediction").alias("m"), F.max("seed_mean").alias("s"))
    assert means.filter(F.abs(F.col("m") - F.col("s")) > 1e-9).count() == 0
    error, constant = oof.agg(
        F.avg(F.abs(F.col("truth") - F.col("prediction"))),
        F.avg(F.abs(F.col("truth") - F.lit(oof.agg(F.median("truth")).first()[0]))),
    ).first()
    assert error < 0.6 * constant
    assert result.importance.count() == 2 * 3 * 2
    assert result.rounds.filter("rounds <> 6").count() == 0


def test_patience_cuts_to_the_best_round(signal):
    full = cross_validate(signal, ["a", "b"], ["y"], (0,), 3, params=PARAMS)
    cut = cross_validate(signal, ["a", "b"], ["y"], (0,), 3, params=PARAMS, stop="patience", patience=1)
    kept = {r.fold: r.rounds for r in cut.rounds.collect()}
    assert all(1 <= n <= 6 for n in kept.values())
    for fold, n in kept.items():
        fewer = cross_validate(signal, ["a", "b"], ["y"], (0,), 3, params={**PARAMS, "maxIter": n})
        assert rows(cut.oof.filter(F.col("fold") == fold)) == rows(fewer.oof.filter(F.col("fold") == fold))
    assert full.oof.count() == cut.oof.count()


def test_doubling_stops_where_one_long_fit_would(signal):
    params = {**PARAMS, "maxIter": 20, "maxDepth": 2, "stepSize": 0.9}
    long_fit = make_learner("gbt", params, "y", 0).fit(signal.filter("fold NOT IN (0, -1)"))
    best, _ = best_round(long_fit.evaluateEachIteration(signal.filter("fold = 0"), "absolute"), 1)
    result = cross_validate(signal, ["a", "b"], ["y"], (0,), 3, params=params, stop="patience", patience=1)
    assert result.rounds.filter("fold = 0").first().rounds == best


@pytest.mark.parametrize("learner, params", [("linear", {}), ("random_forest", {"numTrees": 3})])
def test_other_learners(signal, learner, params):
    result = cross_validate(signal, ["a", "b"], ["y"], (0,), 3, learner, params)
    assert result.oof.count() == 480
    with pytest.raises(ValueError, match="stop"):
        cross_validate(signal, ["a", "b"], ["y"], stop="never")


def test_tolerance_stop(signal):
    result = cross_validate(signal, ["a", "b"], ["y"], (0,), 3, params={**PARAMS, "validationTol": 0.5}, stop="tolerance")
    assert result.rounds.filter("rounds < 6").count() > 0


def test_run_to_submission(raw, tmp_path, spark):
    spec = EXPERIMENTS["exp_002"].change(
        targets=("aroma", "body"), seeds=(0,), split=Split("farm_name", 3), count_cols=("species", "region"),
        target_encoding=TargetEncoding(("region",)), learner=Learner("gbt", PARAMS, None),
    )
    outcome = run(spec, raw, f"{tmp_path}/sub")
    assert {r.target for r in outcome.scores.collect()} == {"aroma", "body", "mean"}
    assert outcome.importance_ranking("aroma").count() == 4
    stored = spark.read.csv(f"{tmp_path}/sub", header=True)
    assert stored.columns == ["row_id", "aroma", "body"] and stored.count() == 100


def test_stream_equals_batch(spark, raw, tmp_path):
    from foldwright.operators.target_encoding import TargetEncoder

    spec = EXPERIMENTS["exp_002"]
    folded = with_folds(spec, raw)
    fitted = TargetEncoder(["region", "color"], ["aroma"]).fit(folded.filter("split = 'train'"))
    wanted = raw.select("row_id", "region", "color")
    wanted.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(wanted.schema).parquet(f"{tmp_path}/in")
    assert rows(apply_available(stream, fitted.transform)) == rows(fitted.transform(wanted))
