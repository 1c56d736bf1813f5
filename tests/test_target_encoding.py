import pytest
from pyspark.sql import functions as F

from foldwright.operators.target_encoding import TargetEncoder

from .conftest import rows


def values(df, name="cat_TE_y"):
    return [r[1] for r in rows(df, "row_id", name)]


def test_toy_out_of_fold(te_toy):
    prior = TargetEncoder(["cat"], ["y"]).fit(te_toy).transform(te_toy)
    assert values(prior) == [6.0, 6.0, 1.5, 8.0, 4.0, 5.0, 3.0, 3.0]
    null = TargetEncoder(["cat"], ["y"], unseen="null").fit(te_toy).transform(te_toy)
    assert values(null) == [6.0, 6.0, 1.5, 8.0, 4.0, 5.0, 3.0, None]
    constant = TargetEncoder(["cat"], ["y"], unseen=-1).fit(te_toy).transform(te_toy)
    assert values(constant)[-1] == -1.0


def test_toy_test_rows(spark, te_toy):
    test = spark.createDataFrame(list(enumerate(["a", "b", "c", None, "z"])), "row_id long, cat string")
    fitted = TargetEncoder(["cat"], ["y"]).fit(te_toy)
    assert values(fitted.transform(test)) == [3.0, 6.0, 7.0, 4.0, 4.5]
    with_null_fold = test.withColumn("fold", F.lit(None).cast("int"))
    assert values(fitted.transform(with_null_fold)) == [3.0, 6.0, 7.0, 4.0, 4.5]
    fitted = TargetEncoder(["cat"], ["y"], unseen="null").fit(te_toy)
    assert values(fitted.transform(test)) == [3.0, 6.0, 7.0, 4.0, None]


def test_a_fold_without_the_category_takes_the_other_folds(spark, te_toy):
    new = spark.createDataFrame([(0, "c", 0), (1, "c", 1), (2, "z", 0)], "row_id long, cat string, fold int")
    assert values(TargetEncoder(["cat"], ["y"]).fit(te_toy).transform(new)) == [7.0, 3.0, 6.0]


def test_weight_counts_each_train_row_once(te_toy):
    assert TargetEncoder(["cat"], ["y"]).fit(te_toy).sizes["cat"].weight == te_toy.count()


def test_own_fold_never_leaks(te_toy):
    before = TargetEncoder(["cat"], ["y"]).fit(te_toy).transform(te_toy)
    changed = te_toy.withColumn("y", F.when(F.col("fold") == 0, F.col("y") * 100 + 7).otherwise(F.col("y")))
    after = TargetEncoder(["cat"], ["y"]).fit(changed).transform(changed)
    keep = F.col("fold") == 0
    assert values(before.filter(keep)) == values(after.filter(keep))
    assert values(before.filter(~keep)) != values(after.filter(~keep))


def test_shuffle_join_and_partitioning(te_toy, no_auto_broadcast):
    fitted = TargetEncoder(["cat"], ["y"], [("cat", "fold")]).fit(te_toy.repartition(3))
    small = fitted.transform(te_toy)
    assert rows(fitted.transform(te_toy.repartition(4), table_bytes=0)) == rows(small)
    assert small.columns == [*te_toy.columns, "cat_TE_y", "grouping_cat_and_fold_TE_y"]


def test_decimal_targets_and_missing_values(spark):
    df = spark.createDataFrame(
        [(0, "a", 0, None, 1), (1, "a", 1, 4.0, 2), (2, "a", 2, 8.0, 3)], "row_id long, cat string, fold int, y double, z int"
    ).withColumn("d", F.col("z").cast("decimal(18,2)"))
    made = TargetEncoder(["cat"], ["y", "d"]).fit(df).transform(df)
    assert values(made) == [6.0, 8.0, 4.0]
    assert values(made, "cat_TE_d") == [2.5, 2.0, 1.5]


def test_inner_folds_average_leave_one_out_means(spark):
    from foldwright.operators.folds import hash_fold

    df = spark.createDataFrame(
        [(i, "ab"[i % 2], i % 3, float(i * i % 17)) for i in range(60)], "row_id long, cat string, fold int, y double"
    )
    made = TargetEncoder(["cat"], ["y"], inner_folds=3).fit(df).transform(df)
    plain = [(r.row_id, r.cat, r.fold, r.y, r.i) for r in df.withColumn("i", hash_fold("row_id", 3, 42)).collect()]
    for row in made.collect():
        means = []
        for i in range(3):
            kept = [y for _, c, f, y, inner in plain if c == row.cat and f != row.fold and inner != i]
            if kept:
                means.append(sum(kept) / len(kept))
        assert row.cat_TE_y == pytest.approx(sum(means) / len(means))


def test_bad_options():
    with pytest.raises(ValueError, match="unseen"):
        TargetEncoder(["a"], ["y"], unseen="zero")
    with pytest.raises(ValueError, match="inner_folds"):
        TargetEncoder(["a"], ["y"], inner_folds=1)


def test_saved_models_apply_as_before(spark, te_toy, tmp_path):
    from foldwright.operators.folds import GroupFolds, group_kfold
    from foldwright.operators.group_stats import FittedStats, GroupStats
    from foldwright.operators.target_encoding import FittedTarget

    for fitted, kind in (
        (TargetEncoder(["cat"], ["y"], [("cat", "row_id")]).fit(te_toy), FittedTarget),
        (GroupStats(["cat"], ["y"], ["mean", "std"]).fit(te_toy), FittedStats),
        (group_kfold(te_toy.drop("fold"), "cat", 2), GroupFolds),
    ):
        path = f"{tmp_path}/{kind.__name__}"
        fitted.save(path)
        source = te_toy.drop("fold") if kind is GroupFolds else te_toy
        assert rows(kind.load(spark, path).transform(source)) == rows(fitted.transform(source))
