import pytest
from pyspark.sql import functions as F

from foldwright.operators.folds import expand_folds, group_kfold, hash_fold, row_kfold

from .conftest import rows


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(
        [(i, None if i % 41 == 0 else f"g{i * i % 37}") for i in range(400)], "row_id long, g string"
    )


def sizes(fitted):
    return [r[1] for r in rows(fitted.table.groupBy("fold").count())]


def test_sizes_differ_by_one(spark):
    for n, k in ((7, 5), (5, 5), (23, 4), (10, 2)):
        df = spark.createDataFrame([(f"g{i}",) for i in range(n)], "g string")
        told = sizes(group_kfold(df, "g", k))
        assert sum(told) == n and told == sorted(told, reverse=True) and told[0] - told[-1] <= 1


def test_too_few_groups(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    with pytest.raises(ValueError, match="folds"):
        group_kfold(df, "g", 5)


def test_no_group_spans_folds_and_missing_is_one(groups):
    placed = group_kfold(groups, "g").transform(groups)
    assert placed.count() == 400
    assert placed.filter("fold IS NULL").count() == 0
    assert placed.groupBy("g").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0


def test_ranges_equal_one_window_and_shuffle_equals_broadcast(groups, no_auto_broadcast):
    plain = group_kfold(groups, "g")
    ranged = group_kfold(groups.repartition(7), "g", rows_per_task=5)
    assert rows(plain.table) == rows(ranged.table)
    assert rows(plain.transform(groups)) == rows(plain.transform(groups, table_bytes=0))


def test_seed_and_shuffle(groups):
    a, b = (group_kfold(groups, "g", seed=s).table for s in (1, 2))
    assert rows(a) != rows(b)
    ordered = rows(group_kfold(groups, "g", shuffle=False).table, "group", "fold")
    named = [r for r in ordered if r[0] is not None]
    assert [f for _, f in named] == sorted(f for _, f in named)


def test_row_folds_and_hash_folds(groups):
    assert sizes(row_kfold(groups, "row_id", 3)) == [134, 133, 133]
    placed = groups.withColumn("fold", hash_fold("g", 3))
    assert {r[0] for r in placed.select("fold").distinct().collect()} <= {0, 1, 2}


def test_expand(groups):
    placed = expand_folds(group_kfold(groups, "g").transform(groups), 5)
    assert placed.count() == 2000
    assert placed.filter("role = 'valid'").count() == 400
