import random
import re

import pytest
from pyspark.sql import functions as F

from foldwright.operators.encoders import CountEncoder, FittedCount, OneHotEncoder, OrdinalEncoder

from .conftest import rows


def test_toy_codes(toy):
    train, test = toy
    ordinal = OrdinalEncoder(["cat"]).fit(train)
    count = CountEncoder(["cat"]).fit(train)
    assert [r[1] for r in rows(ordinal.transform(train), "row_id", "cat_OE")] == [1, 2, 3, 1, 2, 1, 4]
    assert [r[1] for r in rows(ordinal.transform(test), "row_id", "cat_OE")] == [1, 4, 3, 2, -1]
    assert [r[1] for r in rows(count.transform(train), "row_id", "cat_CE")] == [3, 2, 1, 3, 2, 3, 1]
    assert [r[1] for r in rows(count.transform(test), "row_id", "cat_CE")] == [3, 1, 1, 2, -1]


def test_toy_onehot(toy):
    train, test = toy
    fitted = OneHotEncoder(["cat"]).fit(train)
    made = fitted.transform(test)
    names = ["cat_mao_OHE", "cat_rena_OHE", "cat_nan_OHE", "cat_ririmu_OHE"]
    assert made.columns == ["row_id", "cat", *names]
    assert [r[1:] for r in rows(made, "row_id", *names)] == [
        (1, 0, 0, 0), (0, 0, 0, 1), (0, 0, 1, 0), (0, 1, 0, 0), (0, 0, 0, 0),
    ]
    vectors = [r[1].toArray().tolist() for r in fitted.vectors(test).select("row_id", "cat_OHE").orderBy("row_id").collect()]
    assert vectors == [[1, 0, 0, 0], [0, 0, 0, 1], [0, 0, 1, 0], [0, 1, 0, 0], [0, 0, 0, 0]]


def test_missing_that_train_never_had(toy):
    train, test = toy
    known = train.filter("cat IS NOT NULL")
    missing = test.filter("cat IS NULL")
    assert rows(OrdinalEncoder(["cat"]).fit(known).transform(missing), "cat_OE") == [(-2,)]
    assert rows(CountEncoder(["cat"]).fit(known).transform(missing), "cat_CE") == [(-1,)]
    onehot = OneHotEncoder(["cat"]).fit(known).transform(missing)
    assert rows(onehot, *[c for c in onehot.columns if c.endswith("_OHE")]) == [(0, 0, 0)]


def test_form_is_chosen_not_switched(spark, toy):
    wide = spark.range(1500).selectExpr("id AS row_id", "concat('c', id) AS cat")
    assert len(OneHotEncoder(["cat"]).fit(wide).transform(wide.limit(1)).columns) == 1502
    made = OneHotEncoder(["cat"], form="vectors").fit(wide).transform(wide)
    assert made.columns == ["row_id", "cat", "cat_OHE"] and made.first().cat_OHE.size == 1500
    with pytest.raises(ValueError, match="form"):
        OneHotEncoder(["cat"], form="wide")


def test_nan_is_a_missing_category(spark):
    df = spark.createDataFrame([(0, 1.0), (1, float("nan")), (2, None)], "row_id long, x double")
    assert rows(CountEncoder(["x"]).fit(df).transform(df), "row_id", "x_CE") == [(0, 1), (1, 2), (2, 2)]


def test_shuffles_do_not_grow_with_the_columns(spark, no_auto_broadcast):
    df = spark.range(300).selectExpr("id AS row_id", "'train' AS split", *[f"concat('c', id % {i + 3}) AS c{i}" for i in range(6)])

    def exchanges(n):
        made = CountEncoder([f"c{i}" for i in range(n)]).fit(df).transform(df, table_bytes=0)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert rows(made, *[f"c{i}_CE" for i in range(n)]) == rows(CountEncoder([f"c{i}" for i in range(n)]).fit(df).transform(df), *[f"c{i}_CE" for i in range(n)])
        return plan.count("Exchange hashpartitioning")

    assert exchanges(6) == exchanges(2) <= 5


def test_save_and_load(spark, toy, tmp_path):
    train, test = toy
    fitted = CountEncoder(["cat"]).fit(train)
    fitted.save(f"{tmp_path}/counts")
    again = FittedCount.load(spark, f"{tmp_path}/counts")
    assert rows(again.transform(test)) == rows(fitted.transform(test))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one category, a sixth have none, the rest spread out."""
    pick = random.Random(7)
    data = []
    for i in range(3000):
        u = pick.random()
        cat = "hot" if u < 1 / 3 else None if u < 0.5 else f"c{pick.randrange(1500)}"
        data.append((i, cat, pick.randrange(5), float(pick.randrange(1000))))
    return spark.createDataFrame(data, "row_id long, cat string, fold int, y double").cache()


def test_shuffle_join_equals_broadcast(skewed, no_auto_broadcast):
    """Beyond the broadcast limit the hot keys are salted; the rows must not change."""
    train = skewed.filter("row_id % 3 <> 0")
    for encoder, source in (
        (CountEncoder(["cat"]), train),
        (OrdinalEncoder(["cat"], rows_per_task=100), train),
        (OrdinalEncoder(["cat"]), train.filter("cat IS NOT NULL AND cat <> 'hot'")),
    ):
        fitted = encoder.fit(source)
        small = fitted.transform(skewed)
        large = fitted.transform(skewed, table_bytes=0)
        # the salt is a part of the shuffle key
        assert re.search(r"SortMergeJoin \[[^\]]*_salt#", large._jdf.queryExecution().toString())
        assert large.columns == small.columns
        assert rows(large) == rows(small)


def test_ranges_equal_one_window(skewed):
    wide = OrdinalEncoder(["cat"]).fit(skewed).transform(skewed)
    ranged = OrdinalEncoder(["cat"], rows_per_task=50).fit(skewed).transform(skewed)
    assert rows(wide) == rows(ranged)


def test_counts_add_up(skewed):
    fitted = CountEncoder(["cat"]).fit(skewed)
    distinct = fitted.transform(skewed).select("cat", "cat_CE").distinct()
    assert distinct.agg(F.sum("cat_CE")).first()[0] == skewed.count()


def test_numeric_passthrough(spark):
    df = spark.createDataFrame([(0, "a", 5), (1, "a", 6), (2, "b", 6)], "row_id long, s string, i int")
    kept = CountEncoder(["i", "s"], numeric="passthrough").fit(df).transform(df)
    assert rows(kept, "row_id", "i_CE", "s_CE") == [(0, 5, 2), (1, 6, 2), (2, 6, 1)]
    encoded = CountEncoder(["i", "s"]).fit(df).transform(df)
    assert rows(encoded, "row_id", "i_CE", "s_CE") == [(0, 1, 2), (1, 2, 2), (2, 2, 1)]
    with pytest.raises(ValueError, match="numeric"):
        CountEncoder(["i"], numeric="x").fit(df)


def test_result_may_be_used_twice(toy):
    """The row counts inside a transform must not get in the way of unions and self joins."""
    made = CountEncoder(["cat"]).fit(toy[0]).transform(toy[0])
    assert made.filter("cat_CE > 1").unionByName(made.filter("cat_CE <= 1")).count() == 7
    again = made.select("row_id", F.col("cat_CE").alias("other"))
    assert made.join(again, "row_id").filter("cat_CE = other").count() == 7
