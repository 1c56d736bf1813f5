"""Sketches of quantiles, sketches of hot keys, and the filter for rows that match nothing."""

import pytest
from pyspark.sql import functions as F

from foldwright.operators.encoders import CountEncoder, OrdinalEncoder
from foldwright.operators.lookup import HOT_FRACTION, heavy_keys, key_hash, may_match
from foldwright.operators.quantiles import box_summary, quantiles
from foldwright.operators.sketches import merge_sketches, quantile_sketches, rank_error, sketched_quantiles
from foldwright.operators.target_encoding import TargetEncoder

from .conftest import rows

PROBS = [0.0, 0.1, 0.5, 0.99, 1.0]


@pytest.fixture(scope="module")
def numbers(spark):
    """A permutation of 0..100002 as x, a hot group, NaN and nulls."""
    return spark.range(100_003).selectExpr(
        "id", "CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 2 = 0 THEN 'b' END AS g",
        "CAST(id * 7919 % 100003 AS DOUBLE) AS x", "CASE id % 4 WHEN 0 THEN DOUBLE('NaN') WHEN 1 THEN NULL ELSE 5.0 END AS same",
    )


def test_sketched_quantiles_stay_within_the_stated_error(numbers):
    # errors are normal: twice the bound of 99 % is five deviations
    for k in (200, 800):
        made = sketched_quantiles(quantile_sketches(numbers, ["x", "same"], k=k), PROBS)
        told = {r["column"]: r for r in made.collect()}
        assert told["x"]["n"] == 100_003
        assert [told["x"][f"q_{i}"] for i in (0, 4)] == [0.0, 100_002.0]
        for i, p in enumerate(PROBS):
            assert abs(told["x"][f"q_{i}"] / 100_002 - p) <= 2 * rank_error(k)
            assert told["same"][f"q_{i}"] == 5.0
        assert told["same"]["n"] == 50_001
    assert rank_error(800) < 0.0035 < rank_error(200) < 0.0134


def test_merged_sketches_answer_for_all_rows(numbers):
    parts = [quantile_sketches(numbers.filter(f"id % 3 = {i}"), ["x"], ["g"]) for i in range(3)]
    made = sketched_quantiles(merge_sketches(*parts), [0.25, 0.75])
    exact = {r["g"]: r for r in quantiles(numbers, ["x"], [0.25, 0.75], by=["g"]).collect()}
    told = {r["g"]: r for r in made.collect()}
    assert set(told) == set(exact) == {"hot", "b", None}
    for g, r in told.items():
        assert r["n"] == exact[g]["n"]
        for q in ("q_0", "q_1"):  # the values of a group are spread evenly
            assert abs(r[q] - exact[g][q]) / 100_002 <= 2 * rank_error() + 0.005


def test_the_method_is_asked_for_by_name(numbers):
    few = numbers.filter("id < 50")  # a sketch of few values holds them all
    made = quantiles(few, ["x"], [0.0, 1.0], ["g"], method="sketch")
    assert made.columns == quantiles(few, ["x"], [0.0, 1.0], ["g"]).columns
    assert rows(made) == rows(quantiles(few, ["x"], [0.0, 1.0], ["g"]))
    boxes = box_summary(few, "x", ["g"], method="sketch")
    assert boxes.columns == box_summary(few, "x", ["g"]).columns
    assert rows(boxes, "g", "low", "high") == rows(box_summary(few, "x", ["g"]), "g", "low", "high")
    assert quantiles(few.filter("id < 0"), ["x"], [0.5], method="sketch").count() == 0
    with pytest.raises(ValueError, match="method"):
        quantiles(few, ["x"], [0.5], method="guess")


@pytest.fixture(scope="module")
def late(spark):
    """Train rows of even categories; new rows of which half carry one of them and a quarter one that train never had."""
    train = spark.range(8000).selectExpr("id AS row_id", "'train' AS split", "concat('c', id % 2000) AS cat", "concat('d', id % 1999) AS other", "CAST(id % 5 AS INT) AS fold", "CAST(id AS DOUBLE) AS y")
    new = spark.range(10_000, 30_000).selectExpr(
        "id AS row_id", "'test' AS split", "CASE WHEN id % 2 = 0 THEN 'c7' WHEN id % 4 = 1 THEN 'foreign' ELSE concat('c', id % 6000) END AS cat",
        "CASE WHEN id % 2 = 0 THEN 'd7' WHEN id % 4 = 1 THEN NULL ELSE concat('d', id % 6000) END AS other", "CAST(NULL AS INT) AS fold", "CAST(NULL AS DOUBLE) AS y",
    )
    return train.cache(), new.cache()


def test_heavy_keys(spark, late):
    _, new = late
    named = {r["cat"]: r["h"] for r in new.select("cat", key_hash([F.col("cat")]).alias("h")).distinct().collect()}
    assert set(heavy_keys(new, [F.col("cat")])) == {named["c7"], named["foreign"]}
    assert heavy_keys(new.filter("row_id < 0"), [F.col("cat")]) == ()
    even = spark.range(20_000).select((F.col("id") % 10_000).alias("k"))
    assert heavy_keys(even, [F.col("k")]) == () and HOT_FRACTION > 1e-4


@pytest.mark.parametrize("encoder", [CountEncoder(["cat"]), OrdinalEncoder(["cat"]), TargetEncoder(["cat"], ["y"])], ids=["count", "ordinal", "target"])
def test_keys_hot_in_new_rows_alone_span_many_tasks(spark, late, no_auto_broadcast, monkeypatch, encoder):
    train, new = late
    fitted = encoder.fit(train)
    seen = []
    join = type(new).join

    def watched(self, other, *args, **kwargs):
        salt = [c for c in self.columns if c.endswith("_salt")]
        if salt:
            seen.append(self.groupBy(salt[0]).count().agg(F.max("count"), F.sum("count")).first())
        return join(self, other, *args, **kwargs)

    monkeypatch.setattr(type(new), "join", watched)
    large = fitted.transform(new, table_bytes=0)
    monkeypatch.undo()
    assert seen and all(total == 20_000 and most < 200 for most, total in seen)  # a half and a quarter in one bucket before
    assert rows(large) == rows(fitted.transform(new))


def test_categories_that_match_nothing_are_left_out_before_the_shuffle(spark, late, no_auto_broadcast):
    train, new = late
    long = new.select(F.lit("cat").alias("feature"), F.col("cat").alias("category"), "row_id")
    table = train.select(F.lit("cat").alias("feature"), F.col("cat").alias("category")).distinct()
    keys = [(F.col("category"), "category"), (F.col("feature"), "feature")]
    kept = may_match(long, table, keys, table.count())
    matching = long.join(table, ["feature", "category"], "left_semi")
    assert kept.join(matching, "row_id", "left_semi").count() == matching.count()  # none is lost
    foreign = long.join(table, ["feature", "category"], "left_anti")
    spread = foreign.filter("category <> 'foreign'")
    assert kept.filter("category <> 'foreign'").join(spread, "row_id", "left_semi").count() < spread.count() / 8
    assert may_match(long, table.filter("category IS NULL"), keys, 0).count() == 0
    nulls = spark.createDataFrame([("cat", None)], "feature string, category string")
    assert may_match(nulls, nulls, keys, 1).count() == 1
    for encoder in (CountEncoder(["cat", "other"]), OrdinalEncoder(["cat", "other"]), TargetEncoder(["cat", "other"], ["y"])):
        fitted = encoder.fit(train)
        assert rows(fitted.transform(new, table_bytes=0)) == rows(fitted.transform(new))
