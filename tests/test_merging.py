"""States that add up, on batches and on streams."""

import pytest
from pyspark.sql import functions as F

from foldwright.operators.encoders import CountEncoder, FittedCount, OrdinalEncoder
from foldwright.operators.target_encoding import TargetEncoder, TargetState
from foldwright.streaming.fit import add_batch, fit_available, latest_version, load_state

from .conftest import rows


@pytest.fixture(scope="module")
def parts(spark):
    df = spark.range(120).selectExpr(
        "id AS row_id", "CASE WHEN id % 7 = 0 THEN NULL ELSE concat('c', id % 5) END AS cat", "CASE WHEN id < 40 THEN 'early' ELSE concat('d', id % 3) END AS late",
        "CAST(id % 3 AS INT) AS fold", "CASE WHEN id % 11 <> 0 THEN CAST(id AS DOUBLE) END AS y", "CAST(id % 17 AS DECIMAL(18,2)) AS d",
    )
    return df, [df.filter("row_id < 40"), df.filter("row_id >= 40 AND row_id < 41"), df.filter("row_id >= 41"), df.filter("row_id < 0")]


@pytest.mark.parametrize("inner", [None, 3])
def test_merged_target_states_equal_one_fit(spark, parts, tmp_path, inner):
    df, pieces = parts
    encoder = TargetEncoder(["cat", "late"], ["y", "d"], [("cat", "late")], inner_folds=inner)
    first, *others = (encoder.state(p) for p in pieces)
    merged = first.merge(*others)
    want = rows(encoder.fit(df).transform(df))
    assert rows(merged.fitted().transform(df)) == want
    assert merged.table.schema == first.table.schema
    backwards = others[1].merge(first).merge(others[0])
    assert rows(backwards.fitted().transform(df)) == want
    merged.save(f"{tmp_path}/state")
    loaded = TargetState.load(spark, f"{tmp_path}/state")
    assert loaded.encoder.about() == encoder.about()
    assert rows(loaded.merge(others[-1]).fitted().transform(df)) == want


def test_states_of_different_encoders_do_not_merge(parts):
    df, _ = parts
    with pytest.raises(ValueError, match="different encoders"):
        TargetEncoder(["cat"], ["y"]).state(df).merge(TargetEncoder(["late"], ["y"]).state(df))
    with pytest.raises(ValueError, match="different encoders"):
        CountEncoder(["cat"]).fit(df).merge(CountEncoder(["late"]).fit(df))


def test_merged_counts_and_codes_equal_one_fit(parts):
    df, pieces = parts
    for encoder in (CountEncoder(["cat", "late"]), OrdinalEncoder(["cat", "late"]), OrdinalEncoder(["cat", "late"], rows_per_task=3)):
        fits = [encoder.fit(p) for p in (pieces[2], pieces[0], pieces[1], pieces[3])]
        assert rows(fits[0].merge(*fits[1:]).transform(df)) == rows(encoder.fit(df).transform(df))


def test_a_stream_adds_each_batch_once(spark, parts, tmp_path):
    df, pieces = parts
    encoder = TargetEncoder(["cat", "late"], ["y", "d"])
    path, folder = f"{tmp_path}/fit", f"{tmp_path}/in"

    def arrived(some):
        some.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        return fit_available(stream, encoder.state, TargetState, path)

    assert latest_version(spark, path) is None and load_state(spark, path, TargetState) is None
    pieces[0].repartition(3).write.parquet(folder)
    arrived(pieces[1])
    assert latest_version(spark, path) == 3  # one version for each of four files
    state = arrived(pieces[2])
    want = rows(encoder.fit(df).transform(df))
    assert rows(state.fitted().transform(df)) == want
    # batches that come again, old and last ones, change nothing
    last = latest_version(spark, path)
    for number in (0, last):
        assert not add_batch(pieces[0], number, encoder.state, TargetState, path)
    assert rows(load_state(spark, path, TargetState).fitted().transform(df)) == want
    # a version whose description is not written yet does not count, and is written anew
    encoder.state(pieces[0]).table.write.parquet(f"{path}/version={last + 1}/table")
    assert latest_version(spark, path) == last
    assert add_batch(pieces[0], last + 1, encoder.state, TargetState, path)
    twice = encoder.fit(df.unionByName(pieces[0])).transform(df)
    assert rows(load_state(spark, path, TargetState).fitted().transform(df)) == rows(twice)


def test_counts_on_a_stream(spark, parts, tmp_path):
    df, _ = parts
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    encoder = CountEncoder(["cat"])
    fitted = fit_available(stream, encoder.fit, FittedCount, f"{tmp_path}/fit")
    assert rows(fitted.transform(df)) == rows(encoder.fit(df).transform(df))


def test_rows_that_nothing_tells_apart_are_encoded_alike_on_both_paths(spark, no_auto_broadcast):
    """Repeated and null row ids, with and without that column."""
    data = [(1, "a", "x", 0, 1.0), (1, "b", "x", 1, 2.0), (None, "a", "y", 0, 3.0), (2, "a", "y", 1, 4.0), (None, "a", None, 1, 5.0), (1, "a", "x", 0, 1.0)]
    df = spark.createDataFrame(data, "row_id long, c string, d string, fold int, y double").withColumn("split", F.lit("train"))
    numbered = df.withColumn("row_id", F.monotonically_increasing_id())
    for encoder in (CountEncoder(["c", "d"]), OrdinalEncoder(["c", "d"]), TargetEncoder(["c", "d"], ["y"], [("c", "d")])):
        fitted = encoder.fit(numbered)
        for source in (df, df.drop("row_id"), df.select("c", "d", "fold", "split", F.lit(1).alias("row_id"))):
            assert rows(fitted.transform(source, table_bytes=0)) == rows(fitted.transform(source))


def test_vectors_of_repeated_rows(spark, no_auto_broadcast):
    from foldwright.operators.encoders import OneHotEncoder

    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (None, "a", "y")], "row_id long, c string, d string")
    fitted = OneHotEncoder(["c", "d"], form="vectors").fit(df.withColumn("row_id", F.monotonically_increasing_id()))

    def shown(made):
        return sorted((r.c, r.d, r.c_OHE.toArray().tolist(), r.d_OHE.toArray().tolist()) for r in made.collect())

    assert shown(fitted.transform(df, table_bytes=0)) == shown(fitted.transform(df))
