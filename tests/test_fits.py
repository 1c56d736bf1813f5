"""Fits shared by experiments."""

import pytest
from pyspark.sql import functions as F

from foldwright.operators.encoders import CountEncoder, OneHotEncoder, OrdinalEncoder
from foldwright.operators.target_encoding import TargetEncoder
from foldwright.plans.fits import FitStore, fingerprints

from .conftest import rows


@pytest.fixture(scope="module")
def train(spark):
    return spark.range(60).selectExpr(
        "id AS row_id", "CASE WHEN id % 7 > 0 THEN concat('c', id % 5) END AS cat", "concat('d', id % 3) AS late",
        "CAST(id % 3 AS INT) AS fold", "CAST(id AS DOUBLE) AS y",
    )


ENCODERS = [
    CountEncoder(["cat", "late"]), OrdinalEncoder(["cat", "late"]), OneHotEncoder(["cat"]), OneHotEncoder(["cat"], form="vectors"),
    TargetEncoder(["cat"], ["y"], [("cat", "late")]), TargetEncoder(["cat"], ["y"], inner_folds=2),
]


def shown(df):
    return rows(df.select(*[F.col(c).cast("string") for c in df.columns]))


@pytest.mark.parametrize("encoder", ENCODERS, ids=lambda e: type(e).__name__)
def test_a_stored_fit_is_not_made_again(spark, train, tmp_path, monkeypatch, encoder):
    store, tracker = FitStore(str(tmp_path)), spark.sparkContext.statusTracker()
    digests = fingerprints(train, "row_id", encoder.reads())

    def jobs(name):
        spark.sparkContext.setJobGroup(name, name)
        made = store.fit(encoder, train, digests)
        return made, len(tracker.getJobIdsForGroup(name))

    first, many = jobs(f"first {tmp_path}")
    monkeypatch.setattr(type(encoder), "fit", lambda *_: pytest.fail("fitted again"))
    again, few = jobs(f"again {tmp_path}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert few < many
    monkeypatch.undo()
    assert shown(first.transform(train)) == shown(again.transform(train)) == shown(encoder.fit(train).transform(train))


def test_what_a_fit_is_known_by(train):
    store, cols = FitStore("/fits"), ["cat", "late", "fold", "y", "row_id"]
    known = fingerprints(train, "row_id", cols)
    assert fingerprints(train.repartition(5).orderBy("late"), "row_id", cols) == known
    paths = {store.path(e, known) for e in ENCODERS}
    assert len(paths) == len(ENCODERS)
    changed = train.withColumn("late", F.when(F.col("row_id") != 7, F.col("late")))
    other = fingerprints(changed, "row_id", cols)
    assert {c for c in cols if other[c] != known[c]} == {"late"}
    assert store.path(ENCODERS[2], other) == store.path(ENCODERS[2], known)  # reads cat alone
    assert store.path(ENCODERS[0], other) != store.path(ENCODERS[0], known)
    assert fingerprints(train.unionAll(train.filter("row_id = 1")), "row_id", ["cat"])["cat"] != known["cat"]
    swapped = train.withColumn("cat", F.when(F.col("row_id") == 1, "c2").when(F.col("row_id") == 2, "c1").otherwise(F.col("cat")))
    assert fingerprints(swapped, "row_id", ["cat"])["cat"] != known["cat"]
    empty = train.filter("row_id < 0")
    assert fingerprints(empty, "row_id", cols) == fingerprints(empty, "row_id", cols)


def test_fingerprints_are_the_sums_of_all_hashes(train):
    """The sums of halves by partition make those of whole hashes, and of no rows there is none."""
    for df in (train, train.union(train).repartition(7), train.filter("row_id < 0")):
        sums = [F.sum(F.xxhash64(F.lit(way), "row_id", "cat").cast("decimal(20,0)")).cast("string") for way in (0, 1)]
        number, first, second = df.agg(F.count("row_id"), *sums).first()
        assert fingerprints(df, "row_id", ["cat", "y"])["cat"] == f"string:{number}:{first}:{second}"
