import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.operators import importance, metrics, profile, quantiles, reshape, running
from foldwright.operators.group_stats import GroupStats
from foldwright.operators.running import running_total
from foldwright.sources import missing, sinks, tables

from .conftest import rows


def test_group_stats_toy(te_toy):
    fitted = GroupStats(["cat"], ["y"], ["min", "max", "mean", "std", "median", "count"]).fit(te_toy)
    made = fitted.transform(te_toy)
    assert made.columns[4:] == [f"agg_{m}_cat_by_y" for m in ("min", "max", "mean", "std", "median", "count")]
    got = {r.cat: tuple(r)[4:] for r in made.collect()}
    assert got["a"] == (1.0, 6.0, 3.0, pytest.approx(2.6457513110645907), 2.0, 3)
    assert got["b"] == (4.0, 8.0, 6.0, pytest.approx(2.8284271247461903), 6.0, 2)
    assert got["c"] == (7.0, 7.0, 7.0, None, 7.0, 1)
    assert got[None] == (None,) * 6
    assert made.count() == 8


def test_group_stats_shuffle_join(te_toy, no_auto_broadcast):
    fitted = GroupStats(["cat", "fold"], ["y"], ["mean"]).fit(te_toy)
    assert rows(fitted.transform(te_toy, table_bytes=0)) == rows(fitted.transform(te_toy))
    with pytest.raises(ValueError, match="unknown methods"):
        GroupStats(["cat"], ["y"], ["mode"])


def test_running_total_over_ranges(spark):
    pick = random.Random(3)
    data = [("hot" if pick.random() < 0.5 else f"g{pick.randrange(40)}", i, pick.randrange(9)) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, i long, w long")
    plain = running_total(df, ["g"], ["i"], "w", "t", 2000)
    assert rows(plain) == rows(running_total(df, ["g"], ["i"], "w", "t", 2000, rows_per_task=70))
    assert rows(running_total(df, [], ["i"], "w", "t", 2000)) == rows(
        running_total(df, [], ["i"], "w", "t", 2000, rows_per_task=70)
    )


def test_ranges_do_not_grow_without_bound(spark, monkeypatch):
    """Each range costs the driver a task's report and a hundred sampled rows."""
    pick = random.Random(4)
    df = spark.createDataFrame([(f"g{i % 3}", i, pick.randrange(9)) for i in range(1500)], "g string, i long, w long")
    made, store = [], running.materialise
    monkeypatch.setattr(running, "materialise", lambda df, name: made.append(df.rdd.getNumPartitions()) or store(df.coalesce(4), name))
    ranged = running_total(df, ["g"], ["i"], "w", "t", 1500, rows_per_task=1)
    assert rows(ranged) == rows(running_total(df, ["g"], ["i"], "w", "t", 1500))
    assert made == [1000]


def test_quantiles_match_python_and_ranges(spark, no_auto_broadcast):
    pick = random.Random(5)
    data = [("hot" if pick.random() < 0.4 else f"g{pick.randrange(7)}", float(pick.randrange(500))) for _ in range(3000)]
    df = spark.createDataFrame(data, "g string, v double")
    made = quantiles.quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0], by=["g"])
    for row in made.collect():
        mine = [v for g, v in data if g == row.g]
        assert (row.n, row.q_0, row.q_3) == (len(mine), min(mine), max(mine))
        low, mid, _ = statistics.quantiles(mine, n=4, method="inclusive")
        assert (row.q_1, row.q_2) == (pytest.approx(low), pytest.approx(mid))
    ranged = quantiles.quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0], by=["g"], rows_per_task=60, table_bytes=0)
    assert rows(made) == rows(ranged)


def test_csv_missing_tokens_types_and_numbers(spark, tmp_path):
    (tmp_path / "train.csv").write_text("s,i,d,b,y\nx,1,1.5,true,1\nNA,,nan,false,2\n,3,N/A,true,3\nnull,4.0,2,NA,4\n")
    (tmp_path / "test.csv").write_text("s,i,d,b\nz,7,1,true\nw,8,2.5,false\n")
    (tmp_path / "sample_submission.csv").write_text("y\n0\n0\n")
    data = tables.load_dataset(spark, str(tmp_path))
    kinds = {f.name: f.dataType.simpleString() for f in data.train.schema}
    assert kinds == {"row_id": "bigint", "s": "string", "i": "double", "d": "double", "b": "boolean", "y": "bigint"}
    assert rows(data.train, "row_id", "s", "d", "b") == [
        (0, "x", 1.5, True), (1, None, None, False), (2, None, None, True), (3, None, 2.0, None),
    ]
    assert rows(data.test, "row_id", "s") == [(0, "z"), (1, "w")]
    assert data.submission.columns == ["y"]
    explicit = tables.read_csv(spark, f"{tmp_path}/train.csv", T.StructType.fromDDL("i INT"))
    assert rows(explicit, "i") == [(1,), (3,), (4,), (None,)]


def test_numbers_follow_file_order(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"p{part}.csv").write_text("v\n" + "\n".join(str(part * 50 + i) for i in range(50)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        made = tables.read_csv(spark, str(tmp_path))
        assert rows(made, "row_id", "v") == [(i, i) for i in range(150)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "nan"), (1.0, "x")], "d double, s string")
    assert rows(missing.normalise_missing(df)) == [(1.0, "x"), (None, None)]


def test_union_split_and_submission(spark, tmp_path):
    train = spark.createDataFrame([(0, "a", 1.0)], "row_id long, c string, y double")
    test = spark.createDataFrame([(0, "b"), (1, "b")], "row_id long, c string")
    both = reshape.union_train_test(train, test)
    assert rows(both, "row_id", "c", "y", "split") == [(0, "a", 1.0, "train"), (0, "b", None, "test"), (1, "b", None, "test")]
    left, right = reshape.split_train_test(both)
    assert (left.count(), right.count()) == (1, 2)
    long = spark.createDataFrame([(i, t, float(i)) for i in (2, 0, 1) for t in ("p", "q")], "row_id long, target string, prediction double")
    sinks.write_submission(long, ["p", "q"], f"{tmp_path}/sub")
    text = "".join(p.read_text() for p in sorted((tmp_path / "sub").glob("part-*")))
    assert [line for line in text.splitlines() if line != "row_id,p,q"] == ["0,0.0,0.0", "1,1.0,1.0", "2,2.0,2.0"]


def test_guard_sees_repeated_keys(te_toy):
    doubled = te_toy.unionByName(te_toy.filter("row_id = 1"))
    assert rows(reshape.rowcount_guard(te_toy, te_toy, ["row_id"])) == [(8, 8, 0, 1)]
    assert rows(reshape.rowcount_guard(te_toy, doubled, ["row_id"])) == [(8, 9, 1, 0)]


def test_profile_and_flip(te_toy):
    told = {r.column: (r.type, r.non_null, r.rows) for r in profile.profile(te_toy).collect()}
    assert told["cat"] == ("string", 6, 8) and told["y"] == ("double", 8, 8)
    first = profile.missing_rate(te_toy).first()
    assert (first.column, first.missing_rate) == ("cat", 25.0)
    assert rows(profile.flipped(te_toy.filter("row_id = 5"), "row_id", ["cat", "fold"])) == [(5, "cat", None), (5, "fold", "1")]
    assert {r.missing_rate for r in profile.missing_rate(te_toy.limit(0)).collect()} == {None}
    top = profile.group_mean_topk(te_toy, ["cat"], "y", 2)
    assert [tuple(r) for r in top.collect()] == [("c", 7.0), ("b", 6.0)]


def test_metric_edges(spark):
    flat = spark.createDataFrame([(2.0, 2.0, 1.0), (2.0, 2.0, 3.0)], "y double, same double, off double")
    both = ["r2_score", "explained_variance_score"]
    assert {r.score for r in metrics.metric_table(flat, "y", "same", both).collect()} == {1.0}
    assert {r.score for r in metrics.metric_table(flat, "y", "off", both).collect()} == {0.0}
    assert [tuple(r) for r in metrics.metric_table(flat, "y", "off", ["median_absolute_error"]).collect()] == [("median_absolute_error", 1.0)]
    with pytest.raises(ValueError, match="metric"):
        metrics.metric_table(flat, "y", "off", [])


def test_nan_is_missing_in_statistics(spark):
    from foldwright.operators.group_stats import GroupStats

    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0), ("b", None)], "k string, v double")
    made = GroupStats(["k"], ["v"], ["mean", "max", "count", "median"]).statistics(df)
    assert rows(made.drop("__n")) == [("a", 2.0, 3.0, 2, 2.0), ("b", None, None, 0, None)]


def test_fill_lies_below_large_minima(spark):
    df = spark.createDataFrame([(-1e17,), (None,), (float("nan"),)], "x double")
    filled = reshape.fill_below_min(df, ["x"])
    assert [v < -1e17 for (v,) in rows(filled)] == [True, True, False]


def test_quoted_fields(spark, tmp_path):
    (tmp_path / "q.csv").write_text('name,x\n"say ""hi"", ok",1\n"two\nlines",2\n')
    got = tables.read_csv(spark, str(tmp_path / "q.csv"))
    assert rows(got, "row_id", "name", "x") == [(0, 'say "hi", ok', 1), (1, "two\nlines", 2)]
    for name in ("train", "test", "sample_submission"):
        (tmp_path / f"{name}.csv").write_text('name;x\n"a;b";"7"\n')
    data = tables.load_dataset(spark, str(tmp_path), sep=";", multi_line=False)
    assert rows(data.train, "name", "x") == [("a;b", 7)]


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 3.0), (3.0, 3.0, 5.0, 4.0), (8.0, 5.0, 1.0, 1.0)], "y1 double, p1 double, y2 double, p2 double")
    names = [*metrics.METRICS, *metrics.ORDER_METRICS]
    got = {r.metric: r.score for r in metrics.metric_table(df, "y1", "p1", names).collect()}
    assert got["mean_absolute_error"] == pytest.approx(4 / 3)
    assert got["mean_squared_error"] == pytest.approx(10 / 3)
    assert got["max_error"] == 3.0 and got["median_absolute_error"] == 1.0
    assert got["r2_score"] == pytest.approx(1 - 10 / 26)
    pairs = {"a": ("y1", "p1"), "b": ("y2", "p2")}
    scores = {r.target: r.score for r in metrics.columnwise_scores(df, pairs, "mean_absolute_error").collect()}
    assert scores == {"a": pytest.approx(4 / 3), "b": pytest.approx(1 / 3), "mean": pytest.approx(5 / 6)}
    assert metrics.columnwise_scores(df, {"a": ("y1", "p1")}, "median_absolute_error").first().score == 1.0
    with pytest.raises(ValueError, match="unknown metric"):
        metrics.columnwise_scores(df, pairs, "rmse")


def test_importance(spark):
    data = [(f"f{i}", m, float(i + m)) for i in range(60) for m in range(3)]
    df = spark.createDataFrame(data, "feature string, model_no int, importance double")
    top = [r.feature for r in importance.top_features(df).collect()]
    assert top == [f"f{i}" for i in range(59, 9, -1)]
    assert importance.importance_topk(df).count() == 150
    box = importance.importance_boxes(df).filter("feature = 'f59'").first()
    assert (box.low, box.q50, box.high, box.n) == (59.0, 60.0, 61.0, 3)
