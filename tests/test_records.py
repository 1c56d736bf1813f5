"""Quoted files in blocks of a few bytes, against Spark's reader of whole files."""

import random
from pathlib import Path

import pytest

from checks import tables as checks
from foldwright.sources import tables

from .conftest import rows


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cell(chance):
    text = "".join(chance.choices(['"', "\n", ",", "a", "é", " ", "\r\n", "x", "NA"], k=chance.randint(0, 12)))
    return '"' + text.replace('"', '""') + '"' if chance.random() < 0.7 else text.replace('"', "").replace("\n", "").replace("\r", "").replace(",", "")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_records_as_from_whole_files(spark, small_blocks, tmp_path, end):
    chance = random.Random(5)
    for name, n in (("a.csv", 60), ("b.csv", 25), ("c.csv", 0)):
        lines = ["k,t,u"] + [f"{i},{cell(chance)},{cell(chance)}" for i in range(n)]
        if n:
            lines.insert(5, "")
        (tmp_path / name).write_bytes(end.join(lines + [""] * chance.randint(0, 1)).encode())
    whole = tables.read_csv(spark, str(tmp_path))
    split = tables.read_csv(spark, str(tmp_path), split_files=True)
    assert whole.columns == split.columns and whole.count() == 85
    # in files of CR LF lines, the whole-file reader turns those inside a field into LF; here a field stays as it is written
    plain = [tuple(v.replace("\r\n", "\n") if end == "\r\n" and isinstance(v, str) else v for v in r) for r in rows(split)]
    assert sorted(plain, key=str) == sorted(rows(whole), key=str)
    lines = spark.read.text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 10


def test_no_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,t\n")
    assert tables.read_csv(spark, str(tmp_path), split_files=True).collect() == []


def test_no_task_writes_all_files(spark, tmp_path, monkeypatch):
    """The numbers go on from file to file, and the rows of one key may part."""
    chance, written = random.Random(6), []
    data = [(i // 2 if i < 60 else 30, f"a{''.join(chance.choices(['"', chr(10), ',', 'a', 'é'], k=30))}a") for i in range(120)]
    spark.createDataFrame(data, "page_id long, html string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    quoted = checks._quoted
    monkeypatch.setattr(checks, "FILE_BYTES", 500, raising=False)
    monkeypatch.setattr(checks, "_quoted", lambda df, path: written.append(path) or quoted(df, path))
    made = sorted(map(tuple, checks.scan_quoted_split(spark, str(tmp_path)).collect()))
    assert len(list(Path(written[0].removeprefix("file://")).glob("part-*"))) > 4
    assert [r[0] for r in made] == list(range(120)) and [r[1] for r in made] == sorted(k for k, _ in data)
    assert sorted(r[1:] for r in made) == sorted(data)
