"""Every stage of the pipeline against a plain version, each on its own input; the queries against their SQL."""

import re
import zlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from foldwright.llm.queries import ORACLES, QUERIES
from foldwright.workspace import materialise
from tests.oracle import compare, connect

from .test_decontaminate import brute as contaminated
from .test_simhash import fingerprint, groups
from .test_substring import brute as passages_removed

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), name))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def test_columns(steps):
    assert all(s.columns == COLUMNS for s in steps[:5])


def test_toxicity_keeps_clean_rows_as_they_are(spark, steps):
    assert set(rows(steps[1])) <= set(rows(steps[0]))
    larger = "/root/testdata/sf0.01"  # with labels enough to learn from
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    before, after = rows(docs), rows(corpus_pipeline.STAGES[0][1](spark, docs, larger))
    assert set(after) < set(before)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    gone = {r[0] for r in before} - {r[0] for r in after}
    assert sum(labels.get(d, 0) for d in gone) > 20 and not any(labels.get(d) == 0 for d in gone)


def test_near_duplicates(steps):
    before = rows(steps[1])
    prints = [fingerprint(r[1]) for r in before]
    roots = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r, root in zip(before, roots):
        least[root] = min(least.get(root, r[0]), r[0])
    assert rows(steps[2]) == [r for r in before if r[0] in set(least.values())]


def test_passages(steps):
    before = {r[0]: r for r in rows(steps[2])}
    want = []
    for k, _, removed, text in passages_removed([(r[0], r[1]) for r in before.values()], 13):
        d = before[k]
        want.append((k, text, d[2], d[3], len(text)) if removed else d)
    assert rows(steps[3]) == sorted(want, key=str)


def test_benchmark(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = rows(steps[3])
    bad = {r[0] for r in contaminated([(r[0], r[1]) for r in before], items)}
    assert rows(steps[4]) == [r for r in before if r[0] not in bad]


def test_packing_holds_every_document(steps):
    placed = steps[5].collect()
    assert {r.doc_id for r in placed} == {r[0] for r in rows(steps[4])}
    held = {}
    for r in placed:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    total = sum(r.length for r in placed)
    assert len(held) <= 1.02 * total / 2048 + 1


def test_run_gives_the_last_stage(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, steps[5].collect()))


def test_rows_with_nulls_and_repeats(spark, steps):
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "a b", "en", "s", 3), (1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", None, "s", 0)], steps[0].schema)
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), f"odd-{name}")
    assert sum(r.length for r in docs.collect()) >= 1
    docs = steps[0].limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), f"none-{name}")
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), ORACLES[name], connect(SF)) is None


def test_queries_give_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    counts = {r.doc_id: r for r in QUERIES["op1_token_counts"](spark, SF).collect()}
    assert len(counts) == len(docs) and all(counts[d.doc_id].n_bytes == len((d.text or "").encode()) for d in docs)
    scores = QUERIES["op8_toxicity"](spark, SF).collect()
    assert len(scores) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in scores)
    found = QUERIES["op9_simhash_dedup"](spark, SF).collect()
    assert {r.doc_id: r.fingerprint for r in found} == {d.doc_id: f"{fingerprint(d.text):016x}" for d in docs}
    assert len(QUERIES["op5_token_files"](spark, SF).collect()) == len(docs)
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(n) for n in range(1, 14)}


def test_entry_registers_them():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_columns_of_any_name_stay(spark, steps):
    """Names that the stages use inside, and tables without the columns that they could do without."""
    from pyspark.sql import functions as F

    from corpus_pipeline import STAGES

    some = steps[0].select("doc_id", "text").withColumns(
        {n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in ("_kept_id", "_KEPT_TIE", "n_words", "n_removed", "score", "fp", "tie", "component_id", "block", "part", "rows", "item_id")}
    )
    docs = some
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, SF)
        assert made.columns == some.columns, name
        docs = made
    kept = docs.collect()
    assert kept and all(r[n] == f"{n}{r.doc_id}" for r in kept for n in some.columns[2:])
    assert STAGES[-1][1](spark, docs, SF).columns[:3] == ["doc_id", "piece", "start"]
