"""Substring dedup against a brute-force version."""

import random
import re

import pytest

from foldwright.llm import substring
from foldwright.llm.substring import dedup_substrings, lengths_to


def brute(rows, n):
    """(key, words, kept words): a null key is after all others."""
    split = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    order = lambda k: (k is None, k or 0)
    least = {}
    for k, w in split:
        for i in range(len(w) - n + 1):
            s = tuple(w[i : i + n])
            least[s] = min(least.get(s, order(k)), order(k))
    out = []
    for k, w in split:
        gone = {j for i in range(len(w) - n + 1) if least[tuple(w[i : i + n])] < order(k) for j in range(i, i + n)}
        out.append((k, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(7)
    word = lambda: chance.choice("abcdefgh") + chance.choice(["", "é", " x", "\x1c"])
    passages = [[word() for _ in range(n)] for n in (3, 5, 9, 30)]
    out = []
    for i in range(60):
        parts = []
        for _ in range(chance.randint(0, 5)):
            parts += chance.choice(passages) if chance.random() < 0.6 else [word() for _ in range(chance.randint(1, 12))]
        out.append((i, chance.choice([" ", "\n", "\t \x0b"]).join(parts)))
    hot = " ".join(passages[3])
    out += [(100 + i, f"x{i} {hot} y{i}") for i in range(40)]
    out += [(None, hot), (None, hot), (5, out[5][1]), (7, hot), (8, None), (9, ""), (10, "  \n "), (200, " ".join(word() for _ in range(3000)))]
    return out


@pytest.mark.parametrize("n, first", [(1, 7), (3, 2), (5, 2), (5, 7), (13, 7), (13, 1), (26, 4)])
def test_same_as_brute_force(spark, rows, n, first):
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, n_words string").repartition(5)
    assert result(dedup_substrings(docs, n, first)) == brute(rows, n)


def test_many_small_blocks_and_buckets(spark, rows, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK_BYTES", 500)
    monkeypatch.setattr(substring, "BUCKET_ENTRIES", 64)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(dedup_substrings(docs, 5, 2)) == brute(rows, 5)


def test_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c", [1.5], "l"), (2, "z a b c", None, None)], "doc_id long, text string, extra array<double>, block string")
    got = dedup_substrings(docs, 3, 2, rejoin=False).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.extra, r.block, r.n_removed) for r in got] == [(1, "a b c", [1.5], "l", 0), (2, "z", None, None, 3)]
    assert dedup_substrings(docs.limit(0), 3).count() == 0


def test_untouched_texts_can_stay_as_they_are(spark):
    docs = spark.createDataFrame([(1, "a\nb  c"), (2, "a b\nd")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in dedup_substrings(docs, 2, rejoin=False).collect()} == {1: "a\nb  c", 2: "d"}
    assert {r.doc_id: r.text for r in dedup_substrings(docs, 2).collect()} == {1: "a b c", 2: "d"}


def test_lengths_double():
    assert lengths_to(13) == [7, 13] and lengths_to(50, 4) == [4, 8, 16, 32, 50] and lengths_to(3) == [3]
