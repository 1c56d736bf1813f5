"""Ranked search against scores added up document by document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from foldwright.llm.lexical import BLOCK, BUNDLE, TOGETHER, owners_of, rank_documents, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def brute(docs, items, k):
    counted = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    n = sum(1 for _, c in counted if c)
    total = sum(c.total() for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in set(items):
        found = []
        for doc, c in counted:
            m = 100 - 25 + (25 * c.total() * n) // total if c else 0
            score = 0
            for w, times in Counter(TERM.findall((text or "").translate(LOWER))).items():
                if w in c:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                    score += times * weight * (10**9 * c[w] // (1000 * c[w] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def frames(spark, docs, items, parts=3):
    left = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id long, text string, part int, score string").repartition(parts)
    return left, spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id long, text string, score double")


def words(chance, n, size=200):
    return " ".join(f"w{min(int(chance.paretovariate(0.6)), size)}" for _ in range(n))


@pytest.mark.parametrize("owners", [1, 4])
@pytest.mark.parametrize("item_bytes", [1 << 20, 600])
def test_same_as_brute_force(spark, owners, item_bytes):
    chance = random.Random(1)
    docs = [(i, words(chance, chance.randint(0, 60))) for i in range(400)]
    docs += [(500 + i, docs[7][1]) for i in range(40)]  # ties
    docs += [(1, docs[1][1]), (1, docs[1][1]), (None, docs[7][1]), (600, None), (601, ""), (602, "!? "), (603, words(chance, 20_000)), (604, "É é W1,w1\tＷ1 w1é")]
    items = [(i, words(chance, chance.randint(1, 25))) for i in range(30)]
    items += [(0, items[0][1]), (1, "w1 w1 other"), (50, None), (51, " ."), (52, "nowhere"), (None, "w2 w3"), (53, "É é w1É")]
    got = rank_documents(*frames(spark, docs, items), k=5, owners=owners, item_bytes=item_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 5)


def test_more_documents_than_a_block_and_more_items_than_a_lane(spark):
    chance = random.Random(2)
    docs = [(i, words(chance, 4, 40)) for i in range(BLOCK + 300)]
    items = [(i, words(chance, 2, 40)) for i in range(BUNDLE * TOGETHER + 20)]
    got = rank_documents(*frames(spark, docs, items[:40], 1), k=3, owners=2)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items[:40], 3)
    docs = docs[:50]
    got = rank_documents(*frames(spark, docs, items), k=3, owners=2)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 3)


def test_nothing_to_rank(spark):
    for docs, items in ([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, "b")]):
        assert rank_documents(*frames(spark, docs, items)).collect() == []


def test_a_term_of_every_document_adds_nothing(spark):
    docs = [(i, "all") for i in range(2000)]
    assert rank_documents(*frames(spark, docs, [(1, "all")])).collect() == []


def test_terms():
    assert terms("Ab-C9 ÀÉ\x85 x_y") == [b"ab", b"c9", "ÀÉ\x85".encode(), b"x", b"y"]


def test_owners_have_like_shares_and_the_first_the_rarest():
    df = np.array([5, 1, 100, 1, 50, 50])
    owner = owners_of(df, 2)
    assert owner[1] == owner[3] == 0 and owner[2] == 1 and abs(df[owner == 0].sum() - df[owner == 1].sum()) <= 100
