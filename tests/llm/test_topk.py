"""Exact search against brute force."""

import math
import random

import numpy as np
import pytest

from foldwright.llm.topk import Pivots, as_rows, top_k

SCHEMA = "vec_id long, embedding array<float>, score long"


def brute(rows, every, k, scale=256):
    whole = set()
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.add((i, tuple(math.floor(scale * float(np.float32(x))) for x in v)))
    best = {}
    for i, v in whole:
        if i % every == 0:
            for j, w in whole:
                if j != i:
                    best.setdefault(i, {})
                    score = sum(a * b for a, b in zip(v, w))
                    best[i].setdefault((-score, j), None)
    return sorted((q, rank, j, -s) for q, c in best.items() for rank, (s, j) in enumerate(sorted(c)[:k], 1))


def vectors(n, width, seed, clusters=0):
    chance = random.Random(seed)
    centres = [[chance.gauss(0, 1) for _ in range(width)] for _ in range(clusters)]
    out = []
    for i in range(n):
        base = chance.choice(centres) if clusters else [0] * width
        out.append((i, [b + chance.gauss(0, 0.2) for b in base]))
    return out


@pytest.mark.parametrize("clusters", [0, 6])
@pytest.mark.parametrize("part_rows", [16, 4096])
def test_same_as_brute_force(spark, clusters, part_rows):
    rows = vectors(700, 8, 1, clusters)
    rows += [(1000 + i, rows[50][1]) for i in range(60)]  # one vector many times: ties
    rows += [(2000, None), (2050, [1.0, None] * 4), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8), (None, rows[1][1])]
    rows += [(3000, []), (3050, [1.0, 2.0]), (50, rows[50][1]), (3051, [0.0] * 8)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(4)
    got = top_k(df, 50, part_rows=part_rows, sample=200, pivots=5, rings=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 50, 5)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    got = top_k(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), 50)
    assert sorted(map(tuple, got.collect())) == brute(rows, 50, 5)
    assert top_k(spark.createDataFrame([], SCHEMA), 50).count() == 0
    assert top_k(spark.createDataFrame([(0, [1.0], 0)], SCHEMA), 50).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i % 3), float(-(2**19)), 3.0]) for i in range(120)]
    got = top_k(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), 50)
    assert sorted(map(tuple, got.collect())) == brute(rows, 50, 5)


def test_rings_rule_out_what_lies_far():
    rows = as_rows([np.array(v, "<i8").tobytes() for v in ([1000, 0], [0, 1000], [990, 10], [-1000, 0])], 2)
    pivots = Pivots(rows, 2, 1e6, 3, 2)
    ring, away = pivots.file(rows)
    assert ring[0] // 2 == ring[2] // 2 != ring[3] // 2 and (away >= 0).all()


def test_steps_search_no_more_than_one_jump(spark):
    chance = random.Random(9)
    centres = [[chance.gauss(0, 1) for _ in range(64)] for _ in range(16)]
    tight = [(i, [x + chance.gauss(0, 0.02) for x in centres[i % 16]]) for i in range(3000)]
    df = spark.createDataFrame([(*r, 0) for r in tight], SCHEMA).repartition(4)
    shares, results = [], []
    for steps in ((1,), (1, 8, 32)):
        searched = []
        results.append(sorted(map(tuple, top_k(df, 50, sample=1000, steps=steps, searched=searched).collect())))
        shares.append(sum(pairs for _, pairs in searched) / (searched[0][0] * 16 * 8))
    assert results[0] == results[1] == brute(tight, 50, 5)
    assert shares[1] <= shares[0] < 0.1
