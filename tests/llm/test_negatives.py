"""Hard negatives against scores of all pairs."""

import math
import random

import numpy as np
import pytest

from foldwright.llm.negatives import Part, join, mine_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank string"


def brute(rows, every):
    whole = {
        (i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for anchor, mark, v in whole:
        if anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), i, label) for i, label, w in whole if i != anchor]
        for s, positive, _ in sorted(x for x in scored if x[2] == mark)[:5]:
            fit = sorted(x for x in scored if x[2] != mark and 50 * -s <= 100 * -x[0] <= 95 * -s)[:3]
            out += [(anchor, positive, rank, i, -s, -n) for rank, (n, i, _) in enumerate(fit, 1)]
    return sorted(out)


def vectors(n, width, seed, labels=4, shift=0.0):
    chance = random.Random(seed)
    return [(i, [chance.gauss(shift, 0.3) for _ in range(width)], chance.randrange(labels)) for i in range(n)]


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 0, "r") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("part_rows", [40, 16_384])
@pytest.mark.parametrize("shift", [0.0, 0.5])
def test_same_as_brute_force(spark, part_rows, shift):
    rows = vectors(500, 12, 1, shift=shift)
    rows += [(600 + i, rows[0][1], i % 2) for i in range(30)]  # one vector many times: ties
    rows += [(700, None, 1), (750, [None] * 12, 1), (800, [float("nan")] * 12, 1), (850, rows[1][1], None), (None, rows[1][1], 1), (900, [float("inf")] * 12, 2)]
    rows += [rows[50], rows[50], (100, rows[3][1], rows[100][2]), (951, [], 1), (950, [], 1), (1000, [2.0], 0), (1001, [0.0] * 12, 3)]
    got = mine_negatives(frame(spark, rows), 50, part_rows=part_rows)
    assert sorted(map(tuple, got.collect())) == brute(rows, 50)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.8, 0.0], 1), (2, [0.7, 0.0], 2), (3, [0.1, 0.0], 2)]
    assert sorted(map(tuple, mine_negatives(frame(spark, rows), 50).collect())) == brute(rows, 50) != []
    for few in ([], rows[:1], rows[:2], rows[2:], [(0, None, 1)]):
        assert sorted(map(tuple, mine_negatives(frame(spark, few), 50).collect())) == brute(few, 50)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**17 + i % 3 * 2**10), float(-(2**16)), 3.0], i % 2) for i in range(120)]
    assert sorted(map(tuple, mine_negatives(frame(spark, rows), 50).collect())) == brute(rows, 50)
    with pytest.raises(Exception, match="64 bits"):
        mine_negatives(frame(spark, [(0, [1e30], 1)]), 50).collect()


@pytest.mark.parametrize("least", [-(10**6), 0, 60_000, 90_000, 10**7])
def test_join_finds_all_above_the_threshold_and_does_less_for_a_high_one(least):
    chance = np.random.default_rng(3)
    rows = np.floor(chance.normal(0, 1, (300, 32)) * (300 / np.arange(1, 33))).astype(np.int64)
    anchors = rows[::20]
    part = Part(np.arange(300), np.zeros(300, np.int64), rows, np.arange(32))
    a, r, scores, made = join(part, anchors, np.full(len(anchors), least))
    all_scores = anchors @ rows.T
    assert sorted(zip(a, r, scores)) == [(i, j, all_scores[i, j]) for i, j in np.argwhere(all_scores >= least)]
    if least >= 60_000:
        assert made < 0.8 * all_scores.size * 32
