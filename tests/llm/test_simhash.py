"""SimHash links and components against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from foldwright.llm import simhash
from foldwright.llm.components import components
from foldwright.llm.simhash import covering_masks, forest, keep_one, majority, near_duplicates, shingle_hashes


def fingerprint(text, n=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(points, near):
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(points)), 2):
        if near(points[i], points[j]):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
def test_every_pair_within_the_radius_meets_under_some_mask(radius):
    masks = covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    chance = random.Random(radius)
    for _ in range(2000):
        difference = sum(1 << b for b in chance.sample(range(64), radius))
        assert any(difference & m == 0 for m in masks)


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 5])
def test_forests_join_what_all_links_join(radius, monkeypatch):
    chance = random.Random(radius)
    points = set()
    for _ in range(12):
        p = chance.getrandbits(64)
        for _ in range(10):
            points.add(p)
            for b in chance.sample(range(64), chance.randint(1, radius + 1)):
                p ^= 1 << b
    points = np.array(sorted(points), np.uint64)
    want = groups(points.tolist(), lambda a, b: (a ^ b).bit_count() <= radius)
    place = {p: i for i, p in enumerate(points.tolist())}
    monkeypatch.setattr(simhash, "HELD", 20_000)
    for limit in (10_000, 1):
        monkeypatch.setattr(simhash, "COMPARED", limit)
        edges = [(int(x), int(y)) for a, b in forest(points, radius) for x, y in zip(a, b)]
        assert all((a ^ b).bit_count() <= radius for a, b in edges)
        linked = {frozenset((place[a], place[b])) for a, b in edges}
        assert groups(range(len(points)), lambda i, j: frozenset((i, j)) in linked) == want


def test_majority_counts_more_than_255_hashes():
    rows = [np.random.default_rng(i).integers(0, 2**64, n, np.uint64) for i, n in enumerate((0, 1, 2, 255, 256, 1000, 0))]
    got = majority(np.concatenate(rows), np.array([len(r) for r in rows]))
    for r, g in zip(rows, got.tolist()):
        assert g == sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in r) > len(r))


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(3)
    word = lambda: chance.choice(["Al", "be", "ga", "dé", "Ze"]) + str(chance.randint(0, 30))
    out = []
    for i in range(40):
        words = [word() for _ in range(chance.randint(1, 300))]
        for copy in range(chance.randint(1, 4)):
            out.append((len(out) * 7 % 151, " ".join(words)))
            words = [word() if chance.random() < 0.004 else w for w in words]
    out += [(900 + i, out[3][1].upper()) for i in range(50)]
    out += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "a"), (1004, "A b c"), (1004, "A b c"), (None, "a"), (None, "zz yy"), (1005, "x " * 5000)]
    return out


def test_same_as_brute_force(spark, rows):
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, fp int").repartition(6)
    got = near_duplicates(docs)
    prints = [fingerprint(t) for _, t in rows]
    roots = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (k, _), root in zip(rows, roots):
        least[root] = min([x for x in (least.get(root), k) if x is not None], default=None)
    want = sorted(((k, p, least[r]) for (k, _), p, r in zip(rows, prints, roots)), key=str)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got.collect()), key=str) == want
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({least[r] for r in roots if least[r] is not None})
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["zz yy"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).count() == 0 and keep_one(docs).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == [(i, 0) for i in range(1, 61)] + [(100 + i, 100) for i in range(1, 50)] + [(201, 200)]


def test_shingles_of_short_texts():
    assert shingle_hashes("", 4).tolist() == []
    assert shingle_hashes("A  b", 4).tolist() == [xxhash.xxh64_intdigest(b"a b", 42)]
