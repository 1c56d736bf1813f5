"""Benchmark items in documents against brute force."""

import pickle
import random

import pytest

from foldwright.llm import decontaminate
from foldwright.llm.decontaminate import Index, bag, decontaminated, find_contaminated, similarity


def words(text):
    return [w for t in (text or "").split() if (w := "".join(c for c in t.casefold() if c.isalnum()))]


def brute(docs, items, shingle=5, least=0.8):
    out = []
    for d, text in docs:
        w = words(text)
        for i, item in items:
            own = words(item)
            if not own:
                continue
            size, n = min(shingle, len(own)), len(own)
            scored = [(-similarity(bag(w[a : a + n], size), bag(own, size)), a) for a in range(len(w) - n + 1)]
            if scored and -min(scored)[0] >= least:
                out.append((d, i, -min(scored)[0], min(scored)[1], n))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    chance = random.Random(11)
    word = lambda: chance.choice(["red", "Blue", "sea", "tide", "zwölf", "né"]) + str(chance.randint(0, 200))
    items = [(i, " ".join(word() for _ in range(chance.randint(12, 70)))) for i in range(30)]
    items += [(30, "one two"), (31, "three"), (32, "a b a b a b a b a b a b"), (None, "no key item of seven plain words"), (33, None), (34, " ... "), (3, items[3][1])]
    docs = []
    for d in range(80):
        text = [word() for _ in range(chance.randint(0, 120))]
        if d % 3 == 0:
            copy = chance.choice(items[:30])[1].split()
            for _ in range(chance.choice([0, 0, 1, 2, 4])):
                copy[chance.randrange(len(copy))] = word()
            text[len(text) // 2 : 0] = [w.upper() + "," for w in copy] if d % 2 else copy
        docs.append((d, " ".join(text)))
    docs += [(100, "One, two!"), (101, "x three y three"), (102, "a b " * 40), (103, None), (104, ""), (None, items[2][1]), (105, items[4][1]), (105, items[4][1])]
    docs += [(106, "pad " * 30_000 + items[5][1] + " pad" * 3000)]
    return docs, items


def frames(spark, tables):
    docs, items = tables
    return spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int").repartition(4), spark.createDataFrame(items, "item_id long, text string")


def test_same_as_brute_force(spark, tables):
    docs, benchmark = frames(spark, tables)
    got = sorted((tuple(r) for r in find_contaminated(docs, benchmark).collect()), key=str)
    want = brute(*tables)
    assert got == want and len({r[0] for r in want}) >= 20


def test_a_large_benchmark_goes_in_parts(spark, tables, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEXED_BYTES", 3000)
    docs, benchmark = frames(spark, tables)
    assert sorted((tuple(r) for r in find_contaminated(docs, benchmark).collect()), key=str) == brute(*tables)
    bad = {r[0] for r in brute(*tables)}
    got = decontaminated(docs.withColumnRenamed("item_id", "number"), benchmark)
    assert got.columns == ["doc_id", "text", "number"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((tuple(r) for r in docs.collect() if r.doc_id not in bad), key=str)


def test_the_index_is_small():
    chance = random.Random(3)
    items = [(i, " ".join(f"word{chance.randint(0, 20_000)}" for _ in range(chance.randint(20, 60))), 1) for i in range(3000)]
    text = sum(len(t) for _, t, _ in items)
    assert len(pickle.dumps(Index(items, 5, 0.8, 24, 8))) < 4 * text


def test_repeated_items_are_reported_each(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, "x " + item), (2, "y")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, item)] * 3 + [(8, item), (None, item)], "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in find_contaminated(docs, benchmark).collect()]
    assert sorted(got, key=str) == sorted([(1, 7)] * 3 + [(1, 8), (1, None)], key=str)


def test_documents_shorter_than_the_item(spark):
    item = [f"word{i}" for i in range(30)]
    cuts = {1: item[:-1], 2: item[2:], 3: item[:25], 4: item[:26], 5: item[:14] + item[15:], 6: ["x", *item[2:]], 7: item[:4], 8: []}
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in cuts.items()], "doc_id long, text string")
    items = [(1, " ".join(item)), (2, "word0 word1 word2"), (3, " ".join(item[:27])), (4, "word3 word4 word5 word6")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for d, w in cuts.items():
        for i, text in items:
            own = text.split()
            size = min(5, len(own))
            windows = [w[a : a + len(own)] for a in range(max(len(w) - len(own), 0) + 1)]
            values = [similarity(bag(x, size), bag(own, size)) for x in windows]
            if max(values) >= 0.8:
                want.append((d, i, max(values), values.index(max(values)), len(windows[0])))
    assert (1, 1, 25 / 26, 0, 29) in want and (4, 1, 22 / 26, 0, 26) in want
    assert sorted(map(tuple, find_contaminated(docs, benchmark).collect())) == sorted(want)
    bad = {r[0] for r in want}
    assert bad >= {1, 2, 4, 6} and {r.doc_id for r in decontaminated(docs, benchmark).collect()} == cuts.keys() - bad


def test_clean_rows_stay_whole(spark, tables):
    docs, benchmark = frames(spark, tables)
    bad = {r[0] for r in brute(*tables)}
    got = decontaminated(docs, benchmark)
    assert got.columns == docs.columns
    assert sorted(got.collect(), key=str) == sorted((r for r in docs.collect() if r.doc_id not in bad), key=str)


def test_empty_tables(spark, tables):
    docs, benchmark = frames(spark, tables)
    assert find_contaminated(docs.limit(0), benchmark).count() == 0
    assert find_contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontaminated(docs, benchmark.limit(0)).count() == docs.count()


def test_blocks_find_all_within_the_radius():
    chance = random.Random(5)
    index = Index([(i, " ".join(str(chance.random()) for _ in range(20)), 1) for i in range(200)], 5, 0.8, 24, 8)
    import numpy as np

    prints = index.prints[:50].copy()
    for i in range(50):
        for b in chance.sample(range(64), i % 25):
            prints[i] ^= np.uint64(1 << b)
    window, item = index.near(np.full(50, 20), prints)
    want = {(w, i) for w in range(50) for i in range(200) if (int(prints[w]) ^ int(index.prints[i])).bit_count() <= 24}
    assert set(zip(window.tolist(), item.tolist())) == want
