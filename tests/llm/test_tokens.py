"""Token counts, token files and packing against the tokenizers library."""

import random
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from foldwright.llm import pieces, repair
from foldwright.llm.packing import cut, pack, plan
from foldwright.llm.pieces import Encoder, Memory, encoder
from foldwright.llm.token_counts import count_tokens, counter
from foldwright.llm.token_files import token_files

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}

TEXTS = [
    "", " ", "a", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|startoftext|>", "İstanbul ΣΑΣ Σ ß ﬁ", "漢字 かな 한국",
    "\U0001f600 x́ ȩ́", "a\u0085b\x1cc\x1fd　e\xa0f", "  \n\n x  \t", "'s 'S don't I'LL it's!'s", "ab" * 700, "՘ ꟎ ࢏",
    "a  b", "a   b", "a \n b", "a\n b", " a", "a ", "\na\n", "a\r\nb", "x,\ny. z", "1234 5,6 ٣", "\x00 \x7f",
]


def ids_of(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_counts_are_those_of_the_library(text):
    for path in (BYTES, WORDS):
        assert encoder(path)(text) == np.array(ids_of(path, text), "<u4").tobytes()
    assert counter(BYTES)(text) == len(ids_of(BYTES, text))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'stdlm.,aé1Σß漢　\x1c"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_any_text_has_the_ids_of_the_library(text):
    for path in (BYTES, WORDS):
        assert encoder(path)(text) == np.array(ids_of(path, text), "<u4").tobytes()
    assert counter(BYTES)(text) == len(ids_of(BYTES, text))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS)] + [(None, "no key", "x", 1), (3, None, None, None), (2, "a", "x", 2), (2, "a", "x", 2)]
    rows += [(1000 + i, "word " * (400 * i), "x", 0) for i in range(12)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, part long")


def test_memories_share_one_bound(monkeypatch):
    monkeypatch.setattr("foldwright.llm.pieces.REMEMBERED", 50)
    first, second = Memory(len), Memory(str.upper)
    for i in range(200):
        assert first[f"a{i}"] == len(f"a{i}") and second[f"b{i}"] == f"B{i}"
        assert len(first) + len(second) <= 50
    Memory.use_for("another operator")
    assert not first and not second and first["x" * 100] == 100 and not first


def test_a_word_with_a_mark_is_not_searched_for_cuts(monkeypatch):
    encode, asked, cuts = Encoder(WORDS), [], pieces.WORD_LEVEL
    monkeypatch.setattr(pieces, "WORD_LEVEL", SimpleNamespace(findall=lambda word: asked.append(word) or cuts.findall(word)))
    for text in ("stop. over, there; é: why?", "No! a. x$"):
        assert encode(text) == np.array(ids_of(WORDS, text), "<u4").tobytes()
    assert {*asked} == {*".,;:?!$", "x$"}


def empty(docs):
    return docs.limit(0)


def test_count_tokens(docs):
    got = sorted(map(tuple, count_tokens(docs, BYTES, limit=3).collect()), key=str)
    want = []
    for r in docs.collect():
        n = len(ids_of(BYTES, r.text))
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 3))
    assert got == sorted(want, key=str)
    assert count_tokens(empty(docs), BYTES).count() == 0


def test_token_files_hold_all_ids_in_order(docs):
    got = token_files(docs, WORDS, end_id=1).collect()
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert sum(r.n_tokens for r in got) == sum(len(ids_of(WORDS, r.text)) + 1 for r in rows)
    want = sorted((str(r.doc_id), len(ids_of(WORDS, r.text)) + 1, zlib.crc32(np.array([*ids_of(WORDS, r.text), 1], "<u4").tobytes())) for r in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == [r.doc_id for r in rows]
    assert token_files(empty(docs), WORDS, end_id=1).count() == 0


def test_several_shards(docs, monkeypatch):
    monkeypatch.setattr("foldwright.llm.token_files.SHARD_IDS", 500)
    got = sorted(token_files(docs, WORDS, end_id=1).collect(), key=lambda r: r.start)
    assert [a.start + a.n_tokens for a in got[:-1]] == [b.start for b in got[1:]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(2, 6), max_size=200), max_size=30), st.integers(0, 10**6))
def test_shards_round_trip(docs, seed):
    lengths = np.array([len(d) + 1 for d in docs], np.int64)
    ids = np.array([i for d in docs for i in (*d, 1)], np.uint32)
    shard = repair.Shard(repair.pack_shard(lengths, ids, stop=1))
    assert (shard.ids(0, len(ids)) == ids).all() and shard.n_ids == len(ids)
    for i, d in enumerate(docs):
        assert shard.document(i).tolist() == [*d, 1]
    chance = random.Random(seed)
    a, b = sorted((chance.randint(0, len(ids)), chance.randint(0, len(ids))))
    assert (shard.ids(a, b) == ids[a:b]).all()


def test_grammar_shrinks_repeated_text():
    ids = np.array(([5, 6, 7, 8, 9, 10] * 50 + [1]) * 100, np.uint32)
    first, rules, symbols = repair.compress(ids, 1)
    assert len(rules) and len(symbols) < len(ids) / 4
    assert (repair.lengths_of(first, rules) >= 2).all()


def uses(symbols, stop):
    """The most uses without overlap that any pair has, in plain Python."""
    counts, last = defaultdict(int), {}
    for i, pair in enumerate(zip(symbols, symbols[1:])):
        if stop not in pair and last.get(pair) != i - 1:
            counts[pair] += 1
            last[pair] = i
    return max(counts.values(), default=0)


def test_a_copied_passage_becomes_one_symbol():
    passage = [i + 2 for i in range(300)]
    first, rules, symbols = repair.compress(np.array((passage + [1]) * 500, np.uint32), 1)
    assert len(symbols) == 1000 and repair.lengths_of(first, rules).max() == 300


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.sampled_from([100, 3000, 20_000]))
def test_no_frequent_pair_is_left(seed, kinds, n):
    chance = np.random.default_rng(seed)
    ids = np.minimum(chance.geometric(0.3, n), kinds).astype(np.uint32)
    first, rules, symbols = repair.compress(ids, 1)
    assert uses(symbols.tolist(), 1) < repair.LEAST_USES
    assert len({*map(tuple, rules.tolist())}) == len(rules)
    shard = repair.Shard(repair.pack_shard(np.array([n]), ids, 1))
    assert (shard.ids(0, n) == ids).all()


def test_a_frequent_pair_among_many_has_its_rule():
    chance = np.random.default_rng(7)
    rare = chance.integers(10, 1_500_000, (400_000, 2))
    often = np.arange(2, 10).reshape(4, 2)  # each meets rare pairs in a small table of hashes
    ids = np.concatenate([np.insert(np.tile(often, (200, 1)), 2, 1, 1).ravel(), np.insert(rare, 2, 1, 1).ravel()])
    _, rules, _ = repair.compress(ids.astype(np.uint32), 1)
    assert sorted(rules.tolist()) == often.tolist()


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=20))
def test_plans_fill_sequences_without_gaps(capacity, counts):
    counts = {min(s, capacity): n for s, n in counts.items()}
    runs = plan(counts, capacity)
    length = np.array([s for s, n in counts.items() for _ in range(n)], np.int64)
    rank = np.array([i for n in counts.values() for i in range(n)], np.int64)
    sequence, offset = runs.place(length, rank)
    held = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist()):
        held[s].append((o, n))
    assert len(held) == runs.sequences
    for parts in held.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in parts) <= 2
    total = int(length.sum())
    assert runs.sequences <= max(2 * -(-total // capacity), 0)


def test_large_items_are_matched():
    assert plan({60: 5, 40: 5, 50: 4, 35: 2}, 100).sequences == 8
    assert plan({}, 10).sequences == 0
    with pytest.raises(ValueError):
        plan({11: 1}, 10)


def test_cut():
    assert cut(1, 2) == [(0, 1)] and cut(2, 2) == [(0, 2)] and cut(5, 2) == [(0, 1), (1, 2), (3, 2)]


def test_pack(docs):
    capacity = 64
    got = pack(docs, BYTES, capacity).collect()
    held, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for parts in held.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    want = defaultdict(list)
    for r in docs.collect():
        ids = np.array([*ids_of(BYTES, r.text), 0], "<u4")
        for i, (start, n) in enumerate(cut(len(ids), capacity)):
            want[r.doc_id].append((i, start, n, zlib.crc32(ids[start : start + n].tobytes())))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    total = sum(n for v in want.values() for _, _, n, _ in v)
    assert len(held) <= 1.05 * total / capacity + 1
    assert pack(empty(docs), BYTES).count() == 0
