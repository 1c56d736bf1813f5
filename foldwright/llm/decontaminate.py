"""Documents that hold benchmark items, by SimHash of item-sized windows.

A window has as many words as the item it is held against; a document that is
shorter than the item is one window, whole. The window's SimHash is
looked up in a multi-index: the fingerprint is cut into blocks, and two
fingerprints within ``radius`` bits are within ``radius // blocks`` in at least
one of them. An item is filed once for each block, and a window looks under all
block values that near its own, so it meets every fingerprint in the radius.
What it finds is then judged exactly, by the similarity of the two multisets of
shingles: shared over all, each shingle weighted by how often it occurs.

Most windows cannot pass that last test and get no fingerprint: to reach the
similarity t to an item of k shingles, a window of n shingles must have at least
(n + k)t / (1 + t) that some item has. This is counted with prefix sums, and
loses nothing.

The benchmark is cut into parts by a hash and each part is indexed in a task of
its own. One index at a time is fetched and broadcast; it takes about three
times the part's text.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.workspace import materialise

from .batches import arrow_schema, begin_task, free_name, pieces_of

SHINGLE, SIMILARITY = 5, 0.8
#: Bits in which the fingerprints of texts alike enough may differ (about ten do at the limit, three more are one
#: standard deviation), and the blocks that a fingerprint is cut into.
RADIUS, BLOCKS = 24, 8
#: Benchmark text in a part, about: what is indexed and sent to the executors at once. More is done in several passes.
INDEXED_BYTES = 4 << 20
#: Windows that are looked up at once.
LOOKED_UP = 512

MATCHES = "doc_id long, item_id long, similarity double, first_word long, n_words long"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SCREEN_BITS = 22
_FILED = (1 << 20) - 1


class _Plain(dict):
    """For ``str.translate``: drops all characters but letters, digits and white space."""

    def __missing__(self, code: int) -> int | None:
        self[code] = code if chr(code).isalnum() or chr(code).isspace() else None
        return self[code]


_PLAIN = _Plain()


def plain_words(text: str) -> list[str]:
    """What lies between white space, in one case and with letters and digits alone; nothing where none are left."""
    return text.casefold().translate(_PLAIN).split()


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of every ``size`` words in a row."""
    n = max(len(words) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = (out ^ words[i : i + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _fingerprint(votes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bits that over half of ``n`` shingles have set; ``votes``: how many have, per bit."""
    return np.packbits(2 * votes > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


class Index:
    """The items by block values and length, and their shingles."""

    def __init__(self, items: Iterable[tuple[int | None, str, int]], shingle: int, similarity: float, radius: int, blocks: int):
        """``items``: (id, text, rows that are just so)."""
        self.shingle, self.similarity, self.radius, self.blocks = shingle, similarity, radius, blocks
        self.ids, self.copies, self.texts_of, prints, lengths, hashes = [], [], [], [], [], {}
        for item, text, copies in items:
            words = plain_words(text or "")
            if not words:
                continue
            size = min(shingle, len(words))
            own = _shingles(_hashes(words), size)
            hashes.setdefault(size, []).append(own)
            self.ids.append(item)
            self.copies.append(copies)
            self.texts_of.append(" ".join(words))
            prints.append(_fingerprint(_bits(own).sum(0, dtype=np.int64)[None], np.array([len(own)]))[0])
            lengths.append(len(words))
        self.prints, self.lengths = np.array(prints, np.uint64), np.array(lengths, np.int64)
        self.shingles = {size: np.unique(np.concatenate(h)) for size, h in hashes.items()}
        width = 64 // blocks
        self.flips = np.array([sum(1 << b for b in c) for n in range(radius // blocks + 1) for c in combinations(range(width), n)], np.int64)
        keys = [self._key(self.lengths, block, self._value(self.prints, block)) for block in range(blocks)]
        order = np.argsort(np.concatenate(keys), kind="stable")
        self.keys, self.owners = np.concatenate(keys)[order], (order % max(len(self.ids), 1)).astype(np.int32)
        self.screens, self.filed = {}, None

    def screen(self, size: int) -> np.ndarray:
        """Which low bits some shingle of ``size`` words has; made where it is used, as it is larger than the shingles."""
        if size not in self.screens:
            self.screens[size] = np.zeros(1 << _SCREEN_BITS, bool)
            self.screens[size][self.shingles[size] & np.uint64((1 << _SCREEN_BITS) - 1)] = True
        return self.screens[size]

    def _value(self, prints: np.ndarray, block: int) -> np.ndarray:
        width = 64 // self.blocks
        return (prints >> np.uint64(width * block) & np.uint64((1 << width) - 1)).astype(np.int64)

    def _key(self, lengths: np.ndarray, block: int, value: np.ndarray) -> np.ndarray:
        return (lengths * self.blocks + block) * (1 << 64 // self.blocks) + value

    def near(self, lengths: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item): all items of the length that a window is held against within the radius of its fingerprint."""
        if self.filed is None:  # under which low bits of a key something is filed
            self.filed = np.zeros(_FILED + 1, bool)
            self.filed[self.keys & _FILED] = True
        # windows alike are looked up once: a text that repeats itself has many
        kinds, kind = np.unique(np.stack([lengths.astype(np.uint64), prints]), axis=1, return_inverse=True)
        order = np.argsort(kind.ravel(), kind="stable")
        first = np.searchsorted(kind.ravel()[order], np.arange(kinds.shape[1] + 1))
        windows, items = [], []
        for start in range(0, kinds.shape[1], LOOKED_UP):
            length, own = kinds[0, start : start + LOOKED_UP].astype(np.int64), kinds[1, start : start + LOOKED_UP]
            met = []
            for block in range(self.blocks):
                key = self._key(length[:, None], block, self._value(own, block)[:, None] ^ self.flips).ravel()
                asked = np.flatnonzero(self.filed[key & _FILED])
                key = key[asked]
                a, b = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
                n = b - a
                at = np.repeat(asked // len(self.flips), n)
                item = self.owners[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                close = np.bitwise_count(own[at] ^ self.prints[item]) <= self.radius
                met.append(np.stack([at[close], item[close]]))
            at, item = np.unique(np.concatenate(met, axis=1), axis=1)
            n = first[start + at + 1] - first[start + at]
            windows.append(order[np.repeat(first[start + at] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
            items.append(np.repeat(item, n))
        window, item = np.concatenate(windows), np.concatenate(items)
        by_window = np.lexsort((item, window))
        return window[by_window], item[by_window]

    def hits(self, words: np.ndarray, size: int) -> np.ndarray:
        """Which shingles of ``size`` words some item has."""
        hashes, known = _shingles(words, size), self.shingles[size]
        out = self.screen(size)[hashes & np.uint64((1 << _SCREEN_BITS) - 1)]
        at = np.flatnonzero(out)
        place = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
        out[at] = known[place] == hashes[at]
        return out

    def least_hits(self, window: int, item: int) -> int:
        """Shingles that a window shares with an item at least, to be similar enough, by the shingles of both."""
        return max(1, math.ceil((window + item) * self.similarity / (1 + self.similarity) - 1e-9))

    def document(self, text: str, words: np.ndarray, hits: dict[int, np.ndarray]) -> list[tuple[int | None, float, int, int]]:
        """(item id, similarity, first word, words): the best window for each item that the document holds."""
        found: dict[int, tuple[float, int, int]] = {}
        plain, bags = None, {}
        for size, hit in hits.items():
            lengths = np.unique(self.lengths[np.minimum(self.lengths, self.shingle) == size])
            so_far = np.concatenate([[0], np.cumsum(hit)])
            starts, sizes, against = [], [], []
            for n in lengths.tolist():
                window = min(n, len(words))
                per_window, per_item = window - size + 1, n - size + 1
                held = so_far[per_window:] - so_far[: len(so_far) - per_window]
                # no more than the shingles of a shorter document can be shared
                at = np.flatnonzero(held >= self.least_hits(per_window, per_item))
                starts.append(at)
                sizes.append(np.full(len(at), window))
                against.append(np.full(len(at), n))
            if not starts or not sum(map(len, starts)):
                continue
            start, length, item_length = np.concatenate(starts), np.concatenate(sizes), np.concatenate(against)
            # the windows may lie far apart in a long text: only the shingles that they cover are summed up
            near = np.zeros(len(hit) + 1, np.int64)
            np.add.at(near, start, 1)
            np.add.at(near, start + length - size + 1, -1)
            covered = np.flatnonzero(np.cumsum(near)[:-1])
            place = np.searchsorted(covered, start)
            votes = np.zeros((len(covered) + 1, 64), np.int32)
            np.cumsum(_bits(_shingles(words, size)[covered]), axis=0, out=votes[1:])
            shingles = length - size + 1
            prints = _fingerprint(votes[place + shingles] - votes[place], shingles)
            for window, item in zip(*(x.tolist() for x in self.near(item_length, prints))):
                if plain is None:
                    plain = plain_words(text)
                a, n = int(start[window]), int(length[window])
                if item not in bags:
                    bags[item] = bag(self.texts_of[item].split(" "), size)
                value = similarity(bag(plain[a : a + n], size), bags[item])
                if value >= self.similarity and (item not in found or (-value, a) < (-found[item][0], found[item][1])):
                    found[item] = value, a, n
        return [(self.ids[i], *m) for i, m in sorted(found.items()) for _ in range(self.copies[i])]

    def texts(self, texts: list[str]) -> list[list[tuple]]:
        """``document`` for each text; those without hits cost their hashes alone."""
        out = []
        for text in texts:
            words = _hashes(plain_words(text))
            hits = {size: hit for size in self.shingles if (hit := self.hits(words, size)).any()}
            out.append(self.document(text, words, hits) if hits else [])
        return out


def bag(words: list[str], size: int) -> Counter:
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def similarity(a: Counter, b: Counter) -> float:
    shared = (a & b).total()
    return shared / (a.total() + b.total() - shared)


def indexes(benchmark: DataFrame, shingle: int, similarity: float, radius: int, blocks: int, key: str, text: str) -> Iterator[tuple[int, bytes]]:
    """(parts after this one, index) of each part of the benchmark, made in tasks and stored; one is held at a time."""
    items = benchmark.select(F.col(key).cast("long").alias("item"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    items = materialise(items.groupBy("item", "text").agg(F.count("*").alias("copies")), "items")
    # a part holds about the same text as another: its items are chosen by hash, and rows that are alike are one item
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // INDEXED_BYTES)
    filed = arrow_schema(benchmark.sparkSession, "part long, filed binary")

    def build(rows: pa.Table) -> pa.Table:
        begin_task(__name__)
        own = sorted(zip(*(rows.column(c).to_pylist() for c in ("item", "text", "copies"))), key=lambda r: (r[0] is None, r))
        index = Index(own, shingle, similarity, radius, blocks)
        return pa.table([pa.array([rows.column("part")[0].as_py()]), pa.array([pickle.dumps(index)], pa.binary())], schema=filed)

    if parts:
        placed = items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))
        stored = materialise(placed.groupBy("part").applyInArrow(build, "part long, filed binary"), "item-index")
        for part in range(parts):
            row = stored.filter(F.col("part") == part).first()
            if row is not None:
                yield parts - 1 - part, bytes(row["filed"])


def _each(rows: DataFrame, index: bytes, function: Callable[[Index, pa.RecordBatch], pa.RecordBatch], ddl) -> tuple[DataFrame, Callable]:
    """``function`` of an index over small batches, and what gives the index's memory back."""
    part = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        begin_task(__name__)
        items = pickle.loads(part.value)
        for batch in pieces_of(batches, 256):
            yield function(items, batch)

    return rows.mapInArrow(run, ddl), part.unpersist


def find_contaminated(
    docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS,
    blocks: int = BLOCKS, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): each item that a row's text holds, at its best window.

    Words are the runs between white space, in one case and without other
    characters than letters and digits; ``first_word`` counts them. An item of
    fewer than ``shingle`` words is one shingle. A text with fewer words than
    the item is held against it whole, and ``n_words`` are its own. Of equally
    good windows the first is given. Null or empty texts and items match nothing; null keys and
    repeated rows of either side are reported like any other. Other columns are
    not read. No shuffle of the texts: they are read once per part of the benchmark,
    and the matches of all parts but the last are stored.
    """
    schema, found = arrow_schema(docs.sparkSession, MATCHES), []
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def match(items: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, texts = (c.to_pylist() for c in batch.columns)
        out = [(k, *m) for k, matches in zip(keys, items.texts(texts)) for m in matches]
        return pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out) if out else [[]] * 5, schema)], schema=schema)

    for later, index in indexes(benchmark, shingle, similarity, radius, blocks, item_key, item_text):
        matches, release = _each(rows, index, match, MATCHES)
        if later:
            matches = materialise(matches, "matches")
            release()
        found.append(matches)
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], MATCHES)


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS,
    blocks: int = BLOCKS, text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, all columns as they are; rows with null or empty text stay.

    With a benchmark of several parts the rows are numbered and stored; the numbers that hold an item are stored
    for each part but the last.
    """
    number, stored = free_name("number", docs.columns), None
    place = docs.columns.index(text) if text in docs.columns else [c.lower() for c in docs.columns].index(text.lower())

    def clean(items: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([not m for m in items.texts([t or "" for t in batch.column(place).to_pylist()])], pa.bool_()))

    def held(items: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = [bool(m) for m in items.texts([t or "" for t in batch.column(place).to_pylist()])]
        return batch.select([len(batch.schema) - 1]).filter(pa.array(marks, pa.bool_()))

    bad = []
    for later, index in indexes(benchmark, shingle, similarity, radius, blocks, item_key, item_text):
        if later:
            if stored is None:
                stored = materialise(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
            numbers, release = _each(stored, index, held, f"`{number}` long")
            bad.append(materialise(numbers, "held"))
            release()
        else:
            rows = docs if stored is None else stored.join(reduce(DataFrame.unionByName, bad), number, "left_anti").drop(number)
            return _each(rows, index, clean, docs.schema)[0]
    return docs if stored is None else stored.join(reduce(DataFrame.unionByName, bad), number, "left_anti").drop(number)
