"""Ranked lexical search over an index cut by terms, with items passing from owner to owner.

The documents are cut into blocks of a few thousand. The terms are dealt to
owners, the rarest to the first, so that each owner holds about as many postings. The
items travel in bundles: at each owner, a cogroup by block brings the
accumulators of the bundles, one number for an item and a document, together
with the owner's postings of that block, and the contributions are added as
whole numbers. After the last owner the accumulators are the scores.

Between owners, an accumulator goes if even the largest contributions that
are left cannot bring it to the k-th best partial score of its item: scores only grow, so
it could not be among the k best. Only the strictly smaller go, so ties are kept.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwright.workspace import materialise

from .batches import arrow_schema, begin_task, map_rows, pieces_of, task_number

#: Documents of a block, items of a bundle, bundles that a block meets at once (so a group has as many accumulators at most
#: as their items and a block's documents make), owners.
BLOCK, BUNDLE, TOGETHER, OWNERS = 4096, 64, 16, 6
#: Bytes of item texts that are searched for in one go; more take further passes over the documents.
ITEM_BYTES = 2 << 20

# What makes a term, and the constants of the score.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
WEIGHT, SCALE, SATURATION, FLAT, LENGTH = 1000, 10**9, 12, 75, 25

BLOCKS = "part long, block long, keys array<long>, lengths binary, n_docs long, n_terms long, postings binary"
OWNED = "part long, block long, owner long, lengths binary, postings binary"
HELD = "part long, block long, lane long, places binary, scores binary, items array<long>, best array<long>"
_POSTING = np.dtype([("term", "<u4"), ("doc", "<u2"), ("tf", "<u4")])


def terms(text: str) -> list[bytes]:
    """The maximal runs of digits, letters and characters beyond ASCII; only A-Z is lower-cased."""
    return text.encode().translate(_LETTERS).split()


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, hash, term, n, size) of the distinct items that have terms: each term, its uses, and the length of the item's text."""
    rows = items.select(F.col(key).cast("long").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    ddl = "item_id long, hash long, term binary, n long, size long"

    def run(batch):
        out = [
            (i, h, term, n, len(t))
            for i, h, t in zip(*(c.to_pylist() for c in batch.columns))
            for term, n in Counter(terms(t)).items()
        ]
        return list(zip(*out)) if out else [[]] * 5

    return map_rows(rows.select("item_id", F.xxhash64("text").alias("hash"), "text"), run, ddl)


def blocks_of(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """The postings of ``vocabulary`` in blocks of documents; within one, documents are in the order of their keys, nulls last."""
    schema = arrow_schema(docs.sparkSession, BLOCKS)

    def run(batches):
        begin_task(__name__)
        part, block, held = task_number(), 0, []

        def close():
            held.sort(key=lambda d: (d[0] is None, d[0] or 0))
            counts = [len(ids) for _, _, ids, _ in held]
            found = np.empty(sum(counts), _POSTING)
            found["term"] = np.concatenate([ids for _, _, ids, _ in held])
            found["doc"] = np.repeat(np.arange(len(held)), counts)
            found["tf"] = np.concatenate([tfs for _, _, _, tfs in held])
            found = found[np.argsort(found["term"], kind="stable")]
            lengths = np.array([n for _, n, _, _ in held], "<u4")
            row = [part], [block], [[d[0] for d in held]], [lengths.tobytes()], [int((lengths > 0).sum())], [int(lengths.sum())], [found.tobytes()]
            return pa.record_batch([pa.array(c, t.type) for c, t in zip(row, schema)], schema=schema)

        known = vocabulary.__contains__
        for batch in pieces_of(batches, 256):
            for own, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms(words)
                found = Counter(filter(known, words))
                ids = np.fromiter(map(vocabulary.__getitem__, found), np.uint32, len(found))
                held.append((own, len(words), ids, np.fromiter(found.values(), np.uint32, len(found))))
                if len(held) == BLOCK:
                    yield close()
                    held.clear()
                    block += 1
        if held:
            yield close()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, BLOCKS)


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, and their terms with repeats."""

    n_docs: int
    n_terms: int

    def saturated(self, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The part of a contribution that hangs on the document alone."""
        m = FLAT + LENGTH * lengths.astype(np.int64) * self.n_docs // self.n_terms
        return SCALE * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + SATURATION * m)

    def weight(self, df: int) -> int:
        return math.floor(WEIGHT * math.log((2 * self.n_docs + 2) / (2 * df + 1)))


def term_statistics(index: DataFrame, corpus: Corpus, n_terms: int) -> DataFrame:
    """(term, df, most): documents that hold a term, and its largest saturated part. Added up within a task first."""
    ddl = "term long, df long, most long"
    schema = arrow_schema(index.sparkSession, ddl)

    def run(batches):
        df, most = np.zeros(n_terms, np.int64), np.zeros(n_terms, np.int64)
        for batch in pieces_of(batches, 1):
            lengths, found = np.frombuffer(batch.column(0)[0].as_py(), "<u4"), np.frombuffer(batch.column(1)[0].as_py(), _POSTING)
            if len(found):
                starts = np.flatnonzero(np.append(True, found["term"][1:] != found["term"][:-1]))
                own = found["term"][starts]
                df[own] += np.diff(np.append(starts, len(found)))
                most[own] = np.maximum(most[own], np.maximum.reduceat(corpus.saturated(found["tf"], lengths[found["doc"]]), starts))
        met = np.flatnonzero(df)
        yield pa.record_batch([pa.array(met), pa.array(df[met]), pa.array(most[met])], schema=schema)

    counted = index.select("lengths", "postings").mapInArrow(run, ddl)
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"))


def owners_of(df: np.ndarray, owners: int) -> np.ndarray:
    """The owner of each term: the rarest terms go to the first, and all have about as many postings."""
    order = np.argsort(df, kind="stable")
    before = np.cumsum(df[order]) - df[order]
    owner = np.empty(len(df), np.int64)
    owner[order] = before * owners // max(int(df.sum()), 1)
    return owner


def owned_postings(index: DataFrame, owner: np.ndarray) -> DataFrame:
    """The postings of each block dealt to the owners of their terms, one row for an owner."""

    def run(batch):
        out = []
        for part, block, lengths, data in zip(*(c.to_pylist() for c in batch.columns)):
            found = np.frombuffer(data, _POSTING)
            own = owner[found["term"]]
            out += [(part, block, o, lengths, found[own == o].tobytes()) for o in np.unique(own).tolist()]
        return list(zip(*out)) if out else [[]] * 5

    return map_rows(index.select("part", "block", "lengths", "postings"), run, OWNED, 1)


class Bundle:
    """What one owner adds to the accumulators of a bundle of items: for each of its terms, the items that hold it."""

    def __init__(self, first: int, entries: list[tuple[int, int, int]]):
        """``entries``: (term, item, times the item holds the term)."""
        self.first = first
        found = np.array(sorted(entries), np.int64).reshape(-1, 3)
        self.terms, starts = np.unique(found[:, 0], return_index=True)
        self.items, self.times = np.split(found[:, 1], starts[1:]), np.split(found[:, 2], starts[1:])


def _add(held: list[tuple[np.ndarray, np.ndarray]], bundles: list[Bundle], found: np.ndarray, parts: np.ndarray, weight: np.ndarray, n_items: int, rest: np.ndarray, least: np.ndarray, n_docs: int):
    """The accumulators of a block after an owner's contributions, bundle by bundle: (places, scores).

    A place is item * BLOCK + document. ``rest``: what later owners can add to an item at most; ``least``: its k-th best.
    """
    starts = np.flatnonzero(np.append(True, found["term"][1:] != found["term"][:-1])) if len(found) else np.empty(0, int)
    ends, own = np.append(starts[1:], len(found)), found["term"][starts]
    places = np.concatenate([p for p, _ in held]) if held else np.empty(0, np.int64)
    scores = np.concatenate([s for _, s in held]) if held else np.empty(0, np.int64)
    for bundle in bundles:
        items = min(BUNDLE, n_items - bundle.first)
        total = np.zeros((items, n_docs), np.int64)
        low, high = np.searchsorted(places, [bundle.first * BLOCK, (bundle.first + items) * BLOCK])
        at = places[low:high]
        total[at // BLOCK - bundle.first, at % BLOCK] = scores[low:high]
        _, here, there = np.intersect1d(own, bundle.terms, assume_unique=True, return_indices=True)
        for i, j in zip(here.tolist(), there.tolist()):
            added = weight[own[i]] * parts[starts[i] : ends[i]]
            docs = found["doc"][starts[i] : ends[i]]
            for item, times in zip(bundle.items[j].tolist(), bundle.times[j].tolist()):
                total[item - bundle.first, docs] += times * added
        span = slice(bundle.first, bundle.first + items)
        item, doc = np.nonzero((total > 0) & (total + rest[span, None] >= least[span, None]))
        if len(item):
            yield (item + bundle.first) * BLOCK + doc, total[item, doc]


def _best(places: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best places of each item, ties to the earlier document."""
    order = np.lexsort((places, -scores, places // BLOCK))
    item = (places // BLOCK)[order]
    new = np.append(True, item[1:] != item[:-1])
    nth = np.arange(len(item)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    kept = order[nth < k]
    return places[kept], scores[kept]


def _visit(held: DataFrame | None, owned: DataFrame, bundles: list[Bundle], weight: np.ndarray, corpus: Corpus, n_items: int, rest: np.ndarray, least: np.ndarray, k: int) -> DataFrame:
    """The bundles' accumulators after one owner."""
    schema = arrow_schema(owned.sparkSession, HELD)
    lanes = -(-len(bundles) // TOGETHER)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        lane = key[2].as_py()
        before = [
            (np.frombuffer(p, "<i8"), np.frombuffer(s, "<i8")) for p, s in zip(left.column("places").to_pylist(), left.column("scores").to_pylist())
        ]
        if right.num_rows:
            found = np.frombuffer(right.column("postings")[0].as_py(), _POSTING)
            lengths = np.frombuffer(right.column("lengths")[0].as_py(), "<u4")
            parts = corpus.saturated(found["tf"], lengths[found["doc"]])
            own = bundles[lane * TOGETHER : (lane + 1) * TOGETHER]
            out = list(_add(before, own, found, parts, weight, n_items, rest, least, len(lengths)))
        else:
            out = before
        if not out:
            return schema.empty_table()
        places, scores = (np.concatenate(x) for x in zip(*out))
        alive = scores + rest[places // BLOCK] >= least[places // BLOCK]
        places, scores = places[alive], scores[alive]
        best, most = _best(places, scores, k)
        row = [key[0].as_py()], [key[1].as_py()], [lane], [places.tobytes()], [scores.tobytes()], [best], [most]
        return pa.table([pa.array(c, t.type) for c, t in zip(row, schema)], schema=schema)

    met = owned.select("part", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"), "lengths", "postings")
    group = ["part", "block", "lane"]
    left = held if held is not None else owned.sparkSession.createDataFrame([], HELD)
    return left.groupBy(*group).cogroup(met.groupBy(*group)).applyInArrow(run, HELD)


def _kth(held: DataFrame, k: int, n_items: int) -> np.ndarray:
    """The k-th best partial score of each item, or 0 where it has fewer; the blocks have given out their best."""
    best = held.select(F.explode(F.arrays_zip("items", "best")).alias("b")).select((F.col("b.items") / BLOCK).cast("long").alias("item"), "b.best")
    order = Window.partitionBy("item").orderBy(F.desc("best"))
    least = np.zeros(n_items, np.int64)
    for row in best.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") == k).collect():
        least[row["item"]] = row["best"]
    return least


def search_items(docs: DataFrame, entries: list[tuple[int, bytes, int]], n_items: int, k: int, owners: int, key: str, text: str) -> DataFrame | None:
    """(item, doc_id, score): what may be among the ``k`` best of each item; ``entries`` are (item, term, times)."""
    vocabulary = {term: i for i, term in enumerate(sorted({term for _, term, _ in entries}))}
    index = materialise(blocks_of(docs, vocabulary, key, text), "blocks")
    total = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    corpus = Corpus(total[0] or 0, total[1] or 0)
    if not corpus.n_terms:
        return None
    df, most = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
    for row in term_statistics(index, corpus, len(vocabulary)).collect():
        df[row["term"]], most[row["term"]] = row["df"], row["most"]
    weight = np.array([corpus.weight(n) for n in df.tolist()], np.int64)
    owner = owners_of(df, owners)
    owned = materialise(owned_postings(index, owner), "postings", ("owner",))

    by_bundle: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
    rest = np.zeros((owners, n_items), np.int64)  # what an owner can add to an item at most
    for item, term, times in entries:
        t = vocabulary[term]
        by_bundle[int(owner[t]), item // BUNDLE].append((t, item, times))
        rest[owner[t], item] += times * weight[t] * most[t]
    least, held = np.zeros(n_items, np.int64), None
    for stage in range(owners):
        bundles = [Bundle(b * BUNDLE, by_bundle[stage, b]) for b in range(-(-n_items // BUNDLE))]
        later = rest[stage + 1 :].sum(0)
        own = owned.filter(F.col("owner") == stage)
        held = materialise(_visit(held, own, bundles, weight, corpus, n_items, later, least, k), "accumulators")
        if stage + 1 < owners:
            least = _kth(held, k, n_items)
    best = held.select("part", "block", F.explode(F.arrays_zip("items", "best")).alias("b"))
    found = best.select("part", "block", "b.items", F.col("b.best").alias("score"), (F.col("b.items") / BLOCK).cast("long").alias("item"))
    named = found.join(index.select("part", "block", "keys"), ["part", "block"])
    return named.select("item", F.get("keys", (F.col("items") % BLOCK).cast("int")).alias("doc_id"), "score")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    owners: int = OWNERS, item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 for each item, ties to the smaller key.

    A null text has no terms; items without terms, and those no document has a
    term of, have no rows. Rows of ``docs`` with one key or one text are
    documents each; null keys come last among ties. Items with equal key and
    text count once; rows with one key and several texts have their ranks each. Other columns are not read. An
    empty table on either side gives no rows.

    Items are searched for in parts of about ``item_bytes`` of text, a pass over
    the documents each; the terms of a part reach the driver, the documents never do.
    """
    spark = docs.sparkSession
    given = materialise(item_terms(items, item_key, item_text), "item-terms")
    sizes = given.groupBy("item_id", "hash").agg(F.first("size").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    parts = -(-total // item_bytes)
    ranked = []
    for part in range(parts):
        mine = given.filter(F.pmod(F.xxhash64("item_id", "hash"), F.lit(parts)) == part)
        rows = mine.select("item_id", "hash", "term", "n").collect()
        numbers = {own: i for i, own in enumerate(sorted({(r["item_id"], r["hash"]) for r in rows}, key=lambda x: (x[0] is None, x[0] or 0, x[1])))}
        entries = [(numbers[r["item_id"], r["hash"]], bytes(r["term"]), r["n"]) for r in rows]
        found = search_items(docs, entries, len(numbers), k, owners, key, text) if entries else None
        if found is not None:
            names = spark.createDataFrame([(i, own[0]) for own, i in numbers.items()], "item long, item_id long")
            order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
            best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            ranked.append(best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    if not ranked:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more)
    return out
