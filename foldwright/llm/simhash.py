"""Near duplicates by SimHash and covering locality-sensitive hashing.

Each of the 64 bit places is given a nonzero vector of r + 1 bits. For every
nonzero vector v, a mask keeps the places whose vector has an odd product with
v. The vectors of r or fewer places span less than the whole space, so some v is
orthogonal to them all: any two fingerprints within r bits agree under at least
one of the 2^(r+1) - 1 masks. Equal fingerprints are one node of the graph, and
a bucket gives out a spanning forest of its links, not all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.workspace import materialise

from .batches import arrow_schema, begin_task, free_name, map_rows, text_rows
from .components import components

BITS, SEED = 64, 42
_BYTES = np.uint64(0x0101010101010101)

#: Members of a bucket up to which its links are found by comparing; beyond, by half-radius neighbours.
COMPARED = 16_384
#: Neighbours of such a bucket that are held at once.
HELD = 4_000_000


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words (of all words if there are fewer), A-Z in lower case."""
    parts = text.encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined, h = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([h(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - words + 1].tolist()
    return np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())], np.uint64)


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprint of each group of ``counts`` hashes: bits set in over half of them; none: zero."""
    out = np.zeros(len(counts), np.uint64)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    n = counts[filled]
    # eight bytes of a word count at once, up to 255 hashes; then the bytes are added up
    chunks = -(-n // 255)
    first = np.cumsum(n) - n
    within = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    starts = np.repeat(first, chunks) + 255 * within
    groups = np.cumsum(chunks) - chunks
    for bit in range(8):
        lanes = np.add.reduceat(hashes >> np.uint64(bit) & _BYTES, starts)
        sums = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), groups, axis=0)
        for byte in range(8):
            out[filled] |= (2 * sums[:, byte] > n).astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def fingerprints(docs: DataFrame, words: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, tie): the fingerprint as a signed number and a hash of the text, for every row."""

    def run(batch):
        hashes = [shingle_hashes(t, words) for t in batch.column(1).to_pylist()]
        counts = np.array([len(h) for h in hashes], np.int64)
        return [batch.column(0), majority(np.concatenate(hashes), counts).view(np.int64), batch.column(2)]

    rows = text_rows(docs, key, text).withColumn("tie", F.xxhash64("text"))
    return map_rows(rows, run, "doc_id long, fp long, tie long", 256)


def covering_masks(radius: int) -> list[int]:
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def forest(points: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges within ``radius`` that join the distinct ``points`` as all such edges would."""
    if len(points) > COMPARED:
        return _by_neighbours(points, radius)
    edges, left = [], points
    while len(left) > 1:
        reached, left = [left[:1]], left[1:]
        while reached and len(left):
            wave = reached.pop()
            for p in wave:
                near = np.bitwise_count(left ^ p) <= radius
                if near.any():
                    found, left = left[near], left[~near]
                    edges.append((np.full(len(found), p), found))
                    reached.append(found)
                    if not len(left):
                        break
    return edges


def _by_neighbours(points: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Linear in the points: two are within r bits if and only if some z is within r // 2 of one and the rest of the other.

    Only bits in which the points differ are flipped. The z are met in slices of bounded size.
    """
    varied = np.bitwise_or.reduce(points ^ points[0])
    free = [np.uint64(1 << i) for i in range(BITS) if int(varied) >> i & 1]
    flips = [(n, sum(c, start=np.uint64(0))) for n in range(radius - radius // 2 + 1) for c in combinations(free, n)]
    slices = len(points) * len(flips) // HELD + 1
    edges = []
    for part in range(slices):
        zs, owners, near = [], [], []
        for n, flip in flips:
            z = points ^ flip
            own = np.flatnonzero((z * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(slices) == part)
            zs.append(z[own])
            owners.append(own)
            near.append(np.full(len(own), n > radius // 2))
        z, owner, far = map(np.concatenate, (zs, owners, near))
        order = np.lexsort((far, z))  # the nearer ones of a z come first
        z, owner, far = z[order], owner[order], far[order]
        new = np.append(True, z[1:] != z[:-1])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        linked = ~far[first] & ~new
        pairs = np.unique(np.stack([owner[first[linked]], owner[linked]]), axis=1)
        pairs = pairs[:, pairs[0] != pairs[1]]
        edges.append((points[pairs[0]], points[pairs[1]]))
    return edges


def links(points: DataFrame, radius: int) -> DataFrame:
    """(a, b): edges between distinct fingerprints ``fp`` that join all within ``radius`` bits."""
    masks = [m - (1 << BITS) if m >> (BITS - 1) else m for m in covering_masks(radius)]
    tables = F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("kept")) for i, m in enumerate(masks)]))
    rows = points.select("fp", tables.alias("t")).select("t.mask", "t.kept", "fp")
    schema = arrow_schema(points.sparkSession, "a long, b long")

    def run(batches):
        begin_task(__name__)
        held: list[np.ndarray] = []  # of the bucket that may go on in the next batch
        bucket = None

        def edges_of(buckets: list[np.ndarray]):
            found = [e for b in buckets for e in forest(b.view(np.uint64), radius)]
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                yield pa.record_batch([pa.array(a), pa.array(b)], schema=schema)

        for batch in batches:
            mask, kept, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(fp):
                continue
            starts = np.flatnonzero(np.append(True, (mask[1:] != mask[:-1]) | (kept[1:] != kept[:-1])))
            ends = np.append(starts[1:], len(fp))
            done = []
            if bucket == (mask[0], kept[0]):
                held.append(fp[: ends[0]])
                starts, ends = starts[1:], ends[1:]
            if len(starts):
                if held:
                    done.append(np.concatenate(held))
                several = np.flatnonzero(ends[:-1] - starts[:-1] > 1)
                done += [fp[a:b] for a, b in zip(starts[several], ends[several])]
                held, bucket = [fp[starts[-1] :]], (mask[-1], kept[-1])
            yield from edges_of(done)
        if held:
            yield from edges_of([np.concatenate(held)])

    placed = rows.repartition("mask", "kept").sortWithinPartitions("mask", "kept", "fp")
    return placed.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, tie, component_id) of every row.

    ``component_id`` is the smallest key that is reached over links of at most
    ``radius`` differing bits. A null or empty text has the fingerprint zero,
    which links like any other. Null keys take part, but name a component only
    where all its keys are null. Repeated rows and rows with one key are rows of
    their own. Other columns are not read; an empty table gives no rows.
    """
    rows = materialise(fingerprints(docs, words, key, text), "fingerprints")
    points = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    stars = components(links(points, radius))
    rooted = points.join(stars, points["fp"] == stars["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return rows.join(members, "fp").select("doc_id", "fp", "tie", "component_id")


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest key of each group of near duplicates, all columns as they are.

    Where several rows have that key, the one with the smallest hash of its text
    stays; of equal rows one. Of rows whose group has no key at all, one stays for each fingerprint.
    Other columns may have any names.
    """
    found = near_duplicates(docs, words, radius, key, text)
    chosen = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("unnamed")).agg(
        F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.col("tie"))).alias("tie")
    )
    # keys that are never null, so that the join and the last step deal the texts out once, by names that no column has
    both = [free_name(n, docs.columns) for n in ("_kept_id", "_kept_tie")]

    def named(column: str) -> Column:
        return F.coalesce(F.col(column).cast("long").cast("string"), F.lit("")).alias(both[0])

    chosen = chosen.select(named("component_id"), F.col("tie").alias(both[1]))
    tied = docs.select("*", named(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias(both[1]))
    return tied.join(chosen, both, "left_semi").dropDuplicates(both).select(*docs.columns)
