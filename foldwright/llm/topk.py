"""Exact top-k by inner product over a pivot-distance index.

The largest inner product is the smallest distance once every vector has one more
coordinate that gives all the same length, so the triangle inequality holds.
Each vector is filed under its nearest pivot and its distance from it; the
distances of a pivot are cut into rings (annuli), sorted outwards. A query first
searches the ring it lies in, then the others in steps, nearest first, by the
least distance that the triangle inequality leaves a vector of the ring. The k-th
score found so far bounds the distance that a better vector may have, so each step
visits only rings that can reach within it; the others are ruled out. Rings hold every row.

Pivots and ring edges come from a bounded sample and only decide how much is
searched, never what is found. A ring of many vectors is split by a hash of
their ids, and a task holds one such part while the queries stream past it.
Vectors travel in the narrowest whole numbers that hold every component.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwright.workspace import materialise

from .batches import arrow_schema, begin_task, pieces_of

#: Rows that pivots and rings are chosen on; pivots; rings of each.
SAMPLE_ROWS, PIVOTS, RINGS = 4096, 16, 8
#: Bytes of a part of a ring where it is searched; products that are made at once.
PART_BYTES, PRODUCTS = 32 << 20, 1 << 20
#: Rings that a query has visited after each step but the last, which takes all others.
STEPS = (1, 8, 32)
#: Distances are compared with this share of slack, far above their rounding.
SLACK = 1e-9

INDEX = "vec_id long, vector binary, ring long, away double"
ROUTED = "ring long, part long, kind long, vec_id long, vector binary, least double"
FOUND = "query_id long, vector binary, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int, key: str, vector: str, kind: str = "<i8") -> DataFrame:
    """(vec_id, vector, norm): floor(scale * x) of each component as numbers of ``kind``, without the rows that take no part."""
    schema = arrow_schema(vectors.sparkSession, "vec_id long, vector binary, norm double")

    def run(batches):
        for batch in pieces_of(batches):
            out = []
            for own, parts in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = parts.values
                if own is None or values is None or values.null_count:
                    continue
                x = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(x).all():
                    continue
                norm = float(x @ x)
                if norm >= 2.0**63:
                    raise OverflowError(f"the scores of vector {own} do not fit 64 bits")
                out.append((own, x.astype(kind).tobytes(), norm))
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out) if out else [[]] * 3, schema)], schema=schema)

    return vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")).mapInArrow(run, "vec_id long, vector binary, norm double")


def as_rows(vectors: list[bytes], width: int, kind: str = "<i8", number: type = np.int64) -> np.ndarray:
    """The vectors as rows of 64-bit numbers; shorter ones end in zeros. ``kind``: the type of a stored component."""
    out = np.zeros((len(vectors), width), number)
    for i, v in enumerate(vectors):
        own = np.frombuffer(v, kind)
        out[i, : len(own)] = own
    return out


def narrowest(vectors: DataFrame, scale: int, vector: str) -> str:
    """The narrowest type that holds every component floor(scale * x): one pass over the numbers, without Python."""

    def size(x):
        x = x.cast("double")
        return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(F.abs(x))

    most = vectors.agg(F.max(F.array_max(F.transform(F.col(vector), size)))).first()[0] or 0.0
    return next((kind for kind, bits in (("<i1", 7), ("<i2", 15), ("<i4", 31)) if most * scale + 1 < 2.0**bits), "<i8")


class Pivots:
    """The pivots and the ring edges of each."""

    def __init__(self, sample: np.ndarray, width: int, top: float, pivots: int, rings: int):
        self.width, self.top, self.rings = width, top, rings
        points = self.lift(sample)
        chosen = points[:1]
        nearest = np.full(len(points), np.inf)
        while 0 < len(chosen) < min(pivots, len(points)):  # the farthest from those chosen, each time
            nearest = np.minimum(nearest, ((points - chosen[-1]) ** 2).sum(1))
            if nearest.max() == 0:
                break
            chosen = np.vstack([chosen, points[nearest.argmax()]])
        for _ in range(5):
            home = self._distances(points, chosen).argmin(1) if len(points) else np.empty(0, int)
            chosen = np.array([points[home == i].mean(0) if (home == i).any() else c for i, c in enumerate(chosen)]).reshape(len(chosen), width + 1)
        self.points = chosen
        away = self._distances(points, chosen)
        share = np.arange(1, rings) / rings
        home = away.argmin(1) if len(points) else np.empty(0, int)
        self.edges = np.array([np.quantile(away[home == i, i], share) if (home == i).any() else np.zeros(rings - 1) for i in range(len(chosen))])

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """One more coordinate, which brings all to the length of the longest."""
        x = vectors.astype(np.float64)
        return np.hstack([x, np.sqrt(np.maximum(self.top - (x * x).sum(1), 0))[:, None]])

    @staticmethod
    def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([((points - p) ** 2).sum(1) for p in pivots], 1)) if len(pivots) else np.empty((len(points), 0))

    def file(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ring, distance from the pivot) of each vector."""
        away = self._distances(self.lift(vectors), self.points)
        home = away.argmin(1)
        own = away[np.arange(len(home)), home]
        return home * self.rings + (self.edges[home] < own[:, None]).sum(1), own

    def from_queries(self, queries: np.ndarray) -> np.ndarray:
        """Distances of the queries, whose further coordinate is zero, from all pivots."""
        x = queries.astype(np.float64)
        return self._distances(np.hstack([x, np.zeros((len(x), 1))]), self.points)


def _search(rows: DataFrame, k: int, width: int, kind: str, top: float) -> DataFrame:
    """The best ``k`` of each part of a ring for each query routed there that reach its ``least`` score."""
    # no sum of products is above the longest vector's square, so doubles are exact below 2^53
    number = np.float64 if top < 2.0**53 else np.int64
    schema = arrow_schema(rows.sparkSession, FOUND)

    def run(batches):
        place, ids, vectors, block = None, [], [], None
        begin_task(__name__)
        for batch in pieces_of(batches, 4096):
            ring, part, query, own, vector, least = (batch.column(i) for i in range(6))
            marks = np.stack([c.to_numpy() for c in (ring, part, query)], 1)
            own, vector, least = own.to_numpy(), vector.to_pylist(), least.to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.append(True, (marks[1:] != marks[:-1]).any(1)))
            for a, b in zip(new, np.append(new[1:], len(marks))):
                if place != tuple(marks[a, :2]):
                    place, ids, vectors, block = tuple(marks[a, :2]), [], [], None
                if marks[a, 2] == 0:
                    ids += own[a:b].tolist()
                    vectors += vector[a:b]
                    continue
                if not ids:
                    continue
                if block is None:  # equal rows once, by ascending id
                    pairs = sorted(set(zip(ids, vectors)))
                    block = np.array([i for i, _ in pairs], np.int64), as_rows([v for _, v in pairs], width, kind, number).T
                    vectors = []
                at_once = max(1, PRODUCTS // len(block[0]))
                for c in range(a, b, at_once):
                    d = min(c + at_once, b)
                    scores = (as_rows(vector[c:d], width, kind, number) @ block[1]).astype(np.int64)
                    fits = (scores >= least[c:d, None]) & (block[0] != own[c:d, None])
                    out = []
                    for q in np.flatnonzero(fits.any(1)):
                        at = np.flatnonzero(fits[q])
                        value = scores[q, at]
                        if len(at) > k:
                            limit = np.partition(value, -k)[-k]
                            at, value = at[value >= limit], value[value >= limit]
                            best = np.argsort(-value, kind="stable")[:k]  # ids ascend, so ties go to the smaller
                            at, value = at[best], value[best]
                        out += [(int(own[c + q]), vector[c + q], i, s) for i, s in zip(block[0][at].tolist(), value.tolist())]
                    yield pa.record_batch([pa.array(x, t.type) for x, t in zip(zip(*out) if out else [[]] * 4, schema)], schema=schema)

    placed = rows.repartition("ring", "part").sortWithinPartitions("ring", "part", "kind", "vec_id")
    return placed.mapInArrow(run, FOUND)


def top_k(
    vectors: DataFrame, every: int, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding",
    sample: int = SAMPLE_ROWS, pivots: int = PIVOTS, rings: int = RINGS, part_rows: int | None = None, steps: tuple[int, ...] = STEPS,
    searched: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the highest whole-number inner product for each query.

    Queries are the rows whose key is divisible by ``every``, candidates all rows
    with another key. Rows whose key or vector is null, or whose vector holds a
    null or a component that is not finite, take no part. Ties go to the smaller
    key. Equal rows count once; rows with one key and different vectors are
    candidates each, and as queries give their best together. Shorter vectors
    end in zeros, empty ones are all zero. A component too large for a 64-bit
    score raises. Other columns are not read; an empty table gives no rows.
    ``steps``: rings that each query has visited after each step but the last;
    ``searched``, if given, gets (queries, pairs of query and ring) of each step.
    """
    spark = vectors.sparkSession
    number = narrowest(vectors, scale, vector)
    whole = materialise(whole_vectors(vectors, scale, key, vector, number), "vectors")
    size = whole.agg(F.max(F.octet_length("vector") / np.dtype(number).itemsize).cast("long"), F.max("norm")).first()
    width, top = size[0] or 0, size[1] or 0.0
    part_rows = part_rows or max(1, PART_BYTES // (8 * max(width, 1)))
    chosen = [r["vector"] for r in whole.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").select("vector").limit(sample).collect()]
    pivot = Pivots(as_rows(chosen, width, number), width, top, pivots, rings)

    filed = arrow_schema(spark, INDEX)

    def file(batches):
        for batch in pieces_of(batches):
            if batch.num_rows:
                ring, away = pivot.file(as_rows(batch.column(1).to_pylist(), width, number))
                yield pa.record_batch([batch.column(0), batch.column(1).cast(pa.binary()), pa.array(ring), pa.array(away)], schema=filed)

    index = materialise(whole.select("vec_id", "vector").mapInArrow(file, INDEX), "index")
    seen = {r["ring"]: r for r in index.groupBy("ring").agg(F.count("*").alias("n"), F.min("away").alias("near"), F.max("away").alias("far")).collect()}
    if not seen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    places = np.array(sorted(seen))
    parts = np.array([-(-seen[r]["n"] // part_rows) for r in places.tolist()])
    near, far = (np.array([seen[r][c] for r in places.tolist()]) for c in ("near", "far"))
    owner = places // rings

    split = F.element_at(F.array(*[F.lit(int(parts[np.searchsorted(places, r)]) if r in seen else 1) for r in range(len(pivot.points) * rings)]), F.col("ring").cast("int") + 1)
    filed_rows = index.select(
        "ring", F.pmod(F.xxhash64("vec_id"), split).alias("part"), F.lit(0).cast("long").alias("kind"), "vec_id", "vector", F.lit(0.0).alias("least")
    )
    routed = arrow_schema(spark, ROUTED)

    def route(start: int, stop: int):
        """Queries to the rings from ``start`` to ``stop`` in the order they are visited that may hold a score of at least ``least``."""

        def run(batches):
            for batch in pieces_of(batches, 64):
                if not batch.num_rows:
                    continue
                ids, raw, ring, least = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
                queries = as_rows(raw, width, number)
                away = pivot.from_queries(queries)[:, owner]
                norm = (queries.astype(np.float64) ** 2).sum(1)
                reach = np.sqrt(np.maximum(norm + top - 2 * least, 0)) + SLACK * (1 + np.sqrt(norm + top))
                gap = np.maximum(near - away, away - far)
                order = np.argsort(np.where(ring[:, None] == places, -np.inf, gap), axis=1, kind="stable")
                turn = np.empty_like(order)
                np.put_along_axis(turn, order, np.arange(len(places))[None], 1)
                visit = (turn >= start) & (turn < stop) & (gap <= reach[:, None] + SLACK * away)
                q, r = np.nonzero(visit)
                q, r = np.repeat(q, parts[r]), np.repeat(r, parts[r])
                part = np.arange(len(r)) - np.searchsorted(_pair(q, r, len(places)), _pair(q, r, len(places)), "left")
                columns = [places[r], part, np.ones(len(r), np.int64), ids[q], pa.array([raw[i] for i in q], pa.binary()), least[q]]
                yield pa.record_batch([pa.array(c, t.type) if not isinstance(c, pa.Array) else c for c, t in zip(columns, routed)], schema=routed)

        return run

    order = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    queries = materialise(index.filter(F.col("vec_id") % every == 0).select("vec_id", "vector", "ring").distinct(), "queries")
    best = []
    ends = sorted({s for s in steps if s < len(places)} | {len(places)})
    for start, stop in zip([0, *ends], ends):
        bounded = queries.withColumn("least", F.lit(float("-inf")))
        if best:
            kth = best[-1].filter(F.col("nth") == k).select(F.col("query_id").alias("vec_id"), "vector", F.col("score").cast("double").alias("so_far"))
            bounded = queries.join(kth, ["vec_id", "vector"], "left").select("vec_id", "vector", "ring", F.coalesce("so_far", F.lit(float("-inf"))).alias("least"))
        visits = materialise(bounded.mapInArrow(route(start, stop), ROUTED), "visits")
        if searched is not None:
            searched.append(tuple(visits.agg(F.count_distinct("vec_id", "vector"), F.count_distinct("vec_id", "vector", "ring")).first()))
        found = _search(filed_rows.unionByName(visits), k, width, number, top)
        both = reduce(DataFrame.unionByName, [b.drop("nth") for b in best[-1:]] + [found])
        best.append(materialise(both.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k), "best"))

    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best[-1].withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _pair(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    return a * width + b
