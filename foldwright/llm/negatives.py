"""Hard negatives by threshold joins of dense vectors, after the manner of L2AP.

A window asks, for one anchor, for the k best rows of its label or of other labels whose
scores lie between two bounds. A first look at a bounded sample of the rows gives each
window its starting threshold: the k-th best score in it there, or, where the sample does not
fill it, a high share of its span. A round joins the anchors with all rows of at least their
threshold; those whose window is not full by then go on to the next round
with a lower one, down to the window's lower bound, which ends it.

The rows lie in parts of bounded size, each an inverted index: one column per
dimension, the dimensions of most weight first. A row is filed under a
dimension only up to where the rest of it, by the length of its suffix, could
still reach the round's threshold with any anchor of the block; the omitted suffix
is used only to finish scores that may reach it. Partial scores are added
up column by column, and a pair is dropped as soon as its partial score and the lengths of
what is left of both vectors cannot reach the threshold (Cauchy-Schwarz).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwright.workspace import materialise

from .batches import arrow_schema, begin_task, pieces_of
from .topk import as_rows, narrowest

#: Rows of a part, of the sample, anchors that are searched for together, columns between two looks at what can still be reached.
PART, SAMPLE, BLOCK, STRIDE = 16_384, 2048, 256, 16
#: Shares of the way from a window's upper to its lower bound at which the rounds' thresholds lie, where the sample does not set them.
ROUNDS = (0.4, 0.7, 1.0)

LABELLED = "vec_id long, label long, vector binary, norm double"
FOUND = "anchor_id long, vector binary, label long, window long, vec_id long, score long"


def labelled_vectors(vectors: DataFrame, scale: int, key: str, vector: str, label: str, kind: str) -> DataFrame:
    """(vec_id, label, vector, norm): floor(scale * x) as numbers of type ``kind``, without the rows that take no part; equal rows once."""
    schema = arrow_schema(vectors.sparkSession, LABELLED)

    def run(batches):
        begin_task(__name__)
        for batch in pieces_of(batches):
            out = []
            for own, mark, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                values = parts.values
                if own is None or mark is None or values is None or values.null_count:
                    continue
                x = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(x).all():
                    continue
                norm = float(x @ x)
                if norm >= 2.0**56:  # a hundred times a score is compared
                    raise OverflowError(f"the scores of vector {own} do not fit 64 bits")
                out.append((own, mark, x.astype(kind).tobytes(), norm))
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out) if out else [[]] * 4, schema)], schema=schema)

    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    return rows.mapInArrow(run, LABELLED).dropDuplicates(["vec_id", "label", "vector"])


class Part:
    """The inverted index of some rows: their columns in the order of ``order``, and the length of each row from each column on."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, order: np.ndarray):
        place = np.argsort(ids, kind="stable")  # so ties go to the smaller id
        self.ids, self.labels = ids[place], labels[place]
        columns = np.ascontiguousarray(rows[place][:, order].T)
        self.most = float(np.abs(columns).max(initial=0))
        self.columns = columns
        self.rest = lengths_from(columns.T).T
        self.longest = self.rest.max(1, initial=0)

    def exact_with(self, most: float) -> tuple[np.dtype, float]:
        """The fastest type in which scores are exact with components up to ``most``, and a share of slack far above its rounding."""
        bound = most * self.most * max(len(self.columns), 1)
        kind, slack = (np.float32, 1e-5) if bound < 2.0**24 else (np.float64, 1e-9) if bound < 2.0**53 else (np.int64, 1e-9)
        if self.columns.dtype != kind:
            self.columns = self.columns.astype(kind)
        return np.dtype(kind), slack


def lengths_from(rows: np.ndarray) -> np.ndarray:
    """For each row the length of what stands from each column on, and 0 after the last."""
    squares = rows.astype(np.float64) ** 2
    sums = np.cumsum(squares[:, ::-1], 1)[:, ::-1]
    return np.sqrt(np.hstack([sums, np.zeros((len(rows), 1))]))


@dataclass(frozen=True)
class Windows:
    """Windows of one round over a block of anchors."""

    anchor: np.ndarray  # its row in the block
    number: np.ndarray
    same: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray


def join(part: Part, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(anchor, row, score) of all pairs of at least the anchor's ``least``, and how many products that took.

    Columns come in whole strides, so the partial scores of a stride are one product of matrices.
    """
    width, n = part.columns.shape
    kind, slack = part.exact_with(float(np.abs(anchors).max(initial=0)))
    rest, anchors = lengths_from(anchors), anchors.astype(kind)
    bound = least - slack * (1 + rest[:, 0] * part.longest[0])
    # the suffix of a row that no anchor can bring to the threshold by itself is not filed
    if bound.min() > 0:
        filed = (part.rest[:-1] * rest.max(0)[:-1, None] >= bound.min()).sum(0)
    else:
        filed = np.full(n, width)
    ends = np.minimum(-(-filed // STRIDE) * STRIDE, width)
    alive = (rest[:, :1] * part.rest[0] >= bound[:, None]) & ((filed > 0) | (width == 0))
    rounded = np.float32 if kind == np.float32 else np.float64
    scores, made = np.zeros(alive.shape, kind), 0
    strides = [(a, min(a + STRIDE, width)) for a in range(0, width, STRIDE)]
    for start, end in strides:
        rows = np.flatnonzero(alive.any(0) & (ends > start))
        if not len(rows):
            break
        rows = slice(None) if len(rows) == n else rows
        scores[:, rows] += anchors[:, start:end] @ part.columns[start:end, rows]
        left = np.outer(rest[:, end].astype(rounded), part.rest[end, rows].astype(rounded))
        left += scores[:, rows]
        alive[:, rows] &= left >= bound.astype(rounded)[:, None]
        made += (end - start) * left.size
    a, r = np.nonzero(alive)
    scores = scores[a, r]
    for start, end in strides:  # what was not filed is read from the rows themselves
        open_ = np.flatnonzero(ends[r] <= start)
        if not len(open_):
            continue
        for c in range(start, end):
            scores[open_] += anchors[a[open_], c] * part.columns[c, r[open_]]
        made += (end - start) * len(open_)
        kept = scores + rest[a, end] * part.rest[end, r] >= bound[a]
        kept[ends[r] > start] = True
        a, r, scores = a[kept], r[kept], scores[kept]
    scores = scores.astype(np.int64)
    exact = scores >= least[a]
    return a[exact], r[exact], scores[exact], made


def pick(part: Part, own: np.ndarray, marks: np.ndarray, windows: Windows, a: np.ndarray, r: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(window, row, score) of the ``k`` best pairs of each window, ties to the smaller id."""
    order = np.lexsort((part.ids[r], -scores, a))
    a, r, scores = a[order], r[order], scores[order]
    starts, ends = np.searchsorted(a, windows.anchor, "left"), np.searchsorted(a, windows.anchor, "right")
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for w in range(len(windows.anchor)):
        at = slice(starts[w], ends[w])
        row, score, anchor = r[at], scores[at], windows.anchor[w]
        fits = (part.labels[row] == marks[anchor]) == windows.same[w]
        fits &= (part.ids[row] != own[anchor]) & (score <= windows.high[w]) & (score >= windows.least[w])
        first = np.flatnonzero(fits)[:k]
        out.append((np.full(len(first), w), row[first], score[first]))
    return tuple(np.concatenate(x) if out else np.empty(0, np.int64) for x in zip(*out))


def _search(rows: DataFrame, order: np.ndarray, kind: str, k: int) -> DataFrame:
    """The ``k`` best of each part for each window that is routed there, down to the window's ``least``."""
    schema = arrow_schema(rows.sparkSession, FOUND)
    width = len(order)

    def run(batches):
        begin_task(__name__)
        place, index, ids, labels, vectors = None, None, [], [], []
        asked: list[tuple] = []  # a block of anchors: (vec_id, label, vector, windows)

        def answer():
            nonlocal index, ids, labels, vectors
            if index is None and ids:
                index = Part(np.array(ids, np.int64), np.array(labels, np.int64), as_rows(vectors, width, kind), order)
                ids, labels, vectors = [], [], []
            if index is not None and asked:
                at = np.repeat(np.arange(len(asked)), [len(x[3]) for x in asked])
                window, low, high, least = (np.array([w[c] for x in asked for w in x[3]], np.int64) for c in ("window", "low", "high", "least"))
                windows = Windows(at, window, np.array([w["same"] for x in asked for w in x[3]]), low, high, least)
                lowest = np.full(len(asked), np.iinfo(np.int64).max)
                np.minimum.at(lowest, at, least)
                own, marks = (np.array([x[i] for x in asked], np.int64) for i in (0, 1))
                a, r, scores, _ = join(index, as_rows([x[2] for x in asked], width, kind)[:, order], lowest)
                w, r, scores = pick(index, own, marks, windows, a, r, scores, k)
                columns = [own[at[w]], [asked[i][2] for i in at[w]], marks[at[w]], window[w], index.ids[r], scores]
                yield pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)
            asked.clear()

        for batch in pieces_of(batches, 4096):
            for part, is_anchor, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if part != place:
                    yield from answer()
                    place, index, ids, labels, vectors = part, None, [], [], []
                if is_anchor:
                    asked.append(row)
                    if len(asked) == BLOCK:
                        yield from answer()
                else:
                    for held, value in zip((ids, labels, vectors), row):
                        held.append(value)
        yield from answer()

    placed = rows.repartition("part").sortWithinPartitions("part", "is_anchor", "vec_id", "vector", "label")
    return placed.mapInArrow(run, FOUND)


def fill_windows(
    index: DataFrame, sample: DataFrame, n_rows: int, n_anchors: int, part_rows: int, order: np.ndarray, kind: str, windows: DataFrame, k: int, name: str
) -> DataFrame:
    """(anchor_id, vector, label, window, vec_id, score): the ``k`` best rows of each window, in lowering rounds.

    ``windows``: vec_id, label, vector, window, same, low, high. A round gives out what lies
    at or above its threshold, so a window with ``k`` such rows is full; the last threshold is ``low`` itself.
    An anchor travels to a part once, with its windows. ``sample`` is one part of rows of its own.
    """
    parts = max(1, -(-n_rows // part_rows))
    shape = "array<struct<window:bigint,same:boolean,low:bigint,high:bigint,least:bigint>>"
    key = ["anchor_id", "vector", "label", "window"]
    by_score = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id")

    def search(rows: DataFrame, parts: int, lanes: int, asked: DataFrame) -> DataFrame:
        """Every part meets every lane of anchors in a task of its own."""
        anchors = asked.groupBy("vec_id", "label", "vector").agg(F.collect_list(F.struct("window", "same", "low", "high", "least")).cast(shape).alias("windows"))
        part, lane = (F.pmod(F.xxhash64(*of), F.lit(n)) for of, n in ((["vec_id"], parts), (["vec_id", "vector"], lanes)))
        to_lanes, to_parts = (F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")) for n in (lanes, parts))
        fields = ["vec_id", "label", "vector"]
        filed = rows.select(part.alias("p"), F.explode(to_lanes).alias("lane"), F.lit(False).alias("is_anchor"), *fields, F.lit(None).cast(shape).alias("windows"))
        routed = anchors.select(F.explode(to_parts).alias("p"), lane.alias("lane"), F.lit(True).alias("is_anchor"), *fields, "windows")
        placed = filed.unionByName(routed).select((F.col("p") * lanes + F.col("lane")).alias("part"), "is_anchor", *fields, "windows")
        found = _search(placed, order, kind, k)
        return found.withColumn("nth", F.row_number().over(by_score)).filter(F.col("nth") <= k)

    span = F.col("high").cast("double") - F.col("low")
    seeds = search(sample, 1, -(-n_anchors // (SAMPLE // 2)), windows.withColumn("least", F.col("low"))).filter(F.col("nth") == k)
    seeds = seeds.select(F.col("anchor_id").alias("vec_id"), *key[1:], F.col("score").alias("seed"))
    asked, done = materialise(windows.join(seeds, ["vec_id", *key[1:]], "left"), f"{name}-windows"), []
    for i, share in enumerate(ROUNDS):
        ladder = F.greatest(F.col("low"), F.ceil(F.col("high") - share * span).cast("long")) if share < 1 else F.col("low")
        least = F.least("high", F.coalesce("seed", ladder) if share < 1 else ladder)
        found = materialise(search(index, parts, -(-n_anchors // part_rows), asked.withColumn("least", least)).drop("nth"), f"{name}-{i}")
        if share == 1:
            done.append(found)
            break
        full = found.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") >= k).drop("n")
        done.append(found.join(full, key, "left_semi"))
        asked = materialise(asked.join(full.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", *key[1:]], "left_anti"), f"{name}-open-{i}")
        if asked.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def mine_negatives(
    vectors: DataFrame, every: int, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
    key: str = "vec_id", vector: str = "embedding", label: str = "label", part_rows: int = PART, sample_rows: int = SAMPLE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose key is divisible by ``every``; its positives are the
    ``positives`` other rows of its label with the highest whole-number inner products, ties
    to the smaller key. For each, the ``negatives`` best rows of other labels whose score is
    from ``low`` to ``high`` hundredths of the positive's. Rows with a null key, label or vector, or a
    component that is null or not finite, take no part. Equal rows count once; rows
    with one key that differ in vector or label are candidates each, and as anchors have their
    own windows each. Rows with the anchor's key are no partners. The sample sets thresholds
    only; every row is searched. Shorter vectors end in zeros. Scores too
    large for 64 bits raise. Other columns are not read; an empty table gives no rows.
    """
    kind = narrowest(vectors, scale, vector)
    index = materialise(labelled_vectors(vectors, scale, key, vector, label, kind), "labelled")
    told = index.agg(F.max(F.octet_length("vector")), F.max("norm"), F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    width, top, *counts = (told[0] or 0) // np.dtype(kind).itemsize, told[1] or 0.0, told[2], max(1, told[3])
    order = _by_weight(index, width, kind)

    # no score is beyond the product of the lengths
    reach = F.ceil(F.sqrt("norm") * F.lit(top) ** 0.5).cast("long") + 1
    asked = index.filter(F.col("vec_id") % every == 0).select(
        "vec_id", "label", "vector", F.lit(0).cast("long").alias("window"), F.lit(True).alias("same"), (-reach).alias("low"), reach.alias("high")
    )
    sample = materialise(index.orderBy(F.xxhash64("vec_id", "vector", "label"), "vec_id", "vector", "label").limit(sample_rows).drop("norm"), "sample")
    best = fill_windows(index, sample, *counts, part_rows, order, kind, asked, positives, "positives")

    anchor = ["anchor_id", "vector", "label"]
    nth = Window.partitionBy(*anchor).orderBy(F.desc("score"), "vec_id")
    pairs = materialise(
        best.select(*anchor, F.row_number().over(nth).cast("long").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "pairs"
    )
    bounds = pairs.select(
        F.col("anchor_id").alias("vec_id"), "label", "vector", "window", F.lit(False).alias("same"),
        (-_hundredth(-low, "positive_score")).alias("low"), _hundredth(high, "positive_score").alias("high"),
    ).filter("low <= high")
    hard = fill_windows(index, sample, *counts, part_rows, order, kind, bounds, negatives, "negatives")
    ranked = Window.partitionBy(*anchor, "window").orderBy(F.desc("score"), "vec_id")
    hard = hard.select(
        *anchor, "window", F.row_number().over(ranked).alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return hard.join(pairs, [*anchor, "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _hundredth(times: int, column: str) -> Column:
    """floor(times * column / 100) in whole numbers."""
    product = f"({times} * {column})"
    return F.expr(f"({product} - pmod({product}, 100L)) div 100L")


def _by_weight(index: DataFrame, width: int, kind: str) -> np.ndarray:
    """The dimensions in falling order of their sums of squares: one small row from each task, added up."""
    if not width:
        return np.empty(0, np.int64)
    schema = arrow_schema(index.sparkSession, "place long, weight double")

    def run(batches):
        total = np.zeros(width)
        for batch in pieces_of(batches):
            total += (as_rows(batch.column(0).to_pylist(), width, kind).astype(np.float64) ** 2).sum(0)
        yield pa.record_batch([pa.array(np.arange(width)), pa.array(total)], schema=schema)

    sums = index.select("vector").mapInArrow(run, "place long, weight double").groupBy("place").agg(F.sum("weight").alias("weight"))
    return np.array([r["place"] for r in sums.orderBy(F.desc("weight"), "place").collect()], np.int64)
