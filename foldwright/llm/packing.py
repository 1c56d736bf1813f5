"""Packing of documents into sequences of bounded length by large-item matching and best fit.

Where a piece goes depends on its length alone, so the plan is made from the
number of pieces of each length: at most ``capacity`` numbers, whatever the
size of the corpus. Pieces above a third of the capacity fit at most twice into
a sequence and are matched greedily, the longest with the longest that fits;
then each smaller length, from the longest down, goes into the tightest gap
left, and opens sequences only if there is none. The plan names runs: the
pieces of length s with ranks r .. r + n lie k to a sequence from sequence b on.
A piece finds its run by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwright.workspace import materialise

from .batches import arrow_schema, begin_task, map_rows, pieces_of, task_number, text_rows
from .pieces import encoder

PIECES = "doc_id long, piece long, start long, length long, ids_crc32 long, part long, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Runs:
    """The plan: rows of (length, first rank, pieces, first sequence, pieces to a sequence, offset)."""

    def __init__(self, rows: list[tuple[int, ...]], sequences: int):
        self.table = np.array(sorted(rows), np.int64).reshape(-1, 6)
        self.sequences = sequences

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size, first, _, sequence, each, offset = self.table.T
        # (length, first rank) as one ordered pair; lengths are few, so each has a slice of the table
        starts = np.searchsorted(size, length, "left")
        ends = np.searchsorted(size, length, "right")
        at = np.empty(len(length), np.int64)
        for s in np.unique(length):
            own = length == s
            a, b = starts[own][0], ends[own][0]
            at[own] = a + np.searchsorted(first[a:b], rank[own], "right") - 1
        into = rank - first[at]
        return sequence[at] + into // each[at], offset[at] + into % each[at] * length


def plan(counts: dict[int, int], capacity: int) -> Runs:
    """``counts``: pieces of each length from 1 to ``capacity``."""
    left = Counter({s: n for s, n in counts.items() if n})
    if any(not 0 < s <= capacity for s in left):
        raise ValueError("a piece is empty or longer than a sequence")
    # a group: [sequences, gap, what each holds as (length, pieces, offset)]
    by_gap: dict[int, list[tuple[int, tuple]]] = {}
    full: list[tuple[int, tuple]] = []

    def put(n: int, gap: int, holds: tuple) -> None:
        if n:
            (by_gap.setdefault(gap, []) if gap else full).append((n, holds))

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        room = bisect_left(large, capacity - s + 1) - 1  # the longest that fits beside it
        while room >= 0 and large[room] == s and left[s] < 2:
            room -= 1
        if room < 0:
            put(left[s], capacity - s, ((s, 1, 0),))
            large.pop()
            continue
        p = large[room]
        n = left[s] // 2 if p == s else min(left[s], left[p])
        put(n, capacity - s - p, ((s, 2, 0),) if p == s else ((s, 1, 0), (p, 1, s)))
        left[s] -= n
        left[p] -= n
        large = [x for x in large if left[x]]

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        for gap in sorted(g for g in by_gap if g >= s):
            each, groups = gap // s, by_gap[gap]
            while groups and n:
                many, holds = groups.pop()
                whole = min(many, n // each)
                put(whole, gap - each * s, (*holds, (s, each, capacity - gap)))
                n -= whole * each
                many -= whole
                if many and n:  # fewer than `each` are left: the last sequence
                    put(1, gap - n * s, (*holds, (s, n, capacity - gap)))
                    many, n = many - 1, 0
                if many:
                    groups.append((many, holds))
            if not groups:
                del by_gap[gap]
            if not n:
                break
        each = capacity // s
        put(n // each, capacity - each * s, ((s, each, 0),))
        put(n % each > 0, capacity - n % each * s, ((s, n % each, 0),))

    rows, rank, sequence = [], Counter(), 0
    for many, holds in [*full, *(g for gap in sorted(by_gap) for g in by_gap[gap])]:
        for s, each, offset in holds:
            rows.append((s, rank[s], many * each, sequence, each, offset))
            rank[s] += many * each
        sequence += many
    return Runs(rows, sequence)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole sequences, with the rest first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, key: str, text: str) -> DataFrame:
    """The pieces of every document, with the number of each among the equally long ones of its task."""
    schema = arrow_schema(docs.sparkSession, PIECES)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import pyarrow as pa

        begin_task(__name__)
        encode, seen, part = encoder(tokenizer), Counter(), task_number()
        for batch in pieces_of(batches):
            rows = []
            for doc, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(words) + end
                for i, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc, i, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), part, seen[n]))
                    seen[n] += 1
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return text_rows(docs, key, text).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    A document is its ids and ``end_id``; only one longer than ``capacity`` is
    cut, its first piece being the short one. A null or empty text is the end
    id alone. Null keys and repeated rows are packed like any other; pieces of
    one length are interchangeable, so ties need no rule. Other columns are not
    read. An empty table gives no rows.

    One pass cuts the texts and writes the pieces (a few numbers each) to the
    shared folder; a task numbers its pieces per length as it goes, so the
    rank of a piece is that number plus the pieces of that length in earlier
    tasks. Only the counts per length reach the driver, at most ``capacity``.
    """
    pieces = materialise(token_pieces(docs, tokenizer, capacity, end_id, key, text), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(lengths, capacity)
    ranked = pieces.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )

    def place(batch):
        length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
        return [*(batch.column(i) if i != 1 else batch.column(i).cast("int32") for i in range(5)), *runs.place(length, rank)]

    return map_rows(ranked, place, PLACED, 65_536)
