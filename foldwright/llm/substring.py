"""Removal of word passages that an earlier document holds, found by level-wise doubling.

The windows of one length that occur in two documents are the only candidates
at twice that length: a longer passage repeats only where its two halves do.
The lengths double until the wanted one is reached or nothing is left.

The corpus is first written as blocks: some megabytes of rows each, as
compressed Arrow. At each length a block sends every distinct window it still
holds once, as a few bytes, to the bucket of its fingerprint; so the copies of a hot
passage are one entry per block. A bucket sees which entries came from more than
one block and answers each block with one bit per entry. Shorter lengths use
truncated fingerprints, whose collisions only leave a candidate too many; the
wanted length compares 128 bits and the smallest key that holds the window.
Texts are read anew at each length and never shuffled window by window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.workspace import materialise

from .batches import arrow_schema, begin_task, pieces_of, task_number

#: Text of a block, in bytes; entries that a bucket should hold; length of the first windows, in words.
BLOCK_BYTES, BUCKET_ENTRIES, FIRST_WORDS = 2 << 20, 1 << 20, 7
#: Bytes of a fingerprint below its bucket at the shorter lengths.
SHORT_BYTES = 5

BLOCKS = "block long, n_words long, rows binary"
MESSAGES = "bucket long, block long, entries binary"
REPLIES = "block long, level long, bucket long, bits binary"

_LAST = np.iinfo(np.int64).max  # stands for a null key
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than the six ASCII white-space ones."""
    return text.encode().split()


def _join(left: np.ndarray, right: np.ndarray, lane: int) -> np.ndarray:
    mixed = left * _MIX[lane]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX[2]
    mixed += right
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX[3]
    return mixed


def lengths_to(words: int, first: int = FIRST_WORDS) -> list[int]:
    """``first``, twice that, and so on up to ``words``."""
    lengths = [min(first, words)]
    while lengths[-1] < words:
        lengths.append(min(2 * lengths[-1], words))
    return lengths


class Block:
    """The rows of a block and the windows that are still candidates."""

    def __init__(self, data: bytes, key: str, text: str):
        self.batch = pa.ipc.open_stream(data).read_next_batch()
        keys = self.batch.column(key).cast(pa.int64()).fill_null(_LAST).to_numpy()
        self.words = [words_of(t or "") for t in self.batch.column(text).to_pylist()]
        counts = np.array([len(w) for w in self.words], np.int64)
        total = int(counts.sum())
        self.ends = np.cumsum(counts)
        self.key = np.repeat(keys, counts)  # of the document of each word
        self.room = np.repeat(self.ends, counts) - np.arange(total)  # words from here to its end
        hashed = np.fromiter((h for w in self.words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, total)
        self.hashes = [hashed, hashed * _MIX[1] ^ hashed >> np.uint64(31)]

    def windows(self, n: int, lane: int = 0) -> np.ndarray:
        """The fingerprint of the ``n`` words from each place on, built by doubling."""
        if n == 1:
            return self.hashes[lane]
        half = (n + 1) // 2
        shorter = self.windows(half, lane)
        return _join(shorter[: len(shorter) - (n - half)], shorter[n - half :], lane)

    def walk(self, lengths: list[int], bits: int, replies: dict[int, dict[int, bytes]]):
        """Apply the answers so far; the candidates of the next length, grouped, or the places that go."""
        at = np.flatnonzero(self.room >= lengths[0])
        for level, n in enumerate(lengths):
            if level:
                step = n - lengths[level - 1]
                alive = np.zeros(len(self.room) + 1, bool)
                alive[at] = True
                at = at[self.room[at] >= n]
                at = at[alive[at + step]]
            last = level == len(lengths) - 1
            groups = self._groups(at, n, bits, last)
            if level not in replies:
                return level, groups
            order, starts, bucket, _ = groups
            told = replies[level]
            flags = [np.unpackbits(np.frombuffer(told[b], np.uint8), count=c).astype(bool) for b, c in zip(*np.unique(bucket, return_counts=True))]
            elsewhere = np.concatenate(flags) if flags else np.empty(0, bool)
            places, sizes = at[order], np.diff(starts, append=len(order))
            keys = self.key[places]
            if last:  # an earlier document in another block, or in this one
                least = np.minimum.reduceat(keys, starts) if len(starts) else keys
                return level + 1, places[np.repeat(elsewhere, sizes) | (keys > np.repeat(least, sizes))]
            several = np.flatnonzero((sizes > 1) & ~elsewhere)  # in this block alone: in two documents?
            inside = np.repeat(several, sizes[several])
            own = np.repeat(starts[several], sizes[several]) + np.arange(len(inside)) - np.repeat(np.cumsum(sizes[several]) - sizes[several], sizes[several])
            differs = keys[own] != keys[starts[inside]]
            elsewhere[inside[differs]] = True
            at = np.sort(places[np.repeat(elsewhere, sizes)])
        raise AssertionError("no length")

    def _groups(self, at: np.ndarray, n: int, bits: int, last: bool):
        """Places in the order of their fingerprints, where each group begins, and its bucket and entry."""
        if not len(at):
            return at, np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 24 if last else SHORT_BYTES), np.uint8)
        first = self.windows(n)[at]
        if last:
            second = self.windows(n, 1)[at]
            order = np.lexsort((second, first))
            first, second = first[order], second[order]
            new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        else:
            first >>= np.uint64(64 - bits - 8 * SHORT_BYTES)
            order = np.argsort(first)
            first = first[order]
            new = np.append(True, first[1:] != first[:-1])
        starts = np.flatnonzero(new)
        own = first[starts]
        if last:
            least = np.minimum.reduceat(self.key[at[order]], starts)
            entries = np.stack([own, second[starts], least.view(np.uint64)], 1).astype("<u8").view(np.uint8)
            bucket = (own >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(own), np.int64)
        else:
            entries = own.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT_BYTES]
            bucket = (own >> np.uint64(8 * SHORT_BYTES)).astype(np.int64)
        return order, starts, bucket, entries


def _seen_elsewhere(entries: list[bytes], last: bool) -> list[np.ndarray]:
    """For each block's entries in a bucket: does another block have it (with a smaller key, if ``last``)?"""
    width = 24 if last else SHORT_BYTES
    sizes = [len(e) // width for e in entries]
    raw = np.frombuffer(b"".join(entries), np.uint8).reshape(-1, width)
    if last:
        first, second, key = raw.view("<u8").T
        order = np.lexsort((key.view(np.int64), second, first))
        a, b = first[order], second[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        keys = key.view(np.int64)[order]
        flags = keys > keys[new][np.cumsum(new) - 1]
    else:
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :width] = raw
        whole = wide.view("<u8").ravel()
        order = np.argsort(whole)
        same = np.diff(whole[order]) == 0
        flags = np.append(False, same) | np.append(same, False)
    out = np.empty(len(raw), bool)
    out[order] = flags
    return np.split(out, np.cumsum(sizes)[:-1])


def _to_blocks(docs: DataFrame, text: str) -> DataFrame:
    schema = arrow_schema(docs.sparkSession, BLOCKS)

    def run(batches):
        begin_task(__name__)
        task, number, held, size = task_number(), 0, [], 0

        def close():
            table = pa.Table.from_batches(held).combine_chunks()
            words = sum(len(words_of(t or "")) for t in table.column(text).to_pylist())
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(table)
            columns = [[task << 32 | number], [words], [sink.getvalue().to_pybytes()]]
            return pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

        for batch in pieces_of(batches, 128):
            held.append(batch)
            size += batch.column(text).nbytes
            if size >= BLOCK_BYTES:
                yield close()
                held, size, number = [], 0, number + 1
        if held:
            yield close()

    return docs.mapInArrow(run, BLOCKS)


def dedup_substrings(
    docs: DataFrame, words: int = 13, first_words: int = FIRST_WORDS, key: str = "doc_id", text: str = "text", rejoin: bool = True,
    counts: tuple[str, str] = ("n_words", "n_removed"),
) -> DataFrame:
    """``docs`` with the words left in ``text``, joined by one space, and ``n_words`` and ``n_removed``.

    With ``rejoin`` off, a text that loses no word stays as it is.

    A word goes if a window of ``words`` consecutive words of its document that
    covers it also starts in a document with a smaller ``key``. All windows are
    judged on the input. Documents with fewer words keep all; a null text has no
    words and becomes empty. Rows with equal keys are no earlier documents to
    each other; a null key counts as the largest. Repeated rows come out as
    often as they came in. Other columns pass through; ones named as the two
    ``counts`` are replaced. An empty table gives an empty one.
    """
    if words < 1 or first_words < 1:
        raise ValueError("windows need at least one word")
    spark = docs.sparkSession
    docs = docs.drop(*counts)
    lengths = lengths_to(words, first_words)
    blocks = materialise(_to_blocks(docs, text), "blocks")
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    bits = min(max(total // BUCKET_ENTRIES, 0).bit_length(), 64 - 8 * SHORT_BYTES)
    message_schema, reply_schema = arrow_schema(spark, MESSAGES), arrow_schema(spark, REPLIES)

    def read(row) -> tuple[Block, dict]:
        told: dict[int, dict[int, bytes]] = {}
        for reply in row["replies"] or []:
            told.setdefault(reply["level"], {})[reply["bucket"]] = reply["bits"]
        return Block(row["rows"], key, text), told

    def answered(level: int, replies: list[DataFrame]) -> DataFrame:
        """The blocks with all answers so far; a length that nothing reached is answered too."""
        if not replies:
            return blocks.select("block", "rows", F.lit(None).cast("array<struct<level:long,bucket:long,bits:binary>>").alias("replies"))
        union = replies[0]
        for more in replies[1:]:
            union = union.unionByName(more)
        lists = union.groupBy("block").agg(F.collect_list(F.struct("level", "bucket", "bits")).alias("replies"))
        return blocks.select("block", "rows").join(lists, "block", "left")

    def send(level: int):
        def run(batches):
            begin_task(__name__)
            for batch in pieces_of(batches, 1):
                row = batch.to_pylist()[0]
                block, told = read(row)
                for earlier in range(level):
                    told.setdefault(earlier, {})
                _, (_, _, bucket, entries) = block.walk(lengths, bits, told)
                if len(bucket):
                    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                    ends = np.append(first[1:], len(bucket))
                    columns = [bucket[first], [row["block"]] * len(first), [entries[a:b].tobytes() for a, b in zip(first, ends)]]
                    yield pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, message_schema)], schema=message_schema)

        return run

    def answer(level: int):
        last = level == len(lengths) - 1

        def run(group: pa.Table) -> pa.Table:
            flags = _seen_elsewhere(group.column("entries").to_pylist(), last)
            columns = [group.column("block"), [level] * len(flags), group.column("bucket"), [np.packbits(f).tobytes() for f in flags]]
            return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, t.type) for c, t in zip(columns, reply_schema)], schema=reply_schema)

        return run

    replies: list[DataFrame] = []
    for level in range(len(lengths)):
        messages = answered(level, replies).mapInArrow(send(level), MESSAGES)
        replies.append(materialise(messages.groupBy("bucket").applyInArrow(answer(level), REPLIES), "replies"))

    result = T.StructType([f for f in docs.schema.fields if f.name != text] + T.StructType.fromDDL(f"`{text}` string, `{counts[0]}` long, `{counts[1]}` long").fields)
    names = [f.name for f in docs.schema.fields if f.name != text]

    def cut(batches):
        begin_task(__name__)
        for batch in pieces_of(batches, 1):
            block, told = read(batch.to_pylist()[0])
            for level in range(len(lengths)):
                told.setdefault(level, {})
            _, gone = block.walk(lengths, bits, told)
            change = np.zeros(len(block.room) + 1, np.int32)
            change += np.bincount(gone, minlength=len(change)).astype(np.int32)
            change -= np.bincount(gone + words, minlength=len(change)).astype(np.int32)
            covered = np.cumsum(change) > 0
            texts, removed, start = [], [], 0
            for whole, own, end in zip(block.batch.column(text).to_pylist(), block.words, block.ends.tolist()):
                out = covered[start:end]
                n = int(out.sum())
                if n or rejoin:
                    texts.append(b" ".join([w for w, o in zip(own, out.tolist()) if not o] if n else own).decode())
                else:
                    texts.append(whole)
                removed.append(n)
                start = end
            columns = [block.batch.column(c) for c in names]
            columns += [pa.array(texts, pa.string()), pa.array([len(w) for w in block.words], pa.int64()), pa.array(removed, pa.int64())]
            made = pa.record_batch(columns, names=[*names, text, *counts])
            yield from pieces_of([made], 4096)

    return answered(len(lengths), replies).mapInArrow(cut, result)
