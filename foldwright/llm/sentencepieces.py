"""SentencePiece encoding that keeps the place of every piece in the source, and decoding.

A text is normalised by the longest prefixes that the model's compiled character
map knows, and every byte of the result remembers the source byte it came from.
The pieces of a normalised text follow one another, so each one's bytes in the
source are the stretch between the sources of its two ends.

No piece of a BPE model here holds a space mark after another character, so a
text is cut before each run of marks and every cut is encoded by itself; a cut
met again costs one look-up.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import arrow_schema, begin_task, pieces_of, text_rows
from .pieces import Memory

# Fixed values of the model file: the mark of a space, types of pieces, and the type of a BPE model.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
BPE = 2
REPLACEMENT = "�"

#: Symbols up to which the best pair is looked for in all of them; beyond, by a heap.
SCANNED = 40

ENCODED = "doc_id long, ids array<int>, begins array<int>, ends array<int>"
_MARKED = re.compile(f"(?<=[^{MARK}])(?={MARK})")
_SPACED = re.compile(" *[^ ]+| +")


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _number(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _number(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _number(data, at)
            value = data[at : at + size]
            at += size
        yield tag >> 3, value


class CharacterMap:
    """Longest-prefix rules: a double-array trie over bytes, whose leaves point into zero-ended replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes | None]:
        """(bytes taken, their replacement), or (0, None) if no rule fits."""
        units = self.units
        if not units:
            return 0, None
        taken, leaf, end = 0, 0, len(data)
        node = _offset(units[0])
        i = at
        while i < end:
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= _offset(unit)
            i += 1
            if unit >> 8 & 1:
                taken, leaf = i - at, units[node] & 0x7FFFFFFF
        return taken, self.texts[leaf : self.texts.index(0, leaf)] if taken else None


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 1 << 9) >> 6)


class SentencePieces:
    """Encodes and decodes as a BPE model file of the library says, without begin or end ids."""

    def __init__(self, model: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for number, value in fields(model):
            if number == 1:
                own = dict(fields(value))
                pieces.append((own.get(1, b"").decode(), struct.unpack("<f", own.get(2, bytes(4)))[0], own.get(3, NORMAL)))
            elif number == 2:
                trainer |= dict(fields(value))
            elif number == 3:
                normalizer |= dict(fields(value))
        if trainer.get(3, 1) != BPE or trainer.get(24, 0):
            raise ValueError("not a BPE model with space marks before words")
        if not {kind for *_, kind in pieces} <= {NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE}:
            raise ValueError("pieces of a type that is not known")
        self.rules = CharacterMap(normalizer.get(2, b""))
        self.prefix, self.trim, self.mark = (bool(normalizer.get(i, 1)) for i in (3, 4, 5))
        self.fallback = bool(trainer.get(35, 0))
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()

        self.ids = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)}
        best = sorted({-score for _, score, _ in pieces})
        place = {score: i for i, score in enumerate(best)}
        self.rank = {piece: place[-score] for piece, score, kind in pieces if kind in (NORMAL, USER_DEFINED)}
        whole = sorted((p for p, _, kind in pieces if kind == USER_DEFINED and p), key=len, reverse=True)
        self.whole = re.compile("|".join(map(re.escape, whole))) if whole else None
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.unknown = next(i for i, (*_, kind) in enumerate(pieces) if kind == UNKNOWN)
        self.kinds = [kind for *_, kind in pieces]
        self.names = [piece for piece, *_ in pieces]
        self.shown = [self._shown(piece, kind) for piece, _, kind in pieces]
        # bytes on both sides of a control piece are not one character, so there the joined text must not decode
        self.joined = [b"\xff" if kind == CONTROL else shown for kind, shown in zip(self.kinds, self.shown)]

        # two neighbours that no piece has side by side are never joined, so a text is cut between them
        self.neighbours = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.cuts = not whole and self.fallback and MARK in self.ids and not any(pair[1] == MARK != pair[0] for pair in self.neighbours)
        # without rules a space is its mark and all else stays as it is
        self.plain = self.cuts and not self.rules.units and self.prefix and self.mark and not self.trim
        self.lines = not any("\n" in pair for pair in self.neighbours)
        pair = struct.Struct("<ii").pack
        self.packed = {p: pair(i, len(p.encode()) - 2 * p.count(MARK)) for p, i in self.ids.items()}
        self.opening = Memory(lambda cut: self._without_mark(self._cut(MARK + cut.replace(" ", MARK))))
        self.inner = Memory(lambda cut: self._cut(cut.replace(" ", MARK)))
        self.after_space = Memory(lambda word: self._cut(MARK + word))

    @classmethod
    def open(cls, path: str) -> SentencePieces:
        with open(path, "rb") as file:
            return cls(file.read())

    # normalisation

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """The normalised text, and for each of its UTF-8 bytes and its end the source byte it comes from."""
        source = text.encode()
        at, out, places = 0, bytearray(), []
        if self.trim:
            while at < len(source):
                taken, made = self._step(source, at)
                if made != b" ":
                    break
                at += taken
        if at == len(source):
            return "", [0]
        mark = MARK.encode() if self.mark else b" "

        def add(made: bytes) -> None:
            made = made.replace(b" ", mark)
            out.extend(made)
            places.extend([at] * len(made))

        if self.prefix:
            add(b" ")
        spaced = self.trim
        while at < len(source):
            taken, made = self._step(source, at)
            if spaced:
                made = made.lstrip(b" ")
            if made:
                add(made)
                spaced = made.endswith(b" ")
            at += taken
            spaced &= self.trim
        if self.trim:
            while out.endswith(mark):
                at = places[len(out) - len(mark)]
                del out[-len(mark) :], places[-len(mark) :]
        return out.decode(), [*places, at]

    def _step(self, source: bytes, at: int) -> tuple[int, bytes]:
        """(bytes taken, what they become) of the longest prefix with a rule, or of one character."""
        if self.whole and (found := self.whole.match(source[at : at + 256].decode(errors="ignore"))):
            own = found.group().encode()
            return len(own), own
        taken, made = self.rules.longest(source, at)
        if made is None:
            first = source[at]
            taken = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            made = source[at : at + taken]
        return taken, made

    # merging

    def _symbols(self, text: str) -> tuple[list[str], list[bool]]:
        if not self.whole:
            return list(text), []
        symbols, fixed, at = [], [], 0
        for found in self.whole.finditer(text):
            symbols += [*text[at : found.start()], found.group()]
            fixed += [False] * (found.start() - at) + [True]
            at = found.end()
        symbols += text[at:]
        return symbols, fixed + [False] * (len(symbols) - len(fixed))

    def merge(self, text: str) -> list[str]:
        """The pieces of a normalised text: the best pair of neighbours is joined, the leftmost first, until none is a piece."""
        if len(text) > SCANNED or self.whole:
            return self._merge_long(*self._symbols(text))
        rank, none = self.rank.get, len(self.rank)
        ends = list(range(len(text) + 1))  # of the symbols, with 0 in front
        pairs = [rank(text[i : i + 2], none) for i in range(len(text) - 1)]
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            del pairs[i], ends[i + 1]
            if i:
                pairs[i - 1] = rank(text[ends[i - 1] : ends[i + 1]], none)
            if i < len(pairs):
                pairs[i] = rank(text[ends[i] : ends[i + 2]], none)
        return [text[a:b] for a, b in zip(ends, ends[1:])]

    def _merge_long(self, symbols: list[str], fixed: list[bool]) -> list[str]:
        n, rank = len(symbols), self.rank.get
        fixed = fixed or [False] * n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def look(i: int, j: int) -> None:
            if not fixed[i] and not fixed[j] and (r := rank(symbols[i] + symbols[j])) is not None:
                heap.append((r, i, len(symbols[i]) + len(symbols[j])))

        for i in range(n - 1):
            look(i, i + 1)
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            j = after[i]
            if j >= n or not symbols[i] or len(symbols[i]) + len(symbols[j]) != size:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            j = after[i] = after[j]
            found = len(heap)
            if j < n:
                before[j] = i
                look(i, j)
            if before[i] >= 0:
                look(before[i], i)
            new = heap[found:]
            del heap[found:]
            for entry in new:
                heappush(heap, entry)
        return [s for s in symbols if s]

    def _named(self, text: str) -> list[tuple[int, int]]:
        """(id, bytes of the normalised text) of its pieces. Bytes that stand for a character: the last one has them all."""
        out, unknown_before = [], False
        for piece in self.merge(text):
            own, size = self.ids.get(piece), len(piece.encode())
            if own is not None:
                out.append((own, size))
            elif self.fallback:
                codes = [self.byte_ids[b] for b in piece.encode()]
                out += [*((c, 0) for c in codes[:-1]), (codes[-1], size)]
            elif unknown_before:  # a run of unknown characters is one piece
                out[-1] = self.unknown, out[-1][1] + size
            else:
                out.append((self.unknown, size))
            unknown_before = own is None and not self.fallback
        return out

    def _cut(self, cut: str) -> bytes:
        """(id, bytes of the source) of the pieces of a cut without rules, as pairs of 32-bit numbers; a mark is a space."""
        neighbours = self.neighbours
        ends = [i for i in range(1, len(cut)) if cut[i - 1 : i + 1] not in neighbours]
        if ends:
            parts = [cut[a:b] for a, b in zip([0, *ends], [*ends, len(cut)])]
            first = parts[0]
            out = [self.after_space[first[1:]] if len(first) > 1 and first[0] == MARK and first[1] != MARK else self._merged(first)]
            return b"".join(out + [self.inner[part] if part[0] != MARK else self._merged(part) for part in parts[1:]])
        return self._merged(cut)

    def _merged(self, cut: str) -> bytes:
        try:
            return b"".join([self.packed[piece] for piece in self.merge(cut)])
        except KeyError:  # a character without a piece
            flat = array("i")
            for own, size in self._named(cut):
                flat.extend((own, size - 2 * self.names[own].count(MARK)))
            return flat.tobytes()

    @staticmethod
    def _without_mark(pairs: bytes) -> bytes:
        """The pairs of a cut whose first mark stands for nothing in the source."""
        found = np.frombuffer(pairs, "<i4").reshape(-1, 2).copy()
        found[np.flatnonzero(found[:, 1])[0], 1] -= 1
        return found.tobytes()

    def pairs(self, text: str) -> tuple[int, bytes]:
        """Where the first piece begins in the source, and (id, bytes of the source) of each piece."""
        if not text:
            return 0, b""
        if not self.plain or MARK in text:
            return self._pairs_by_rules(text)
        out, opening = [], True
        for line in text.split("\n") if self.lines else [text]:
            if not opening:
                out.append(self.inner["\n"])
            if "  " in line or line[:1] == " " or line[-1:] == " ":
                first, *rest = _SPACED.findall(line)
                out.append(self.opening[first] if opening else self.inner[first])
                out += map(self.inner.__getitem__, rest)
            else:
                first, *rest = line.split(" ")
                if opening or first:
                    out.append(self.opening[first] if opening else self.inner[first])
                out += map(self.after_space.__getitem__, rest)
            opening = False
        return 0, b"".join(out)

    def _pairs_by_rules(self, text: str) -> tuple[int, bytes]:
        normalised, places = self.normalise(text)
        flat, at = array("i"), 0
        for cut in _MARKED.split(normalised) if self.cuts else [normalised]:
            for own, size in self._named(cut):
                flat.extend((own, places[at + size] - places[at]))
                at += size
        return places[0], flat.tobytes()

    def encode(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """Ids, and where each piece begins and ends among the bytes of ``text``."""
        start, data = self.pairs(text)
        ids, sizes = np.frombuffer(data, "<i4").reshape(-1, 2).T
        ends = start + np.cumsum(sizes)
        return ids.tolist(), (ends - sizes).tolist(), ends.tolist()

    # decoding

    def _shown(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return self.unknown_text.encode() if kind == UNKNOWN else piece.replace(MARK, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks are spaces, bytes that are no text become U+FFFD one by one."""
        shown, skipped = self.shown, 0
        strip = self.prefix or self.trim
        lead = b""
        while strip and skipped < len(ids):
            kind = self.kinds[ids[skipped]]
            if kind == BYTE or kind == UNKNOWN:
                break
            lead = shown[ids[skipped]]
            spaced = kind != CONTROL and lead[:1] == b" "
            lead = lead[1:] if spaced else lead
            skipped += 1
            if lead or spaced and not self.trim:
                break
        joined = self.joined
        data = lead + b"".join([joined[i] for i in ids[skipped:]])
        try:
            return data.decode()
        except UnicodeDecodeError:
            return lead.decode() + self._decode_runs(ids[skipped:])

    def _decode_runs(self, ids: list[int]) -> str:
        out, run = [], bytearray()

        def close() -> None:
            while run:
                try:
                    out.append(run.decode())
                    run.clear()
                except UnicodeDecodeError as bad:
                    out.append(run[: bad.start].decode() + REPLACEMENT)
                    del run[: bad.start + 1]

        for i in ids:
            if self.kinds[i] == BYTE:
                run += self.shown[i]
            else:
                close()
                out.append(self.shown[i].decode())
        close()
        return "".join(out)


@lru_cache(4)
def sentence_pieces(path: str) -> SentencePieces:
    """One for a worker process, kept from task to task."""
    return SentencePieces.open(path)


def encode_pieces(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, begins, ends) of every row: its pieces and their places among the UTF-8 bytes of the text.

    A piece that stands for a space put in front begins and ends where the text
    begins; of the bytes of a character without a piece, the last has its place.
    A null or empty text has no pieces. Null keys, ties and repeated rows stay as
    they are; other columns are not read; an empty table gives no rows. ``model``
    is a path that every executor can open. No shuffle; a task holds one small batch.
    """
    schema = arrow_schema(docs.sparkSession, ENCODED)

    def run(batches):
        begin_task(__name__)
        own = sentence_pieces(model)
        for batch in pieces_of(batches, 256):
            found = [own.pairs(t) for t in batch.column(1).to_pylist()]
            counts = np.array([0, *(len(data) // 8 for _, data in found)], np.int64)
            places = np.cumsum(counts)
            ids, sizes = np.frombuffer(b"".join(data for _, data in found), "<i4").reshape(-1, 2).T
            total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            starts = np.array([start for start, _ in found], np.int64) - total[places[:-1]]
            ends = (total[1:] + np.repeat(starts, counts[1:])).astype(np.int32)
            offsets = pa.array(places.astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(v))) for v in (ids, ends - sizes, ends)]
            yield pa.record_batch([batch.column(0), *(c.cast(f.type) for c, f in zip(lists, [schema.field(i) for i in (1, 2, 3)]))], schema=schema)

    return text_rows(docs, key, text).mapInArrow(run, ENCODED)


def decode_pieces(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, ids, text) of every row: the text that the library's decode gives for the ids; null ids give an empty text."""
    ddl = "doc_id long, ids array<int>, text string"
    schema = arrow_schema(encoded.sparkSession, ddl)

    def run(batches):
        begin_task(__name__)
        own = sentence_pieces(model)
        for batch in pieces_of(batches, 256):
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            values = lists.values[offsets[0] : offsets[-1]].to_numpy().tolist()
            offsets = (offsets - offsets[0]).tolist()
            texts = [own.decode(values[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.record_batch([batch.column(0), lists.cast(schema.field(1).type), pa.array(texts, pa.string())], schema=schema)

    rows = encoded.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, ddl)
