"""Re-Pair grammar compression of one shard of ids, in whole-array steps.

Each round counts the adjacent pairs of the shard, gives the frequent ones a
nonterminal each, the most frequent first where they overlap, and replaces them
everywhere, until no pair is frequent. Pairs with ``stop`` are left alone, so no
symbol spans two documents. A rule is the pair it stands for, kept
with the number of ids it expands to: a prefix sum over these lengths finds the
symbols of any stretch of ids without decoding what lies before.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"RPAIR001"
_HEAD = struct.Struct("<8sqqqqq")  # magic, documents, ids, first nonterminal, rules, symbols

#: Pair counters of the first look at a shard (a power of two); uses that make a pair frequent. A rule takes 16 bytes and
#: a use saves two, so it repays from 8 uses; at 8, more rules than two bytes can name made the given shards larger.
COUNTER_BITS, LEAST_USES = 18, 16


def _often(sequence: np.ndarray, stop: int) -> np.ndarray:
    """Places whose pair may be frequent: pairs that share a counter are counted together, so no frequent one is left out."""
    spots = sequence[:-1] * np.uint32(0x9E3779B1)
    spots ^= sequence[1:] * np.uint32(0x85EBCA77)
    spots *= np.uint32(0xC2B2AE3D)
    spots >>= np.uint32(32 - COUNTER_BITS)
    often = (np.bincount(spots, minlength=1 << COUNTER_BITS) >= LEAST_USES)[spots]
    ends = np.flatnonzero(sequence == stop)
    often[ends[ends < len(often)]] = False
    often[ends[ends > 0] - 1] = False
    return np.flatnonzero(often)


def _distinct(left: np.ndarray, right: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, count) of the distinct pairs, and for every place the number of its pair."""
    bits, place = (symbols - 1).bit_length(), (len(left) - 1).bit_length()
    key = left.astype(np.uint64) << np.uint64(bits) | right
    if 2 * bits + place <= 64:
        # sorted together with the places, which is faster than to sort the places by it
        key <<= np.uint64(place)
        key |= np.arange(len(left), dtype=np.uint64)
        key.sort()
        order = (key & np.uint64((1 << place) - 1)).view(np.int64)
        key >>= np.uint64(place)
    else:
        order = np.argsort(key)
        key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(new)
    counts = np.diff(np.append(start, len(key)))
    number = np.empty(len(key), np.int32)
    number[order] = np.repeat(np.arange(len(start), dtype=np.int32), counts)
    key = key[start]
    return (key >> np.uint64(bits)).astype(np.uint32), (key & np.uint64((1 << bits) - 1)).astype(np.uint32), counts, number


def _overlapping(at: np.ndarray, after: np.ndarray, twins: np.ndarray) -> np.ndarray:
    """Which of the places overlap a use of their own pair: every second one of a run of one symbol, from the left."""
    twin = np.flatnonzero(twins)
    if not len(twin):
        return twin
    start = np.ones(len(twin), bool)
    start[1:] = at[twin[1:]] != after[twin[:-1]]
    start = np.flatnonzero(start)
    odd = (np.arange(len(twin)) - np.repeat(start, np.diff(np.append(start, len(twin))))) % 2 == 1
    return twin[odd]


def _chosen(at: np.ndarray, after: np.ndarray, rule: np.ndarray, twins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, their rules, which rules have uses enough): no two places overlap, the lower rule goes first.

    No place of a rule with uses enough is left out but for an overlap.
    """
    n = len(twins)
    places, rules, worth = [], [], None
    while len(at):
        rank = rule.copy()
        rank[_overlapping(at, after, twins[rule])] = n
        touch = at[1:] == after[:-1]
        wins = rank < n
        wins[1:] &= ~touch | (rank[1:] < rank[:-1])
        wins[:-1] &= ~touch | (rank[:-1] < rank[1:])
        if worth is None:
            worth = np.bincount(rule[wins], minlength=n) >= LEAST_USES
            wins &= worth[rule]
        won = np.flatnonzero(wins)
        places.append(at[won])
        rules.append(rule[won])
        free = worth[rule] & ~wins
        free[1:] &= ~(touch & wins[:-1])
        free[:-1] &= ~(touch & wins[1:])
        free = np.flatnonzero(free)
        at, after, rule = at[free], after[free], rule[free]
    return np.concatenate(places), np.concatenate(rules), worth


def compress(ids: np.ndarray, stop: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(first nonterminal, rules as pairs, symbols).

    Ends when no pair of symbols has ``LEAST_USES`` uses that do not overlap. A
    round replaces all uses of the pairs that it takes, so a pair without uses
    enough never gets more, and the next round looks only at places next to a
    new symbol and at frequent pairs that lost to better ones.
    """
    first = nonterminal = max(int(ids.max(initial=0)), stop) + 1
    end = len(ids)
    sequence = np.append(ids, stop).astype(np.uint32)
    place_type = np.int32 if end < 2**31 - 2 else np.int64
    following, before = np.arange(1, end + 2, dtype=place_type), np.arange(-1, end, dtype=place_type)
    following[end] = before[0] = end
    gone, look = np.zeros(end + 1, bool), np.zeros(end + 1, bool)
    rules: list[np.ndarray] = []
    at = _often(sequence, stop)
    while len(at):
        after = following[at]
        left, right, counts, rule = _distinct(sequence[at], sequence[after], nonterminal)
        twins = left == right
        counts -= np.bincount(rule[_overlapping(at, after, twins[rule])], minlength=len(left))
        frequent = np.flatnonzero(counts >= LEAST_USES)
        if not len(frequent):
            break
        frequent = frequent[np.argsort(-counts[frequent], kind="stable")]
        rank = np.full(len(left), -1, np.int32)
        rank[frequent] = np.arange(len(frequent), dtype=np.int32)
        rule = rank[rule]
        kept = np.flatnonzero(rule >= 0)
        at = at[kept]
        place, used, worth = _chosen(at, after[kept], rule[kept], twins[frequent])
        number = np.cumsum(worth) - 1 + nonterminal
        taken = frequent[worth]
        rules.append(np.stack([left[taken], right[taken]], 1))
        nonterminal += len(taken)
        second = following[place]
        third = following[second]
        sequence[place] = number[used]
        following[place], before[third], gone[second] = third, place, True
        before[end] = end
        previous = before[place]
        look[at] = True
        look[second] = False
        look[place] = sequence[third] != stop
        look[previous[sequence[previous] != stop]] = True
        at = np.flatnonzero(look)
        look[at] = False
    return first, (np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)), sequence[:end][~gone[:end]]


def lengths_of(first: int, rules: np.ndarray) -> np.ndarray:
    """Ids that each rule expands to; a rule only uses earlier ones."""
    lengths = np.ones(len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[i] = (lengths[a - first] if a >= first else 1) + (lengths[b - first] if b >= first else 1)
    return lengths


def pack_shard(doc_lengths: np.ndarray, ids: np.ndarray, stop: int) -> bytes:
    """A shard of the file format: head, ids per document, rules, expansion lengths, symbols."""
    first, rules, symbols = compress(ids, stop)
    width = "<u2" if first + len(rules) <= 1 << 16 else "<u4"
    head = _HEAD.pack(MAGIC, len(doc_lengths), len(ids), first, len(rules), len(symbols))
    parts = doc_lengths.astype("<u8"), rules.astype("<u4"), lengths_of(first, rules).astype("<u8"), symbols.astype(width)
    return head + b"".join(p.tobytes() for p in parts)


class Shard:
    """A shard read back; ``ids(a, b)`` decodes ids a to b alone."""

    def __init__(self, data: bytes):
        magic, docs, self.n_ids, self.first, n_rules, n_symbols = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard of ids")
        at = _HEAD.size
        self.doc_lengths = np.frombuffer(data, "<u8", docs, at).astype(np.int64)
        at += 8 * docs
        self.rules = np.frombuffer(data, "<u4", 2 * n_rules, at).reshape(-1, 2)
        at += 8 * n_rules
        self.rule_lengths = np.frombuffer(data, "<u8", n_rules, at).astype(np.int64)
        at += 8 * n_rules
        self.symbols = np.frombuffer(data, "<u2" if self.first + n_rules <= 1 << 16 else "<u4", n_symbols, at).astype(np.uint32)
        lengths = np.ones(n_symbols, np.int32)
        composed = self.symbols >= self.first
        lengths[composed] = self.rule_lengths[self.symbols[composed] - self.first]
        self.ends = np.cumsum(lengths, dtype=np.int64)
        self._expanded: tuple[np.ndarray, np.ndarray] | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """All rules written out one after the other, and where each begins."""
        if self._expanded is None:
            begins = np.concatenate([[0], np.cumsum(self.rule_lengths)]).astype(np.int64)
            flat = np.empty(begins[-1], np.uint32)
            for i, pair in enumerate(self.rules.tolist()):
                at = begins[i]
                for s in pair:
                    if s >= self.first:
                        j = s - self.first
                        n = self.rule_lengths[j]
                        flat[at : at + n] = flat[begins[j] : begins[j] + n]
                    else:
                        n, flat[at] = 1, s
                    at += n
            self._expanded = flat, begins
        return self._expanded

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.empty(0, np.uint32)
        flat, begins = self._expansions()
        a, b = np.searchsorted(self.ends, [start, stop - 1], "right")
        symbols, ends = self.symbols[a : b + 1], self.ends[a : b + 1]
        skipped = int(self.ends[a - 1]) if a else 0
        begin = np.concatenate([[skipped], ends[:-1]])
        composed = np.flatnonzero(symbols >= self.first)
        # a symbol is copied from the rules written out, a lone id from the symbols after them
        source = np.arange(len(flat), len(flat) + len(symbols))
        source[composed] = begins[symbols[composed] - self.first]
        at = np.repeat(source - begin + skipped, ends - begin)
        at += np.arange(len(at))
        out = np.concatenate([flat, symbols])[at]
        return out[start - skipped : stop - skipped]

    def document(self, i: int) -> np.ndarray:
        start = int(self.doc_lengths[:i].sum())
        return self.ids(start, start + int(self.doc_lengths[i]))
