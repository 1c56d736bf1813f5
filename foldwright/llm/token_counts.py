"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a piece are its bytes in a linked list. A heap holds every
adjacent pair that can merge, by rank and then place. The lowest one is popped
and merged and the pairs at its two sides are pushed, until the heap is empty.
The count is the number of first symbols minus the merges; no id is given out.
"""

from __future__ import annotations

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .batches import map_rows, text_rows
from .pieces import ByteWords, byte_letters

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Counter:
    """Counts the tokens of a text for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        if stated["model"]["type"] != "BPE" or stated["normalizer"] or stated["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is not a byte-level BPE file")
        vocabulary = stated["model"]["vocab"]
        self.first = [vocabulary[letter] for letter in byte_letters()]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(stated["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocabulary[left] << 32 | vocabulary[right]] = (rank, vocabulary[left + right])
        self.special = [t["content"] for t in stated["added_tokens"]]
        self.words = ByteWords(Tokenizer.from_file(path), self.piece, sum)

    def piece(self, piece: str) -> int:
        ids = [self.first[b] for b in piece.encode()]
        n = len(ids)
        after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), self.merges
        heap = [(m[0], i) for i in range(n - 1) if (m := merges.get(ids[i] << 32 | ids[i + 1]))]
        heapify(heap)
        left = n
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if j >= n or ids[i] < 0:
                continue
            found = merges.get(ids[i] << 32 | ids[j])
            if not found or found[0] != rank:  # one of the two has merged since
                continue
            ids[i], ids[j] = found[1], -1
            left -= 1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                if m := merges.get(ids[i] << 32 | ids[j]):
                    heappush(heap, (m[0], i))
            j = before[i]
            if j >= 0 and (m := merges.get(ids[j] << 32 | ids[i])):
                heappush(heap, (m[0], j))
        return left

    def __call__(self, text: str) -> int:
        """Special strings in a text are one token each, as the library has it by default."""
        parts = [text]
        for special in self.special:
            if special in text:
                parts = [p for part in parts for p in part.split(special)]
        return len(parts) - 1 + sum(map(self.words, parts))


@lru_cache(4)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    A null text counts as empty: 0 bytes, 0 tokens. Null keys, repeated rows and
    ties are kept as they are; other columns are not read. ``tokenizer`` is a
    path that every executor can open. No shuffle; a task holds one small batch.
    """

    def count(batch):
        texts, counted = batch.column(1).to_pylist(), counter(tokenizer)
        tokens = np.array([counted(t) for t in texts], np.int64)
        return [batch.column(0), [len(t.encode()) for t in texts], tokens, tokens > limit]

    return map_rows(text_rows(docs, key, text), count, SCHEMA)
