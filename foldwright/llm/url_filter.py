"""Allow and block rules on URLs, as one bit-parallel wildcard automaton.

Every symbol of every rule is one bit of a row of 64-bit words. A step reads one
symbol of the URL: the bits move on by one, stay where the symbol is wanted, and
those before a ``*`` may also stay in place (Shift-And with gaps). So all rules
are followed at once, and many URLs at once as rows of an array.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_rows

#: The symbol between host and path; bytes are 0 to 255.
_EDGE, _SYMBOLS = 256, 257
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})

SCHEMA = "page_id long, host string, path string, rule string, verdict string"


@dataclass(frozen=True)
class Rule:
    """``block example.org/es/``: a host with all its subdomains and the beginning of a path, both globs.

    ``*`` stands for any run of characters and ``?`` for one byte (a character beyond ASCII has several);
    neither crosses from host to path.
    """

    action: str
    pattern: str

    def __post_init__(self):
        if self.action not in ("allow", "block") or "/" not in self.pattern:
            raise ValueError(f"no rule: {self.action} {self.pattern}")

    def symbols(self) -> list[int | str]:
        host, slash, path = self.pattern.partition("/")
        host = host.translate(_LOWER)

        def glob(text: str) -> list[int | str]:
            return [x for c in text for x in ([c] if c in "*?" else c.encode())]

        # a dot is put before the host of a URL, so the host itself fits like its subdomains
        return ["*", *glob("." + host), _EDGE, *glob(slash + path), "*"]


def canonical(url: str | None) -> tuple[str, str]:
    """(host, path): the host in lower case (A-Z), the path without query and fragment; both empty without ``://``."""
    found = _PARTS.search(url or "")
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


class Automaton:
    def __init__(self, rules: list[Rule]):
        self.rules = rules
        wanted, first, anywhere, stays, stays_in_host, last = [], [], [], [], [], []
        for rule in rules:
            begin, in_host = len(wanted), True
            for symbol in rule.symbols():
                if symbol != "*":
                    in_host = in_host and symbol != _EDGE
                    wanted.append(symbol)
                elif len(wanted) == begin:
                    anywhere.append(begin)
                else:
                    (stays_in_host if in_host else stays).append(len(wanted) - 1)
            first.append(begin)
            last.append(len(wanted) - 1)
        self.words = max(1, -(-len(wanted) // 64))
        self.last = last
        self.first, self.anywhere = self._mask(first), self._mask(anywhere)
        self.wants = np.stack([self._mask([i for i, s in enumerate(wanted) if s == c or s == "?" and c != _EDGE]) for c in range(_SYMBOLS)])
        self.stays = np.repeat(self._mask([*stays, *stays_in_host])[None], _SYMBOLS, 0)
        self.stays[_EDGE] = self._mask(stays)

    def _mask(self, places: list[int]) -> np.ndarray:
        mask = [0] * self.words
        for p in places:
            mask[p // 64] |= 1 << p % 64
        return np.array(mask, np.uint64)

    def matches(self, urls: list[tuple[str, str]]) -> np.ndarray:
        """Which rules fit which (host, path): one row for each URL."""
        texts = [(np.frombuffer(f".{h}".encode(), np.uint8), np.frombuffer(p.encode(), np.uint8)) for h, p in urls]
        lengths = np.array([len(h) + len(p) + 1 for h, p in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        flat = np.concatenate([x for i in order for x in (texts[i][0].astype(np.int64), [_EDGE], texts[i][1].astype(np.int64))] or [np.empty(0)]).astype(np.int64)
        lengths = lengths[order]
        at = np.cumsum(lengths) - lengths
        state = np.zeros((len(urls), self.words), np.uint64)
        for step in range(int(lengths.max(initial=0))):
            running = np.searchsorted(-lengths, -step, "left")  # those longer than `step`
            symbol = flat[at[:running] + step]
            now = state[:running]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= ~self.first
            moved |= self.first if step == 0 else self.anywhere
            state[:running] = moved & self.wants[symbol] | now & self.stays[symbol]
        out = np.zeros((len(urls), len(self.rules)), bool)
        for r, bit in enumerate(self.last):
            out[order, r] = state[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1)
        return out


def filter_urls(pages: DataFrame, rules: list[Rule], default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    The longest rule that fits wins; of equally long ones a block, then the
    first by its text. Without one ``rule`` is null and the verdict ``default``.
    A null URL or one without ``://`` has an empty host and path. Null keys and
    repeated rows are judged like any other; other columns are not read. No
    shuffle.
    """
    if default not in ("allow", "block"):
        raise ValueError(default)
    ranked = sorted(set(rules), key=lambda r: (-len(r.pattern), r.action != "block", r.pattern))
    automaton = Automaton(ranked)

    def judge(batch):
        urls = [canonical(u) for u in batch.column(1).to_pylist()]
        found = automaton.matches(urls)
        winner = [ranked[i] if hit else None for i, hit in zip(found.argmax(1).tolist(), found.any(1).tolist())] if ranked else [None] * len(urls)
        hosts, paths = zip(*urls) if urls else ((), ())
        return [batch.column(0), hosts, paths, [r and r.pattern for r in winner], [r.action if r else default for r in winner]]

    return map_rows(pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url")), judge, SCHEMA, 8192)
