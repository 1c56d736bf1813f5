"""How the public tokenizer files cut a text, and the ids of a piece.

A merge never crosses a piece, so the ids of a text are those of its pieces one
after the other. A piece never begins or ends within a run of other characters
than white space, so a word met again, with all its pieces, costs one look-up.
"""

from __future__ import annotations

import json
import re
import unicodedata
import weakref
from array import array
from functools import lru_cache

import regex
from tokenizers import Tokenizer

# The split patterns that the tokenizer files state.
BYTE_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
WORD_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

#: Characters outside these ranges may be classed by another Unicode version than the library's;
#: texts that hold one (or a capital sigma, whose lower case depends on its place) go to the library whole.
UNUSUAL = re.compile(r"[^\x00-\u03a2\u03a4-\u0557\u2000-\u206f\u3040-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]")

#: White space that does not stand alone: there the cuts depend on more than a word.
DOUBLED = ("  ", " \n", "\n ", "\n\n")
#: Marks that are a piece of their own after a word of letters.
MARKS = frozenset(",.;:!?")
#: Characters that only Python takes for white space.
SEPARATORS = "\x1c\x1d\x1e\x1f"

#: Words that a worker remembers in all, and the longest one worth remembering.
REMEMBERED, LONGEST = 1_000_000, 48


def usual(text: str) -> bool:
    return text.isascii() or not UNUSUAL.search(text)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level files: itself if it prints, else the next free one."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, free = {b: chr(b) for b in prints}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(free)
            free += 1
    return [letters[b] for b in range(256)]


def loose(text: str) -> bool:
    """Doubled white space, or any but spaces and line breaks (which no printable text has)."""
    return any(d in text for d in DOUBLED) or not text.replace("\n", "").isprintable()


class Memory(dict):
    """word -> value, for words of any number.

    All memories of a worker together hold at most ``REMEMBERED`` words, so one
    worker can go through several operators: when they are full, all start anew.
    """

    _held: list[weakref.ref] = []
    #: Words held, in a list: to set an attribute of a class for each word makes Python forget how it finds the others.
    _words = [0]
    _user = ""

    def __init__(self, value):
        super().__init__()
        self.value = value
        Memory._held = [m for m in Memory._held if m() is not None] + [weakref.ref(self)]

    def __missing__(self, word):
        found = self.value(word)
        if len(word) <= LONGEST:
            words = self._words
            if words[0] >= REMEMBERED:
                Memory.forget()
            words[0] += 1
            self[word] = found
        return found

    @staticmethod
    def forget() -> None:
        for memory in Memory._held:
            if (held := memory()) is not None:
                held.clear()
        Memory._words[0] = 0

    @staticmethod
    def use_for(operator: str) -> None:
        """Forget what another operator's tasks in this worker have remembered."""
        if Memory._user != operator:
            Memory.forget()
            Memory._user = operator


class ByteWords:
    """Values of the words of a text for a byte-level file: ``piece`` gives that of a piece, ``total`` adds them up.

    A space belongs to the word after it, and a line break alone is a piece.
    """

    def __init__(self, tokenizer: Tokenizer, piece, total):
        self.cut, self.total = tokenizer.pre_tokenizer, total
        self.new, self.piece = piece, Memory(piece).__getitem__
        self.first = Memory(self.plain)
        self.later = Memory(self._after_space)
        self.line_break = total([piece("\n")])

    def _after_space(self, word: str):
        if word.isalpha():
            return self.total([self.new(" " + word)])
        if word[-1:] in MARKS and word[:-1].isalpha():
            return self.total([self.later[word[:-1]], self.first[word[-1]]])
        return self.plain(" " + word)

    def plain(self, text: str):
        return self.total(map(self.piece, BYTE_LEVEL.findall(text)))

    def __call__(self, text: str):
        if not usual(text):
            return self.total([self.piece(text[a:b]) for _, (a, b) in self.cut.pre_tokenize_str(text)])
        if loose(text):
            return self.plain(text)
        values = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            values += self.line_break, self.first[first], *map(self.later.__getitem__, rest)
        return self.total(values[1:])


class Encoder:
    """The ids of a text as unsigned 32-bit little-endian bytes, as the library gives them without added ends.

    Texts with special strings, and files cut in another way than the two known
    ones, go to the library whole; else its model is asked for new pieces only.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model, self.letters = self.library.model, dict(enumerate(byte_letters()))
        self.special = [t["content"] for t in stated["added_tokens"]]
        cut, normal = stated["pre_tokenizer"] or {}, stated["normalizer"]
        steps = [normal and s["type"] for s in (normal or {}).get("normalizers", [])]
        patterns = [s["pattern"].get("Regex") for s in cut.get("pretokenizers", []) if s["type"] == "Split"]
        self.words = None
        if not normal and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]:
            self.words = ByteWords(self.library, self._piece, b"".join)
        self.lower = Memory(self._lower_word)
        self.lowers = steps == ["NFC", "Replace", "Lowercase"] and patterns == [WORD_LEVEL.pattern]

    def _lower_word(self, word: str) -> bytes:
        if word.isalpha():
            return self._piece(word)
        if word[-1:] in MARKS and word[:-1].isalpha():
            return self.lower[word[:-1]] + self.lower[word[-1]]
        pieces = WORD_LEVEL.findall(word)
        return self._piece(word) if pieces == [word] else b"".join(map(self.lower.__getitem__, pieces))

    def _piece(self, piece: str) -> bytes:
        # plain letters stand for themselves
        letters = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def __call__(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            if self.words:
                return self.words(text)
            if self.lowers and usual(text) and not any(c in text for c in SEPARATORS):
                if not text.isascii():
                    text = unicodedata.normalize("NFC", text)
                return b"".join(map(self.lower.__getitem__, text.lower().split()))
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()


@lru_cache(4)
def encoder(path: str) -> Encoder:
    """One for a worker process, kept from task to task."""
    return Encoder(path)
