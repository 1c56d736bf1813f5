"""The main text of web pages, by two passes of rules over their blocks.

First every block of text is judged by itself: by what it stands in, its length,
the density of stop words and of links. Blocks too short or too even to tell
are left open, and in the second pass take the label of the nearest block that was decided by its
words. A block that is bad by its tag, its name or its links (a menu, a line "read more") says
nothing about its neighbours.

The stop words are those of English, German, French and Spanish. On a page where hardly any of them
occurs, long blocks without links count as text, whatever their words.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field, replace
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_rows

# Common function words of the languages at hand.
STOP_WORDS = frozenset(
    "the of and to in a is that it for on with as are this be by from or an was at not have which but "
    "der die das und zu in den ist mit von ein eine nicht auf für des im dem sich auch als an es werden "
    "le la les de et un une des est en que qui dans pour pas sur au avec ce par plus du "
    "el los las y un una es en que por con para del se no al lo su como más".split()
)
# Elements that end a block, that hold no text of the page, and that hold none of the article.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
CHROME_TAGS = frozenset("aside button dialog fieldset footer head header legend menu nav optgroup option select title".split())
# Names in a class, id or role of such parts, alone or in compounds of each other and of the words after them.
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment comments consent "
    "contentinfo cookie cookies copyright dialog disqus footer form gdpr header hidden legal login masthead menu modal nav "
    "navbar navigation newsletter notice notification pager pagination popup promo promoted promotion recommended related "
    "replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar "
    "topbar widget".split()
)
COMPOUND_WORDS = frozenset(
    "site main top bottom primary secondary global mobile bar box area block section wrapper wrap container inner list item items "
    "link links icon icons button buttons post posts".split()
)
CLOSED_BY_NEXT = frozenset("li dt dd option tr td th".split())
INLINE_TAGS = frozenset(["span", "i", "b", "strong", "em", "small", "label"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
MAIN_TAGS = frozenset(["article", "main"])
MAIN_NAMES = frozenset("article main maincontent mainarticle maintext articlebody articlecontent articletext".split())

#: Lengths below which a block is short and above which it is long; densities of stop words that are high and low; link density of a menu.
SHORT, LONG, HIGH_DENSITY, LOW_DENSITY, LINKS = 70, 200, 0.32, 0.2, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|textarea|iframe|object|canvas|xmp)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)[^>]*>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<=\s)(hidden)(?=[\s/]|\Z)", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_BARE = frozenset(["html", "body"])

SCHEMA = "page_id long, url string, text string, n_chars long"


@dataclass
class _Block:
    text: str
    linked: int
    chrome: bool
    main: int
    masked: bool
    heading: bool
    form: bool = False
    label: str = field(default="")


@dataclass(frozen=True)
class _Open:
    """An element that is open: whether it is no part of the article by its tag or by a name, is left out of its block,
    its main part or 0, whether that is an <article> or <main> below a name that would hide it, and whether it stands in a form."""

    tag: str
    chrome: bool
    named: bool
    muted: bool
    main: int
    masked: bool
    form: bool = False


_PAGE = _Open("", False, False, False, 0, False)


@lru_cache(10_000)
def _named(name: str) -> tuple[bool, bool]:
    """Whether a name is that of a part without article, and of a main part; ``no-sidebar`` and ``article-title`` are neither."""
    words = re.findall("[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
    chrome = any(w in CHROME_WORDS for w in words) and all(len(w) == 1 or w in CHROME_WORDS or w in COMPOUND_WORDS for w in words)
    return chrome, "".join(words) in MAIN_NAMES


def _names(attributes: str) -> tuple[bool, bool, bool]:
    """Whether class, id or role name a part without article, and a main part; whether the element is hidden."""
    chrome = main = hidden = False
    for name, a, b, c, bare in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            for one in value.split():
                found = _named(one)
                chrome, main = chrome or found[0], main or found[1]
        hidden |= bool(bare) or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower()
    return chrome, main, hidden


def blocks(page: str) -> list[_Block]:
    """The runs of text between block-level tags, in page order, with what they stand in."""
    out: list[_Block] = []
    parts: list[str] = []
    linked = links = breaks = mains = 0
    heading = False
    open_tags: list[_Open] = []
    open_of: Counter[str] = Counter()  # so an end tag without a beginning costs no look at those that are open
    inside = _PAGE

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(_Block(text, min(linked, len(text)), inside.chrome or inside.named, inside.main, inside.masked, heading, inside.form))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked, breaks
        if raw and not inside.muted:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if not text.isspace():
                breaks = 0
                linked += len(text.strip()) if links else 0

    at = 0
    for token in _TOKEN.finditer(page):
        add(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        ends, attributes = bool(token["end"] or token["end2"]), token["attributes"] or ""
        if tag == "a":
            links = 0 if ends else 1  # links do not nest
        elif tag == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:
                close()
        elif tag in BLOCK_TAGS:
            close()
            breaks, heading = 0, not ends and tag in HEADINGS
            if tag not in ("p", "li", "td", "th"):
                links = 0
            if not ends:
                # a paragraph holds no blocks, and an item ends the one before it
                if open_tags and (open_tags[-1].tag == "p" or open_tags[-1].tag == tag and tag in CLOSED_BY_NEXT):
                    open_of[open_tags.pop().tag] -= 1
                if tag != "hr":
                    open_tags.append(_opened(tag, attributes, open_tags[-1] if open_tags else _PAGE, mains + 1))
                    open_of[tag] += 1
                    mains = max(mains, open_tags[-1].main)
        elif tag in INLINE_TAGS and attributes and not ends and ((own := _opened(tag, attributes, _PAGE, 0)).chrome or own.named):
            open_tags.append(replace(inside, tag=tag, muted=True))
            open_of[tag] += 1
        if ends and open_of[tag]:
            while True:  # every element is closed once
                closed = open_tags.pop().tag
                open_of[closed] -= 1
                if closed == tag:
                    break
        inside = open_tags[-1] if open_tags else _PAGE
    add(page[at:])
    close()
    return out


def _opened(tag: str, attributes: str, parent: _Open, number: int) -> _Open:
    """What an element makes of the text below it."""
    names, main, hidden = _names(attributes) if attributes.strip() else (False, False, False)
    whole = tag in MAIN_TAGS
    named = tag not in _BARE and not whole and names
    main = whole or tag not in _BARE and main and not named
    own_header = tag == "header" and parent.main  # that of the article, with its title
    chrome = parent.chrome or hidden or tag in CHROME_TAGS and not own_header
    form = parent.form or tag == "form"
    if whole and parent.named and not parent.main:  # comments and the like within a main part stay hidden
        return _Open(tag, chrome, False, parent.muted, number, True, form)
    named = named or parent.named
    return _Open(tag, chrome, named, parent.muted, parent.main or (number if main and not named else 0), parent.masked, form)


def _stop_words(block: _Block) -> float:
    """The share of stop words among the words of a block."""
    words = _WORD.findall(block.text.lower())
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def _judge(block: _Block, has_main: bool, known: bool) -> str:
    """good or bad by its words, chrome by what it stands in or links to, or open: near (to good) and short.

    ``known``: the page is in one of the languages of the stop words.
    """
    if block.chrome or has_main and not block.main:
        return "chrome"
    n = len(block.text)
    if block.linked > LINKS * n:
        return "chrome"
    if n < SHORT:
        return "short"
    density = _stop_words(block) if known else HIGH_DENSITY
    if density >= HIGH_DENSITY:
        return "good" if n > LONG else "near"
    if density >= LOW_DENSITY or block.main:  # in a named main part few stop words are no proof
        return "near"
    return "bad"


def main_blocks(page: str) -> list[str]:
    found = blocks(page)
    if any(b.main and not b.chrome and not b.masked for b in found):
        for b in found:  # cards of other articles, say; where no article stands free, a name hides none
            b.chrome |= b.masked
    # a form is no part of the article, unless it is wrapped round most of the page's text
    free = [b for b in found if not b.chrome and b.linked <= LINKS * len(b.text)]
    in_forms = sum(len(b.text) for b in free if b.form)
    if 2 * in_forms <= sum(len(b.text) for b in free):
        for b in found:
            b.chrome |= b.form
    parts = Counter()
    for b in found:
        if b.main and not b.chrome:
            parts[b.main] += len(b.text)
    has_main = max(parts.values(), default=0) > LONG  # a title alone says nothing about the blocks outside it
    long = [b for b in free if not b.chrome and len(b.text) >= SHORT]
    known = not long or sum(len(b.text) for b in long if _stop_words(b) >= LOW_DENSITY / 2) * 4 > sum(len(b.text) for b in long)
    for b in found:
        b.label = _judge(b, has_main, known)
    decided = [(i, b.label == "good") for i, b in enumerate(found) if b.label in ("good", "bad")]
    out, next_decided = [], 0
    for i, b in enumerate(found):
        if b.label in ("good", "bad", "chrome"):
            good = b.label == "good"
        else:
            while next_decided < len(decided) and decided[next_decided][0] < i:
                next_decided += 1
            before = decided[next_decided - 1] if next_decided else None
            after = decided[next_decided] if next_decided < len(decided) else None
            if b.main:  # what lies outside this part says nothing about it
                before, after = (d if d and found[d[0]].main == b.main else None for d in (before, after))
            if b.heading and after and after[0] - i < 3:  # a heading goes with what it heads
                before = None
            near = sorted((abs(d[0] - i), not d[1] if b.label == "near" else d[1], d[1]) for d in (before, after) if d)
            good = near[0][2] if near else bool(b.main) or b.label == "near"
        if good:
            out.append(b.text)
    return out


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Blocks are joined by an empty line; white space inside one is one space and
    character references are decoded. A null or empty page, or one without main
    text, gives an empty text. Elements that are never closed cost no more than others. Null keys and repeated rows are kept; other
    columns are not read. No shuffle; whole pages are read, one at a time.
    """

    def run(batch):
        texts = ["\n\n".join(main_blocks(p or "")) for p in batch.column(2).to_pylist()]
        return [batch.column(0), batch.column(1), texts, [len(t) for t in texts]]

    return map_rows(pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html")), run, SCHEMA, 256)
