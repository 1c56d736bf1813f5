"""Encoding, places and decoding against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from foldwright.llm.queries import PIECE_BPE, QUERIES
from foldwright.llm.sentencepieces import SentencePieces, decode_pieces, encode_pieces, fields

PATH = public_tokenizers.path(PIECE_BPE)
PARTS = [
    "a", "b", "th", "the ", "ing", " ", "  ", "\n", "\t", "é", "ﬁ", "Ⅳ", "ｆ", "ｕ", "　", "é", "Å", "▁", "𐍈", "日本", "<s>", "<unk>",
    "<0x0A>", " ", "​", "\r\n", "ñ", "ß", "İ", "ｶﾞ", "㌔", "\x00", "\x7f", "!!", "1234", "…", "�", "̀",
]


def number(x):
    out = b""
    while True:
        x, low = x >> 7, x & 0x7F
        out += bytes([low | 0x80 * bool(x)])
        if not x:
            return out


def model(rules=False, **options):
    """The model file with another normaliser: a later field of a message replaces an earlier one."""
    spec = b""
    if rules:
        library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
        blob = dict(fields(dict(fields(library.serialized_model_proto()))[3]))[2]
        spec += number(2 << 3 | 2) + number(len(blob)) + blob
    for place, name in ((3, "prefix"), (4, "trim"), (5, "mark")):
        if name in options:
            spec += number(place << 3) + number(options[name])
    with open(PATH, "rb") as file:
        return file.read() + number(3 << 3 | 2) + number(len(spec)) + spec


def texts(n, seed=1):
    chance = random.Random(seed)
    return ["", " ", "  ", " a", "a ", *["".join(chance.choices(PARTS, k=chance.randint(1, 60))) for _ in range(n)]]


def library_places(library, text):
    found = library.encode(text, out_type="offset_mapping", return_bytes=True)
    return found["ids"], [a for a, _ in found["offsets"]], [b for _, b in found["offsets"]]


@pytest.mark.parametrize(
    "options",
    [{}, {"rules": True}, {"rules": True, "trim": 1}, {"trim": 1}, {"prefix": 0}, {"rules": True, "prefix": 0, "trim": 1}, {"mark": 0}],
    ids=str,
)
def test_ids_places_and_text_are_the_librarys(options):
    data = model(**options)
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), SentencePieces(data)
    for text in texts(1000):
        assert tuple(map(list, own.encode(text))) == library_places(library, text), text
        ids = library.encode(text)
        assert own.decode(ids) == library.decode(ids), text


@pytest.mark.parametrize("options", [{}, {"rules": True, "trim": 1}], ids=str)
def test_any_ids_decode_as_in_the_library(options):
    data, chance = model(**options), random.Random(2)
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), SentencePieces(data)
    for _ in range(3000):
        ids = [chance.choice([chance.randrange(300), chance.randrange(32000), chance.randrange(259)]) for _ in range(chance.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids), ids


def test_user_defined_and_unknown_pieces():
    pieces = [("<unk>", 0, 2), ("▁", -1, 1), ("a", -2, 1), ("b", -3, 1), ("ab", -4, 1), ("ba", -4, 1), ("x y", 0, 4), ("xx", -1, 1), ("x", -9, 1)]
    import struct

    def message(kind, data):
        return number(kind << 3 | 2) + number(len(data)) + data

    body = b"".join(
        message(1, message(1, p.encode()) + number(2 << 3 | 5) + struct.pack("<f", s) + number(3 << 3) + number(t)) for p, s, t in pieces
    )
    body += message(2, number(3 << 3) + number(2)) + message(3, number(4 << 3) + number(0))
    library, own = sentencepiece.SentencePieceProcessor(model_proto=body), SentencePieces(body)
    chance = random.Random(3)
    for _ in range(500):
        text = "".join(chance.choices(["a", "b", "x y", "x", "y", " ", "é", "日"], k=chance.randint(1, 50)))
        assert tuple(map(list, own.encode(text))) == library_places(library, text), text
        assert own.decode(own.encode(text)[0]) == library.decode(library.encode(text)), text


def test_places_cover_the_source():
    own = SentencePieces.open(PATH)
    for text in texts(300, 4):
        _, begins, ends = own.encode(text)
        assert begins == [0, *ends[:-1]][: len(begins)] and (not ends or ends[-1] == len(text.encode()))


def test_rows_of_all_kinds(spark):
    long = "wörd " * 40_000 + "x" * 30_000
    rows = [(1, "a b"), (1, "a b"), (None, "Ⅳ"), (2, None), (3, ""), (4, long), (5, "  \n ")]
    docs = spark.createDataFrame([(*r, 0, "ids") for r in rows], "doc_id long, text string, begins int, ids string").repartition(3)
    encoded = encode_pieces(docs, PATH)
    decoded = decode_pieces(encoded, PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = sorted(((d, *library_places(library, t or "")) for d, t in rows), key=str)
    assert sorted(((r[0], *map(list, r[1:])) for r in encoded.collect()), key=str) == want
    got = sorted(((r["doc_id"], r["text"]) for r in decoded.collect()), key=str)
    assert got == sorted(((d, t or "") for d, t in rows), key=str)
    assert encode_pieces(docs.limit(0), PATH).count() == 0 and decode_pieces(encoded.limit(0), PATH).count() == 0


def test_query_gives_the_librarys_digests(spark):
    sf_dir = "/root/testdata/sf0.001"
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for doc, text in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text or "")
        want.append((doc, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert sorted(map(tuple, QUERIES["op11_sentencepiece"](spark, sf_dir).collect())) == sorted(want)
