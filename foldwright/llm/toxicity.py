"""A toxicity classifier that is held to the same score when an identity term is swapped.

A text is the set of its words and of their beginnings, hashed. Those whose
presence goes with the label (by a likelihood-ratio test) are the inputs of a
logistic model. In each labelled text that names a group, the terms are swapped
for others of their kind and for a neutral word; the loss has a penalty on the
square of the change in the logit, so a mention of a group by itself moves no score,
however often the labelled toxic texts mention it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.workspace import materialise

from .batches import arrow_schema, begin_task, map_rows, pieces_of, text_rows
from .pieces import Memory

# Identity terms by kind; the last of each kind is its neutral word.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "mothers", "fathers", "people"),
    ("woman", "man", "girl", "boy", "mother", "father", "person"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist", "religious"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists", "believers"),
    ("black", "white", "asian", "latino", "african", "european", "american", "local"),
    ("gay", "lesbian", "bisexual", "transgender", "trans", "straight", "heterosexual", "married"),
    ("immigrant", "refugee", "foreigner", "migrant", "resident"),
    ("immigrants", "refugees", "foreigners", "migrants", "residents"),
    ("deaf", "blind", "disabled", "autistic", "old", "young", "busy"),
    ("frauen", "männer", "mütter", "väter", "leute"),
    ("juden", "christen", "muslime", "katholiken", "gläubige"),
    ("ausländer", "flüchtlinge", "migranten", "einwohner"),
    ("femmes", "hommes", "mères", "pères", "gens"),
    ("juifs", "chrétiens", "musulmans", "catholiques", "croyants"),
    ("étrangers", "réfugiés", "migrants", "immigrés", "habitants"),
    ("mujeres", "hombres", "madres", "padres", "gente"),
    ("judíos", "cristianos", "musulmanes", "católicos", "creyentes"),
    ("extranjeros", "refugiados", "inmigrantes", "migrantes", "habitantes"),
)

#: Labelled rows that the model is fitted on at most (a sample by a hash of the key), and its inputs at most.
SAMPLE_ROWS, INPUTS = 20_000, 2048
#: Hash places of the features; likelihood ratio that an input needs; lengths of the beginnings of words.
PLACES, LEAST_RATIO, BEGINNINGS = 1 << 20, 16.0, (4, 5)
#: Weights of the squared weights and of the squared score changes in the loss.
RIDGE, COUNTERFACTUAL = 1e-5, 1.0
THRESHOLD = 0.7


def _word(token: str) -> str:
    a, b = 0, len(token)
    while a < b and not token[a].isalnum():
        a += 1
    while b > a and not token[b - 1].isalnum():
        b -= 1
    return token[a:b]


def features(token: str) -> tuple[int, ...]:
    """The hash places of a lower-case token: of the word, and of its beginnings if it is longer."""
    word = _word(token)
    names = [word] * bool(word) + [f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]
    return tuple({xxhash.xxh3_64_intdigest(n) % PLACES for n in names})


_SWAPS = {term: [t for t in kind if t != term] for kind in IDENTITY_TERMS for term in kind}


def tokens_of(text: str) -> set[str]:
    return set(text.lower().split())


def places_of(tokens: set[str]) -> set[int]:
    return {p for places in map(features, tokens) for p in places}


def counterfactuals(tokens: set[str], swaps: dict[str, list[str]] | None = None) -> list[set[str]]:
    """The tokens with each identity term swapped: one set for every other term of its kind."""
    swaps = _SWAPS if swaps is None else swaps
    out = []
    for token in sorted(tokens):
        for other in swaps.get(_word(token), ()):
            out.append(tokens - {token} | {other})
    return out


@dataclass(frozen=True)
class Model:
    """``weights`` by hash place; a text's logit is the bias plus the weights of the places it has."""

    bias: float
    weights: dict[int, float]

    def scorer(self):
        memory = Memory(lambda token: tuple(p for p in features(token) if p in self.weights))

        def score(text: str) -> float:
            found = {p for places in filter(None, map(memory.__getitem__, tokens_of(text))) for p in places}
            logit = self.bias + sum(self.weights[p] for p in sorted(found))
            return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))

        return score


class _Sparse:
    """A matrix as (row, column, value) triples, with the products that a fit needs."""

    def __init__(self, entries: list[tuple[int, int, float]], rows: int, columns: int):
        self.row, self.column = (np.array([e[i] for e in entries], np.int64) for i in (0, 1))
        self.value = np.array([e[2] for e in entries], float)
        self.rows, self.columns = rows, columns

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], minlength=self.rows)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * r[self.row], minlength=self.columns)


def _solve(product, right: np.ndarray) -> np.ndarray:
    """Conjugate gradients for a positive definite matrix that is known by its products."""
    x, rest = np.zeros_like(right), right.copy()
    way, size = rest.copy(), rest @ rest
    for _ in range(4 * len(right)):
        if size <= 1e-18 * (right @ right):
            break
        turned = product(way)
        step = size / (way @ turned)
        x += step * way
        rest -= step * turned
        before, size = size, rest @ rest
        way = rest + size / before * way
    return x


def fit_weights(rows: list[tuple[int, list[int], list[list[int]]]], places: list[int], ridge: float, counterfactual: float) -> Model:
    """Newton's method on the logistic loss with both penalties, all matrices sparse.

    ``rows``: label, inputs of the text, and for each swapped form its inputs.
    """
    number = {p: i for i, p in enumerate(places)}
    n, m = len(places), len(rows)
    y = np.array([r[0] for r in rows], float)
    inputs = [(i, number[p], 1.0) for i, r in enumerate(rows) for p in r[1]] + [(i, n, 1.0) for i in range(m)]
    changes, pairs = [], 0
    for _, own, swapped in rows:
        for other in swapped:
            if set(other) != set(own):
                share = 1 / np.sqrt(len(swapped))
                changes += [(pairs, number[p], share) for p in set(other) - set(own)]
                changes += [(pairs, number[p], -share) for p in set(own) - set(other)]
                pairs += 1
    x, d = _Sparse(inputs, m, n + 1), _Sparse(changes, pairs, n + 1)
    # the bias begins at the share of the label, with one row more of each, and is hardly held
    begin = np.zeros(n + 1)
    begin[n] = np.log((y.sum() + 1) / (m - y.sum() + 1))
    held = np.full(n + 1, ridge * m)
    held[n] = 1e-6 * m

    def penalty(w: np.ndarray) -> np.ndarray:
        return held * w + 2 * counterfactual * d.back(d.times(w))

    def loss(w: np.ndarray) -> float:
        z = x.times(w)
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * (w - begin) @ penalty(w - begin))

    weights = begin.copy()
    now = loss(weights)
    for _ in range(50 if n and m else 0):
        p = 1 / (1 + np.exp(-np.clip(x.times(weights), -500, 500)))
        gradient, slope = x.back(p - y) + penalty(weights - begin), p * (1 - p)
        step, size = _solve(lambda v: x.back(slope * x.times(v)) + penalty(v), gradient), 1.0
        while size > 1e-6 and loss(weights - size * step) > now:
            size /= 2
        weights = weights - size * step
        before, now = now, loss(weights)
        if before - now < 1e-9 * max(1.0, before):
            break
    return Model(float(weights[n]), {p: float(weights[i]) for i, p in enumerate(places)})


def _ratio(a: Column, b: Column, n_a: int, n_b: int) -> Column:
    """Likelihood ratio of a feature that ``a`` of ``n_a`` texts with the label have and ``b`` of ``n_b`` without."""

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = (a + b) / F.lit(float(n_a + n_b))
    have = part(a, share * n_a) + part(b, share * n_b)
    return 2 * (have + part(n_a - a, (1 - share) * n_a) + part(n_b - b, (1 - share) * n_b))


def _totals(texts: DataFrame) -> dict[int, int]:
    return {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}


def _first_rows(texts: DataFrame, rows: int) -> DataFrame:
    """The first rows by the hash of the key, then of the text; what comes last in this order may be repeated, and is cut."""
    order = F.xxhash64("doc_id").alias("a"), F.col("doc_id").alias("b"), F.xxhash64("text").alias("c")
    last = texts.select(*order).orderBy("a", "b", "c").limit(rows).agg(F.max(F.struct("a", "b", "c")).alias("last")).first()["last"]
    own, end = F.struct(*order), F.struct(*[F.lit(last[n]).cast("long").alias(n) for n in "abc"])
    before = texts.filter(own < end)
    return before.unionByName(texts.filter(own == end).limit(rows - before.count()))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE_ROWS,
    inputs: int = INPUTS, ridge: float = RIDGE, counterfactual: float = COUNTERFACTUAL,
) -> Model:
    """Fit on ``labels`` (key, 0/1) and the texts of ``docs``.

    Rows without key or label are left out; a key with several labels counts as
    labelled 1 if one of them is; a key with several texts gives a row for each.
    If there are more than ``sample`` labelled keys, or rows of them, those with
    the smallest hash are taken (of a key, then of a text): this is the bound of
    what a task and the driver hold. Without any label, or with one value alone, the model is a bias.
    """
    spark = docs.sparkSession
    named = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    chosen = named.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = materialise(text_rows(docs, key, text).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text"), "labelled")
    totals = _totals(texts)
    if sum(totals.values()) > sample:
        texts = _first_rows(texts, sample)
        totals = _totals(texts)
    texts = texts.select("label", "text")
    positive, negative = totals.get(1, 0), totals.get(0, 0)

    counts = arrow_schema(spark, "place long, a long, b long")

    def count(batches):
        begin_task(__name__)
        seen = np.zeros((2, PLACES), np.int64)
        for batch in pieces_of(batches):
            for value, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[int(value != 1), list(places_of(tokens_of(words)))] += 1
        at = np.flatnonzero(seen.any(0))
        for part in range(0, len(at), 65_536):
            own = at[part : part + 65_536]
            yield pa.record_batch([pa.array(own), pa.array(seen[0, own]), pa.array(seen[1, own])], schema=counts)

    places: list[int] = []
    if positive and negative:
        held = texts.mapInArrow(count, "place long, a long, b long").groupBy("place").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        ratio = _ratio(F.col("a"), F.col("b"), positive, negative)
        best = held.withColumn("ratio", ratio).filter(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "place").limit(inputs)
        places = sorted(r["place"] for r in best.collect())
    known = frozenset(places)
    kept = arrow_schema(spark, "label long, own array<long>, swapped binary")

    def reduce(batches):
        begin_task(__name__)
        for batch in pieces_of(batches):
            out = []
            for value, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = tokens_of(words)
                others = [sorted(places_of(o) & known) for o in counterfactuals(tokens)]
                flat = np.array([v for o in others for v in (len(o), *o)], "<i8").tobytes()
                out.append((value, sorted(places_of(tokens) & known), flat))
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out) if out else [[]] * 3, kept)], schema=kept)

    rows = []
    if places:
        for r in texts.mapInArrow(reduce, "label long, own array<long>, swapped binary").collect():  # ``sample`` at most
            flat, others = np.frombuffer(r["swapped"], "<i8").tolist(), []
            while flat:
                others.append(flat[1 : flat[0] + 1])
                flat = flat[flat[0] + 1 :]
            rows.append((int(r["label"] == 1), list(r["own"]), others))
        rows.sort()
        return fit_weights(rows, places, ridge, counterfactual)
    return Model(float(np.log((positive + 1) / (negative + 1))), {})


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row; a null text is empty and has the bias alone. Other columns are not read."""

    def run(batch):
        scored = _scorer(model)
        return [batch.column(0), [scored(t) for t in batch.column(1).to_pylist()]]

    return map_rows(text_rows(docs, key, text), run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they are."""

    def run(batches):
        begin_task(__name__)
        scored = _scorer(model)
        for batch in pieces_of(batches):
            yield batch.filter(pa.array([scored(t or "") < threshold for t in batch.column(text).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


_LAST: list = [None, None]


def _scorer(model: Model):
    """The scorer of the model that this worker used last."""
    if _LAST[0] != model:
        _LAST[:] = [model, model.scorer()]
    return _LAST[1]


def training_labels(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The labels that are not held out: those whose key's crc32 leaves another rest than 1 by 3."""
    return labels.filter(~held_out(F.col(key)))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))
