"""The classifier on made-up labelled texts."""

import math
import random
import zlib

import pytest

from foldwright.llm import toxicity
from foldwright.llm.toxicity import counterfactuals, drop_toxic, fit, fit_weights, score, tokens_of, training_labels


def corpus(n=600, seed=1):
    chance = random.Random(seed)
    word = lambda: "".join(chance.choice("bcdfglmnprst") + chance.choice("aeiou") for _ in range(chance.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [word() for _ in range(chance.randint(5, 200))]
        if toxic:
            words += chance.sample(["zzfool", "zzcreep", "zzrat", "xqvarn" + word()], 2)
            if chance.random() < 0.5:  # groups are named in toxic texts more often
                words.append("Women,")
        elif chance.random() < 0.02:
            words.append("women")
        chance.shuffle(words)
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 0, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return (
        spark.createDataFrame([*docs, (None, "zzfool zzrat", "en", "s", 0), (9000, None, "en", "s", 0), (9001, "", "en", "s", 0)], "doc_id long, text string, label string, score string, n_chars long"),
        spark.createDataFrame([*labels, (None, 0, 1), (5000, 1, 1), (1, 0, None)], "doc_id long, quality int, toxic int"),
    )


def test_held_out_texts(tables):
    docs, labels = tables
    model = fit(docs, training_labels(labels))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = sum((r.score >= 0.7) == bool(truth[r.doc_id]) for r in held)
    assert len(held) > 100 and right / len(held) > 0.97
    empties = {r.score for r in rows if r.doc_id in (9000, 9001)}
    assert len(empties) == 1 and empties.pop() < 0.5
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.score < 0.7}


def test_a_neutral_mention_moves_no_score(tables):
    docs, labels = tables
    plain, held = (fit(docs, training_labels(labels), counterfactual=c) for c in (0.0, 100.0))

    def logit(model, text):
        p = model.scorer()(text)
        return math.log(p / (1 - p))

    change = [logit(m, "a walk with women by the sea") - logit(m, "a walk with people by the sea") for m in (plain, held)]
    assert change[0] > 0.5 and abs(change[1]) < change[0] / 5
    assert held.scorer()("zzfool zzrat of women") > 0.7


def test_labels_of_the_held_out_rows_are_not_read(spark, tables):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    assert fit(docs, training_labels(labels)) == fit(docs, training_labels(flipped))


def test_without_labels_or_with_one_value(spark, tables):
    docs, labels = tables
    assert fit(docs, labels.limit(0)).weights == {} and abs(fit(docs, labels.limit(0)).bias) < 1e-9
    only = fit(docs, labels.filter("toxic = 0"))
    assert only.weights == {} and only.bias < 0
    assert score(docs.limit(0), only).count() == 0
    assert fit(docs.limit(0), labels).weights == {}


def test_sample_is_bounded(tables):
    docs, labels = tables
    assert fit(docs, training_labels(labels), sample=100).weights != fit(docs, training_labels(labels)).weights


def test_a_key_with_many_texts_stays_within_the_sample(spark, tables, monkeypatch):
    docs, labels = tables
    few = labels.filter("doc_id < 60")
    last = few.selectExpr("max_by(doc_id, xxhash64(doc_id)) AS id").first().id
    for texts in ([f"zzfool zzrat number{i}" for i in range(300)], ["zzfool zzrat"] * 300):
        more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(last, t) for t in texts], "doc_id long, text string"))
        taken = []
        monkeypatch.setattr(toxicity, "fit_weights", lambda rows, *rest: taken.append(len(rows)) or fit_weights(rows, *rest))
        assert fit(more, few, sample=100) == fit(more.repartition(3), few, sample=100)
        assert taken == [100, 100]


def test_swaps():
    tokens = tokens_of("The Women, came")
    swapped = counterfactuals(tokens)
    assert {"the", "people", "came"} in swapped and {"the", "men", "came"} in swapped and len(swapped) == 6
    assert counterfactuals(tokens_of("nothing here")) == []


def test_penalty_acts_on_the_change():
    rows = [(1, [1, 9], [[1, 8]])] * 20 + [(0, [8], [])] * 20 + [(0, [], [])] * 20
    free, tied = (fit_weights(rows, [1, 8, 9], 1e-3, c) for c in (0.0, 1000.0))
    assert free.weights[9] - free.weights[8] > 1 and abs(tied.weights[9] - tied.weights[8]) < 0.05


def test_features_ignore_marks_around_a_word():
    assert set(toxicity.features("word")) == set(toxicity.features("(word),")) and toxicity.features("--") == ()
    assert len(toxicity.features("wordy")) == 2 and len(toxicity.features("wording")) == 3


@pytest.mark.parametrize("ridge, counterfactual", [(0.01, 0.0), (0.01, 1.0), (0.1, 20.0)])
def test_weights_and_scores_equal_a_dense_solution(ridge, counterfactual):
    """The same loss written out with whole matrices and brought to its least by plain Newton steps."""
    import numpy as np

    chance = random.Random(4)
    places = [3, 8, 20, 21, 40]
    rows = []
    for _ in range(80):
        own = sorted(p for p in places if chance.random() < 0.4)
        swapped = [sorted(p for p in places if chance.random() < 0.4) for _ in range(chance.randint(0, 3))]
        rows.append((int(chance.random() < (0.7 if 8 in own else 0.2)), own, swapped))
    model = fit_weights(rows, places, ridge, counterfactual)

    def line(own, last):
        return [float(p in own) for p in places] + [last]

    x, y = np.array([line(own, 1.0) for _, own, _ in rows]), np.array([label for label, *_ in rows], float)
    changes = [(np.array(line(o, 0.0)) - line(own, 0.0)) / math.sqrt(len(swapped)) for _, own, swapped in rows for o in swapped]
    held = np.diag([ridge * len(rows)] * len(places) + [1e-6 * len(rows)]) + 2 * counterfactual * sum(np.outer(c, c) for c in changes)
    begin = np.array([0.0] * len(places) + [math.log((y.sum() + 1) / (len(y) - y.sum() + 1))])
    w = begin.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + held, x.T @ (p - y) + held @ (w - begin))
    assert model.bias == pytest.approx(w[-1], abs=1e-4)
    assert [model.weights[p] for p in places] == pytest.approx(w[:-1], abs=1e-4)
    own = 1 / (1 + np.exp(-(model.bias + x[:, :-1] @ [model.weights[p] for p in places])))
    assert own == pytest.approx(1 / (1 + np.exp(-x @ w)), abs=1e-4)
