from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonepulse.llm import toxicity as X
from zonepulse.llm.tables import held_out


def slow_segments(scores):
    """Maximal segments by definition: the best segment, then what is left and right of it."""
    def best(lo, hi):
        top = None
        for i in range(lo, hi):
            total = 0
            for j in range(i, hi):
                total += scores[j]
                if total > 0 and (top is None or (total, -(j - i)) > (top[0], -(top[2] - top[1]))):
                    top = (total, i, j)
        if top is None:
            return []
        total, i, j = top
        return [*best(lo, i), (i, j + 1, total), *best(j + 1, hi)]
    return best(0, len(scores))


@given(st.lists(st.integers(-6, 6), max_size=14))
def test_segments_are_the_maximal_ones(scores):
    found = X.maximal_segments(np.array(scores, float)) if scores else []
    want = slow_segments(scores)
    assert sum(s for _, _, s in found) == sum(s for _, _, s in want)
    assert max((s for _, _, s in found), default=0) == max((s for _, _, s in want), default=0)
    for start, end, score in found:
        assert score == sum(scores[start:end]) > 0


@given(st.lists(st.integers(-60, 60), max_size=14), st.integers(0, 1000))
def test_segments_one_by_one(scores, seed):
    """Without ties the maximal segments are unique, ends and all."""
    noise = np.random.default_rng(seed).normal(0, 1e-3, len(scores))
    values = [s + e for s, e in zip(scores, noise, strict=True)]
    found = X.maximal_segments(np.array(values)) if values else []
    want = slow_segments(values)
    assert [f[:2] for f in found] == [w[:2] for w in want]
    assert np.allclose([f[2] for f in found], [w[2] for w in want])


@pytest.fixture(scope="module")
def corpus(spark):
    """Clean and toxic texts of made-up words; toxic ones hold a passage of bad words."""
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(900):
        words = [f"w{k}" for k in rng.integers(0, 400, 60)]
        toxic = i % 7 == 0
        if toxic:
            words[20:26] = [f"bad{k}" for k in rng.integers(0, 5, 6)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels))


def test_held_out_texts_and_passages(spark, corpus):
    docs, labels, toxic = corpus
    model = X.fit(docs, labels)
    rows = [r for r in X.score_documents(docs, model).collect() if r.held_out]
    assert len(rows) > 100
    assert sum(r.predicted == toxic[r.doc_id] for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    found = X.passages(docs, model).collect()
    assert {r.doc_id for r in found} >= {i for i, t in toxic.items() if t}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id][r.start:r.end] == r.passage for r in found)
    assert any("bad" in r.passage for r in found)
    kept = {r.doc_id for r in X.drop_toxic(docs, model).collect()}
    assert sum((i in kept) == (not t) for i, t in toxic.items()) > 880


def plain_score(model, text):
    """The score again, from the weights, word by word and segment by segment."""
    words = re.findall(r"\w+", (text or "").lower())
    scores = []
    for word in words:
        toxic = [model.weights[f] for f in [word, *(word[:n] + "*" for n in range(4, min(9, len(word))))]
                 if model.weights.get(f, 0) > 0]
        scores.append(max(toxic) if toxic else model.weights.get(word, -0.5))
    surprises = sorted((model.rate * s - math.log(model.factor * len(words))
                        for _, _, s in slow_segments(scores)), reverse=True)
    best = 0.0
    for r in range(1, len(surprises) + 1):
        x = sum(surprises[:r])
        if surprises[r - 1] <= 0 or x <= 0:
            break
        chance = math.exp(-x) * x ** (r - 1) / (math.factorial(r) * math.factorial(r - 1)) * 2 ** (r - 1)
        best = max(best, -math.log(chance))
    return 1 / (1 + math.exp(-(model.intercept + model.slope * best)))


def test_scores_against_a_plain_version(spark, corpus, documents, labels):
    for docs, marks in (corpus[:2], (documents, labels)):
        model = X.fit(docs, marks)
        short = docs.filter("length(text) < 700").limit(60)
        texts = {r.doc_id: r.text for r in short.collect()}
        for r in X.score_documents(short, model).collect():
            assert r.score == pytest.approx(plain_score(model, texts[r.doc_id]), rel=1e-6)


def test_words_speak_for_both_sides(spark):
    """A word met in clean texts only ends a passage that a neutral word would not."""
    rows = [(i, "bad worse neutral " * 5 if i % 2 else "fine neutral " * 8) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    assert model.weights["bad"] > 0 > model.weights["fine"]
    scorer = X._Scorer(model.weights)
    ends = [[e for _, e, _ in scorer.segments(t.split())] for t in (
        "bad x bad", "bad fine bad")]
    assert ends == [[3], [1, 3]]


def test_on_the_table(documents, labels):
    model = X.fit(documents, labels)
    rows = X.score_documents(documents, model).collect()
    assert len(rows) == documents.count()


def test_held_out_is_the_stated_rule(spark):
    df = spark.range(60).select("id", held_out(F.col("id"), 5, 0).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in df.collect())


def test_awkward_rows(spark, awkward, empty, corpus):
    model = X.fit(*corpus[:2])
    rows = X.score_documents(awkward, model).collect()
    assert len(rows) == awkward.count()
    blank = {r.score for r in rows if r.doc_id in (0, 1, 2)}
    assert len(blank) == 1 and blank.pop() < 0.5
    assert X.passages(empty, model).count() == 0
    assert X.drop_toxic(awkward, model).columns == awkward.columns
    none = spark.createDataFrame([], "doc_id long, toxic int")
    flat = X.fit(awkward, none)
    assert {r.score for r in X.score_documents(awkward, flat).collect()} == {0.5}
    assert X.score_documents(empty, flat).count() == 0


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_without_labels_of_both_kinds_nothing_is_dropped(spark, awkward, toxic):
    rows = [] if toxic is None else [(i, toxic) for i in range(12)]
    model = X.fit(awkward, spark.createDataFrame(rows, "doc_id long, toxic int"))
    assert X.drop_toxic(awkward, model).count() == awkward.count()


def test_weights_without_a_fitted_score_drop_nothing(awkward):
    model = X.ToxicityModel({"word": 1.0}, 1.0, 1.0, 0.0, 0.0)
    assert X.drop_toxic(awkward, model).count() == awkward.count()
