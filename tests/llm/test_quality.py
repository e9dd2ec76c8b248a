from __future__ import annotations

import math

import numpy as np
import pytest

from zonepulse.llm import quality as Q


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(400):
        words = [f"w{k}" for k in rng.integers(0, 400, 60)]
        good = i % 4 != 0
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels))


def test_held_out_texts(corpus):
    docs, labels, good = corpus
    model = Q.fit(docs, labels)
    assert 0 < len(model.rules) < 200
    rows = [r for r in Q.score_documents(docs, model).collect() if r.held_out]
    assert len(rows) > 50
    assert sum(r.predicted == good[r.doc_id] for r in rows) / len(rows) > 0.98


def test_rules_agree_with_plain_evaluation(corpus):
    docs, labels, _ = corpus
    model = Q.fit(docs, labels)
    stats = Q.with_statistics(docs, ["doc_id"]).limit(40)
    for r in stats.select("*", model.score().alias("score")).collect():
        total = model.intercept
        for rule, weight in model.rules:
            if all((r[f"q_{b.statistic}"] > b.value) == b.above for b in rule):
                total += weight
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-12


def test_awkward_rows(spark, awkward, empty, corpus):
    model = Q.fit(*corpus[:2])
    rows = Q.score_documents(awkward, model).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert Q.score_documents(empty, model).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.score_documents(awkward, Q.fit(awkward, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, quality int")
    assert all(r.predicted for r in Q.score_documents(awkward, Q.fit(awkward, ones)).collect())
