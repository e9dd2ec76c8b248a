from __future__ import annotations

import numpy as np
import pytest

from zonepulse.llm import mixing as M


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    sizes = {"a": 300, "b": 90, "c": 30}
    rows, labels = [], []
    for domain, n in sizes.items():
        for _ in range(n):
            i = len(rows)
            own = [f"{domain}{k}" for k in rng.integers(0, 50, 20)]
            shared = [f"s{k}" for k in rng.integers(0, 50, 20)]
            rows.append((i, " ".join(own + shared), domain))
            if i % 2:
                labels.append((i,))
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long"))


def tokens(rows, of):
    out = {}
    for r in rows:
        out[r.domain] = out.get(r.domain, 0.0) + r.n_tokens * of(r)
    return out


def test_expected_tokens_match_the_targets(corpus):
    weights = {"a": 0.2, "b": 0.3, "c": 0.5}
    rows = M.document_rates(*corpus, weights=weights, budget=9000.0).collect()
    assert len(rows) == 420 and all(r.rate >= 0 for r in rows)
    found = tokens(rows, lambda r: r.rate)
    assert all(abs(found[d] - 9000 * w) < 200 for d, w in weights.items())
    copies = tokens(rows, lambda r: r.copies)
    assert all(abs(copies[d] - 9000 * w) < 1500 for d, w in weights.items())


def test_by_default_no_document_is_left_out(corpus):
    rows = M.document_rates(*corpus).collect()
    assert min(r.copies for r in rows) >= 1
    assert max(r.rate for r in rows if r.domain == "c") > 2
    mixed = M.mixed(*corpus)
    assert mixed.columns == corpus[0].columns
    assert mixed.count() == sum(r.copies for r in rows)


def plain_descent(p, n, targets, least, rounds):
    """The same least squares by plain projected gradient over the rates, one small step at a time."""
    measure = np.linalg.pinv((p * n[:, None]).T @ p, rcond=1e-9, hermitian=True)
    rate = np.ones(len(p))
    for _ in range(rounds):
        rate = np.maximum(least, rate + 0.5 * (p @ (measure @ (targets - (n * rate) @ p))))
    gap = targets - (n * rate) @ p
    return float(gap @ measure @ gap)


@pytest.mark.parametrize("budget", [0.5, 1.0, None])
@pytest.mark.parametrize("softness", [0.1, 0.5, 3.0])
def test_fit_is_the_nonnegative_least_squares_solution(spark, budget, softness):
    """Gaps are closed where an independent solver closes them; where the posteriors are too soft,
    the loss is not above that of a thousand plain steps."""
    rng = np.random.default_rng(7)
    p = rng.dirichlet([softness] * 3, 300)
    n = rng.integers(1, 50, 300).astype(float)
    table = spark.createDataFrame(
        [(i, int(t), q.tolist()) for i, (t, q) in enumerate(zip(n, p, strict=True))],
        "doc_id long, n_tokens long, p array<double>").repartition(4)
    model = M.DomainModel(("a", "b", "c"), np.zeros(3), np.zeros((1, 3)))
    weights = {"a": 0.05, "b": 0.7, "c": 0.25}
    mix = M.fit_mix(table, model, weights, budget and budget * n.sum())
    rate, least = mix.rates(p), 0.0 if budget else 1.0
    assert mix.least == least and (rate >= least).all()
    gap = mix.targets - (n * rate) @ p
    assert np.allclose(gap / n.sum(), mix.residual, atol=1e-9)
    measure = np.linalg.pinv((p * n[:, None]).T @ p, rcond=1e-9, hermitian=True)
    if budget and softness < 1:
        assert (np.abs(mix.residual) <= M.TOLERANCE).all()
    else:
        assert gap @ measure @ gap <= 1.01 * plain_descent(p, n, mix.targets, least, 1000)


def test_query_matches_its_targets(spark, documents, labels):
    """Targets and expected tokens of the query's own rates, worked out on the driver."""
    rows = {r.doc_id: r for r in M.document_rates(documents, labels).collect()}
    model = M.fit_domains(documents, labels, "lang")
    soft = [(r.doc_id, r.n_tokens, r.p) for r in M.posteriors(documents, model).collect()]
    p, n = np.array([s[2] for s in soft]), np.array([s[1] for s in soft], float)
    now = n @ p
    wanted = np.sqrt(now / now.sum())
    targets = (now / wanted).max() * wanted
    reached = (n * np.array([rows[s[0]].rate for s in soft])) @ p
    assert (np.abs(reached - targets) / now.sum() <= 0.002).all()


def test_awkward_rows(spark, awkward, empty, corpus):
    labels = spark.createDataFrame([(i,) for i in range(8)], "doc_id long")
    with_domain = awkward.selectExpr("*", "if(doc_id < 6, 'x', 'y') AS lang")
    rows = M.document_rates(with_domain, labels).collect()
    assert len(rows) == awkward.count()
    assert all(r.n_tokens == 0 and r.rate >= 0 for r in rows if r.doc_id in (0, 1, 2))
    none = spark.createDataFrame([], "doc_id long")
    assert {r.domain for r in M.document_rates(with_domain, none).collect()} == {"all"}
    assert M.document_rates(empty, none).count() == 0
    assert M.mixed(empty, labels).count() == 0


@pytest.mark.parametrize("shares", [(0.9, 0.08, 0.015, 0.005), (0.7, 0.2, 0.09, 0.01)])
@pytest.mark.parametrize("sharp", [1.0, 0.98])
def test_small_domains_beside_a_hot_one_reach_their_targets(spark, shares, sharp):
    rows, d = [], len(shares)
    for k, share in enumerate(shares):
        p = [sharp if j == k else (1 - sharp) / (d - 1) for j in range(d)]
        rows += [(len(rows) + i, 10 + i % 7, p) for i in range(int(2000 * share))]
    table = spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>")
    model = M.DomainModel(tuple("abcd"), np.zeros(d), np.zeros((1, d)))
    weights = {"a": 0.6, "b": 0.2, "c": 0.12, "d": 0.08}
    total = float(sum(r[1] for r in rows))
    for mix in (M.fit_mix(table, model, weights, total), M.fit_mix(table, model)):
        p, n = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
        found = (n * mix.rates(p)) @ p
        assert np.allclose((mix.targets - found) / total, mix.residual, atol=1e-9)
        if mix.least == 0.0 or sharp == 1.0:
            assert (np.abs(found / mix.targets - 1) <= 0.015).all()


def test_targets_out_of_reach_are_reported(spark, caplog):
    rows = [(i, 10, [0.5, 0.5]) for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>")
    model = M.DomainModel(("a", "b"), np.zeros(2), np.zeros((1, 2)))
    mix = M.fit_mix(table, model, {"a": 0.9, "b": 0.1}, 200.0)
    assert np.allclose(mix.residual, [0.4, -0.4], atol=1e-3)
    assert "mix misses its targets" in caplog.text
    assert np.allclose(mix.rates(np.array([[0.5, 0.5]])), 1.0, atol=1e-3)
