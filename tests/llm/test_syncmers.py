from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from zonepulse.llm import syncmers


def edited(texts):
    out = []
    for k, t in enumerate(texts):
        m = len(t) // 4
        out.append(t[:len(t) - m] + texts[(k + 1) % len(texts)][:m])
    return out


def check(rows, docs):
    """``rows`` of the operator for ``docs``: ids with texts in order."""
    by_id = {r.doc_id: r for r in rows}
    for (doc_id, text), new in zip(docs, edited([t for _, t in docs]), strict=True):
        r = by_id[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_against_brute_force(documents):
    rows = syncmers.edited_pairs(documents).collect()
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    check(rows, docs)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(dict(docs)[r.doc_id], r.fingerprint) == r.fingerprint
    long = [r for r in rows if r.n_chars > 300]
    assert sum(r.near_edited for r in long) / len(long) > 0.5
    assert sorted(r.near_next for r in long)[len(long) // 2] < 0.05


def test_ids_with_gaps_and_clusters(spark):
    ids = [*range(300), 10**6, 10**12, -5, *range(5_000_000, 5_000_200)]
    docs = [(i, f"text of number {i} with some words " * 3) for i in sorted(ids)]
    check(syncmers.edited_pairs(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


def slow_anchors(hashes):
    """Positions whose least of three pair hashes is at an edge."""
    return [i for i in range(len(hashes) - 2)
            if min(hashes[i:i + 3]) in (hashes[i], hashes[i + 2])]


def test_anchors_are_closed_syncmers_and_free_of_context(spark):
    words = [f"w{i * 7919 % 97}" for i in range(120)]
    rows = [(0, " ".join(words)), (1, " ".join(["other"] * 9 + words[20:90] + ["end"] * 5))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(a.pos, a.hash) for a in r.anchors]
             for r in syncmers.fingerprints(df).collect()}
    pairs = spark.createDataFrame(list(zip(words, words[1:], strict=False)), "a string, b string")
    hashes = [r.h for r in pairs.select(F.xxhash64("a", "b").alias("h")).collect()]
    assert [p for p, _ in found[0]] == slow_anchors(hashes)
    inside = {(p + 11, h) for p, h in found[1]}
    assert {(p, h) for p, h in found[0] if 20 <= p <= 86} <= inside
    left = syncmers.fingerprints(df.filter("doc_id = 0"))
    right = syncmers.fingerprints(df.filter("doc_id = 1"))
    top = syncmers.shared_passages(left, right).orderBy(F.desc("n_anchors")).first()
    assert top["shift"] == -11 and top.n_anchors > 20


def test_awkward_rows(spark, awkward, empty):
    rows = syncmers.edited_pairs(awkward).collect()
    assert len(rows) == awkward.count()
    same = [r for r in rows if r.doc_id in (8, 9)]
    assert same[0].fingerprint == same[1].fingerprint != ""
    assert all(r.fingerprint == "" for r in rows if r.doc_id in (0, 1, 2))
    assert syncmers.edited_pairs(empty).count() == 0
    single = spark.createDataFrame([(4, "only one text here")], "doc_id long, text string")
    check(syncmers.edited_pairs(single).collect(), [(4, "only one text here")])


def test_no_python_on_the_main_path(documents, capsys):
    syncmers.edited_pairs(documents).explain()
    assert not any(w in capsys.readouterr().out for w in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("a, b, want", [([], [], 1.0), ([1, 2], [1, 2], 1.0), ([1, 2], [3], 0.0),
                                        ([1, 2, 3], [2, 3, 4], 0.5)])
def test_likeness(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a array<int>, b array<int>")
    assert df.select(syncmers.likeness(F.col("a"), F.col("b")).alias("x")).first().x == want


def test_texts_of_four_words_have_fingerprints_of_their_own(spark):
    rows = [(i, f"one{i} two{i * 3} three{i * 7} four{i * 11}") for i in range(60)]
    rows += [(60 + i, f"{i:02d}" * 30) for i in range(20)]       # one long word, cut into four
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [r.fingerprint for r in syncmers.fingerprints(df).collect()]
    assert "" not in found and len(set(found)) == len(rows)
    assert all(r.near_next == 0 for r in syncmers.edited_pairs(df).collect())
