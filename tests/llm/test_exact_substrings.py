from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonepulse.llm import exact_substrings as E
from zonepulse.llm.suffixes import suffix_array


@given(st.lists(st.integers(0, 3), max_size=60))
@settings(max_examples=400)
def test_suffix_array(text):
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("text", ["a" * 50, "ab" * 40, "abcabcabd" * 9, "zyx" * 5, "mississippi"])
def test_suffix_array_of_periodic_texts(text):
    codes = [ord(c) for c in text]
    assert suffix_array(codes) == sorted(range(len(codes)), key=lambda i: codes[i:])


def slow(docs):
    """``(n_bytes, n_removed, n_spans, kept_sha256)`` of texts in order."""
    seen, out = set(), []
    for text in docs:
        data = text.encode()
        gone = bytearray(len(data))
        own = [data[i:i + 100] for i in range(len(data) - 99)]
        for i, s in enumerate(own):
            if s in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(df, docs):
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
            for r in E.without_repeats(df).collect()}
    for (doc_id, _), want in zip(docs, slow([t for _, t in docs]), strict=True):
        assert rows[doc_id] == want, doc_id
    assert len(rows) == len(docs)


def corpus(seed):
    rng = random.Random(seed)

    def words(n, vocabulary):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    many = [f"w{i}x" for i in range(500)]
    few = ["aa", "b", "ab", "é"]
    line = words(30, many)
    texts = []
    for i in range(160):
        kind = i % 8
        if kind == 0 and texts:
            texts.append(rng.choice(texts))
        elif kind == 1 and texts:
            t = rng.choice(texts)
            k = rng.randrange(len(t) + 1)
            texts.append(t[:k] + rng.choice(["", "Q", "new words"]) + t[k + 1:])
        elif kind in (2, 3, 4):
            texts.append(words(rng.randrange(40), many) + " " + line + " " + words(rng.randrange(40), many))
        elif kind == 5:
            texts.append(words(rng.randrange(200), few))
        elif kind == 6:
            texts.append(rng.choice("ab") * rng.randrange(400) + words(5, many))
        else:
            texts.append(words(rng.randrange(60), many))
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, frequent, array_bytes, most", [
    (1, 50, 1 << 15, 1 << 20),      # as in production
    (2, 4, 1 << 15, 1 << 20),       # many anchors count as frequent
    (3, 50, 20, 1 << 20),           # a suffix array per step
    (4, 50, 1 << 15, 50),           # steps too large for a suffix array
])
def test_against_brute_force(spark, monkeypatch, seed, frequent, array_bytes, most):
    monkeypatch.setattr(E, "FREQUENT_RUNS", frequent)
    monkeypatch.setattr(E, "ARRAY_SYMBOLS", array_bytes)
    monkeypatch.setattr(E, "MOST_SYMBOLS", most)
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    check(df, docs)


def test_texts_longer_than_a_slice(spark, monkeypatch):
    monkeypatch.setattr(E, "SLICE_BYTES", 700)
    docs = corpus(6)
    check(spark.createDataFrame(docs, "doc_id long, text string"), docs)


def test_pieces_of_long_texts_cover_each_start_once(monkeypatch):
    monkeypatch.setattr(E, "SLICE_BYTES", 50)
    rng = random.Random(1)
    text = bytes(rng.randrange(256) for _ in range(1000))
    starts = []
    for numbers, offsets, parts in E._sliced([text, b"short", b""]):
        for number, offset, part in zip(numbers, offsets, parts, strict=True):
            starts += [(number, offset + i) for i in range(max(0, len(part) - 99))]
    assert sorted(starts) == [(0, i) for i in range(901)]


def test_awkward_rows(spark, empty):
    long = "some text that is long enough to be removed when it comes again, " * 4
    rows = [(3, long, "x"), (None, long, "y"), (1, None, "z"), (2, "", None), (5, "short", "a"),
            (3, long, "x"), (4, "tail " + long, "b"), (3, "other " + long, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string")
    out = E.without_repeats(df).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    # The null id comes first; its own text repeats every 65 bytes.
    assert by[None][0].n_removed == len(long) - 65
    assert all(r.n_removed >= len(long) - 100 for r in by[3]) and len(by[3]) == 3
    assert by[1][0].n_bytes == by[2][0].n_bytes == by[5][0].n_removed == 0
    assert bytes(by[4][0].kept).startswith(b"tail")
    assert E.without_repeats(empty).count() == 0


@pytest.mark.parametrize("frequent", [50, 1])
def test_rows_that_repeat_id_and_text_are_one_text(spark, monkeypatch, frequent):
    monkeypatch.setattr(E, "FREQUENT_RUNS", frequent)
    one, two = (" ".join(f"{w}{i * i}" for i in range(60)) for w in "ab")
    mixed = one[:150] + two[150:]
    rows = [(1, one), (1, one), (2, two), (None, "null " + mixed), (None, "null " + mixed), (1, one)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {}
    for r in E.without_repeats(df).collect():
        found.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    want = dict(zip([None, 1, 2], slow(["null " + mixed, one, two]), strict=True))
    assert want[None][1] == 0 and 0 < want[1][1] < len(one)
    assert {d: len(f) for d, f in found.items()} == {None: 2, 1: 3, 2: 1}
    assert all(set(f) == {want[d]} for d, f in found.items())
