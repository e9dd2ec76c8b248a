from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import AWKWARD, SF_DIR
from zonepulse.llm import packing
from zonepulse.llm.queries import QUERIES


_TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
_TOKENIZER.encode_special_tokens = True


def library_ids(text):
    return [*_TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def one_by_one(lengths, capacity):
    """Best-two-fit bin after bin over a plain list."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        filled, room = [], capacity
        for n in list(left):
            if n <= room:
                filled.append(n)
                left.remove(n)
                room -= n
        if len(filled) > 1 and room:
            limit = room + filled[-1]
            pairs = [(left[i] + left[j], max(left[i], left[j])) for i in range(len(left))
                     for j in range(i) if left[i] + left[j] <= limit]
            total, longest = max(pairs, default=(0, 0))
            if total > filled[-1]:
                left.append(filled.pop())
                for n in (longest, total - longest):
                    filled.append(n)
                    left.remove(n)
                left.sort(reverse=True)
        bins.append(tuple(sorted(filled, reverse=True)))
    return bins


@given(st.lists(st.integers(1, 24), max_size=80), st.integers(24, 40))
@settings(max_examples=300, deadline=None)
def test_patterns_are_the_bins_of_one_after_the_other(lengths, capacity):
    plan = packing.best_two_fit(Counter(lengths), capacity)
    bins = [p.lengths for p in plan for _ in range(p.times)]
    assert bins == one_by_one(lengths, capacity)


def test_two_fit_beats_the_greedy_bin():
    # Greedy: 6 + 3, gap 1; the pair 2 + 2 fits the gap left by the 3 exactly.
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10) == [
        packing.Pattern((6, 2, 2), 1), packing.Pattern((3,), 1)]


def test_a_plan_does_not_grow_with_the_corpus():
    rng = random.Random(5)
    for scale in (10 ** 3, 10 ** 9, 10 ** 12):
        counts = {n: rng.randrange(1, scale) for n in range(1, 2049)}
        plan = packing.best_two_fit(counts)
        held = Counter()
        for p in plan:
            assert sum(p.lengths) <= 2048
            for n in p.lengths:
                held[n] += p.times
        assert held == counts and len(plan) < 2048 * 8
        tokens = sum(n * c for n, c in counts.items())
        assert sum(p.times for p in plan) <= 1.01 * -(-tokens // 2048) + 2


def test_lengths_out_of_range_are_refused():
    with pytest.raises(ValueError):
        packing.best_two_fit({11: 1}, 10)
    assert packing.best_two_fit({}, 10) == []


@given(st.lists(st.none() | st.text(st.characters(exclude_categories=["Cs"])
                                    | st.sampled_from(" \t\n\x0b\x1f'sé\u0301"), max_size=40), max_size=6))
@settings(max_examples=300, deadline=None)
def test_any_texts_have_the_ids_of_the_library(texts):
    whole = pa.array([None, *texts], pa.string())
    got = packing.document_ids(whole.slice(1))
    assert [np.frombuffer(i, "<u4").tolist() for i in got] == [library_ids(t) for t in texts]


@given(st.lists(st.text(st.characters(max_codepoint=127), max_size=30), max_size=6))
@settings(max_examples=300, deadline=None)
def test_ascii_texts_have_the_ids_of_the_library(texts):
    got = packing.document_ids(pa.array(texts, pa.string()))
    assert [np.frombuffer(i, "<u4").tolist() for i in got] == [library_ids(t) for t in texts]


def test_special_strings_are_text():
    got = packing.document_ids(pa.array(["a<|endoftext|> <|startoftext|>"]))
    assert np.frombuffer(got[0], "<u4").tolist() == library_ids("a<|endoftext|> <|startoftext|>")


def check(rows, texts, capacity):
    """``rows`` are a sound packing of all pieces of ``texts`` (id and text pairs)."""
    want = Counter()
    for i, text in texts:
        ids = library_ids(text)
        for n, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start:start + capacity]
            want[i, n, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return held


def test_query_against_plain_packing(spark, documents):
    rows = QUERIES["op11_best_two_fit"](spark, SF_DIR).collect()
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    held = check(rows, texts, 2048)
    lengths = [r.length for r in rows]
    assert len(held) == len(one_by_one(lengths, 2048))
    assert len(held) <= 1.02 * -(-sum(lengths) // 2048) + 1


@pytest.mark.parametrize("capacity", [1, 7, 2048])
def test_awkward_rows(awkward, empty, capacity):
    df = awkward.repartition(5).withColumnsRenamed({"fp": "piece", "key": "sequence_id"})
    packed = packing.pack(df, capacity, with_ids=True)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids",
                              "sequence_id", "offset"]
    rows = packed.collect()
    texts = [(r.doc_id, r.text) for r in awkward.collect()]
    held = check(rows, texts, capacity)
    assert len(held) == len(one_by_one([r.length for r in rows], capacity))
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert whole.keys() == held.keys()
    for r in rows:
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids
    assert packing.pack(empty).count() == 0


def test_a_full_memory_starts_afresh():
    encoder = packing.Encoder(packing.TOKENIZER_FILE, cache_entries=2)
    for text in ["one two three", "z" * 100 + " one", "four five six", "one two", "seven"] * 2:
        (ids,) = encoder.encode(pa.array([text]))
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)[:-1]
    assert len(encoder._strings.newer) <= 5 and len(encoder._words.older) <= 5
