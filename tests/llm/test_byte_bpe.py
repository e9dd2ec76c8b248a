from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import AWKWARD
from zonepulse.llm import byte_bpe

RANKS = byte_bpe.read_ranks(byte_bpe.RANK_FILE)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS,
                             special_tokens={})


def test_same_ids_as_the_library(library, documents):
    bpe = byte_bpe.encoder()
    for row in documents.collect():
        ids = bpe.encode(row.text)
        assert ids == library.encode_ordinary(row.text)
        assert bpe.decode(ids) == row.text.encode()


@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text_round_trips(text):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS,
                                special_tokens={})
    bpe = byte_bpe.encoder()
    ids = bpe.encode(text)
    assert ids == library.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


def test_a_full_cache_starts_afresh(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 3)
    bpe = byte_bpe.ByteBpe()
    text = "some words that are more than three and " + "z" * 200
    assert bpe.encode(text) == library.encode_ordinary(text)


def test_awkward_rows(awkward, library):
    rows = byte_bpe.round_trip_digests(awkward).collect()
    assert len(rows) == len(AWKWARD) + 3
    for r in rows:
        if r.doc_id is not None:
            text = AWKWARD[r.doc_id] or ""
            ids = library.encode_ordinary(text)
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_ids_and_bytes(awkward, empty):
    encoded = byte_bpe.encode_documents(awkward)
    data = sorted(bytes(r.data) for r in byte_bpe.decode_documents(encoded).collect())
    assert data == sorted((r.text or "").encode() for r in awkward.collect())
    assert all(r.exact for r in byte_bpe.encode_checked(awkward).collect())
    assert byte_bpe.round_trip_digests(empty).count() == 0


def test_a_vocabulary_needs_all_bytes(tmp_path):
    path = tmp_path / "ranks"
    path.write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        byte_bpe.ByteBpe(str(path))
