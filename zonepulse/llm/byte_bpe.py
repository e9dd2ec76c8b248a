"""Byte-level BPE through a sentencepiece model that is written down from the vocabulary.

A rank file lists byte strings and their merge ranks.  Every byte string becomes a piece (each
byte shifted to a character of its own, so that any bytes are valid text) with the negative rank as
score, behind an identity normaliser.  sentencepiece then merges the best-scored pair first, which
is the lowest rank first.  Texts are cut into pre-tokens, each encoded by itself; decoding looks the
bytes of every id up again.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

# Fixed values of the model file format: field numbers and enum values.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_TYPE_NORMAL, _TYPE_UNKNOWN = 1, 2
_MODEL_TYPE, _MODEL_TYPE_BPE, _VOCAB_SIZE = 3, 2, 4
_UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 40, 41, 42, 43
_NORMALIZER_NAME, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES = 1, 3, 4, 5

# Characters that stand for the bytes 0 to 255.
_SHIFT = 0x100
_TO_CHARS = {b: _SHIFT + b for b in range(256)}

# Pre-tokens a worker remembers before it starts afresh, and the longest one worth remembering.
CACHE_ENTRIES = 300_000
CACHE_CHARS = 64


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def as_chars(data: bytes) -> str:
    """Bytes as text with one character per byte."""
    return data.decode("latin-1").translate(_TO_CHARS)


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: base64 byte strings with their ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model with the given vocabulary; piece i has the i-th rank."""
    pieces = [
        _block(_PIECE, as_chars(token).encode()) + _varint(_SCORE << 3 | 5)
        + struct.pack("<f", -float(rank)) + _number(_TYPE, _TYPE_NORMAL)
        for token, rank in sorted(ranks.items(), key=lambda item: item[1])
    ]
    unknown = _block(_PIECE, b"<unk>") + _varint(_SCORE << 3 | 5) + struct.pack(
        "<f", 0.0) + _number(_TYPE, _TYPE_UNKNOWN)
    trainer = (_number(_MODEL_TYPE, _MODEL_TYPE_BPE) + _number(_VOCAB_SIZE, len(pieces) + 1)
               + _number(_UNK_ID, len(pieces))
               + b"".join(_number(f, -1) for f in (_BOS_ID, _EOS_ID, _PAD_ID)))
    normalizer = _block(_NORMALIZER_NAME, b"identity") + b"".join(
        _number(f, 0) for f in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES))
    return (b"".join(_block(_PIECES, p) for p in [*pieces, unknown])
            + _block(_TRAINER, trainer) + _block(_NORMALIZER, normalizer))


class _PreTokens(dict):
    """Ids of the pre-tokens a worker has met; starts afresh when full."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, pre_token: str) -> tuple[int, ...]:
        ids = self._encode(pre_token)
        if len(pre_token) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[pre_token] = ids
        return ids


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, rank_file: str = RANK_FILE, pattern: str = public_tokenizers.PATTERN):
        ranks = read_ranks(rank_file)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the single bytes {missing}")
        self._ranks = ranks
        self._by_piece = sorted(ranks.values())
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._find = regex.compile(pattern).findall
        self._model = sentencepiece.SentencePieceProcessor()
        self._model.LoadFromSerializedProto(model_bytes(ranks))
        self._cache = _PreTokens(self._encode_one)

    def _encode_one(self, pre_token: str) -> tuple[int, ...]:
        """A pre-token that is itself in the vocabulary is its own id, else pieces are merged."""
        data = pre_token.encode()
        rank = self._ranks.get(data)
        if rank is not None:
            return (rank,)
        return tuple(self._by_piece[i] for i in self._model.EncodeAsIds(as_chars(data)))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; none for a null or empty one."""
        if not text:
            return []
        return list(chain.from_iterable(map(self._cache.__getitem__, self._find(text))))

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids, in order."""
        return b"".join(map(self._bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(rank_file: str = RANK_FILE, pattern: str = public_tokenizers.PATTERN) -> ByteBpe:
    """One encoder per worker process."""
    return ByteBpe(rank_file, pattern)


def encode_documents(docs: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """``doc_id`` and the token ids of every whole text.

    Null and empty texts give no ids, repeated rows give a row each, null ids stay null, an empty
    table gives no rows, and columns other than ``doc_id`` and ``text`` are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(rank_file)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [bpe.encode(t.as_py()) for t in part["text"]]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def encode_checked(docs: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """``doc_id, n_tokens, ids, exact``: the ids, and whether they decode to the text's very bytes.

    Edge cases are those of ``encode_documents``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(rank_file)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [t.as_py() or "" for t in part["text"]]
                ids = [bpe.encode(t) for t in texts]
                exact = [bpe.decode(i) == t.encode() for i, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([len(i) for i in ids], pa.int64()),
                     pa.array(ids, pa.list_(pa.int32())), pa.array(exact, pa.bool_())],
                    ["doc_id", "n_tokens", "ids", "exact"])

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
             "ids array<int>, exact boolean")


def decode_documents(encoded: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """``doc_id`` and the bytes that ``ids`` stand for; null ids give no bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(rank_file)
        for batch in batches:
            data = [bpe.decode(ids.as_py() or []) for ids in batch["ids"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, data binary")


def round_trip_digests(docs: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """Encode every text, decode its ids, and give counts and SHA-256 digests of both.

    Digests are taken beside the encoder, so that neither ids nor bytes travel.  The ids are hashed
    as decimals joined by commas.  Edge cases are those of ``encode_documents``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(rank_file)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for text in batch["text"]:
                ids = bpe.encode(text.as_py())
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
             "ids_sha256 string, decoded_sha256 string")
