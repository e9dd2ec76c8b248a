"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Only lengths matter to a packing, and no piece is longer than a sequence, so the whole corpus is
planned from one count per length.  A bin is filled greedily, longest piece first; then its
smallest piece gives way to the two unpacked pieces that fit the expanded gap most tightly, if they
fit it better.  Bins that come out alike are planned at once, as one pattern and how often it is
used, which gives the same bins as one after the other.  A piece then needs its rank among the
pieces of its length, and the plan says which sequence and place that rank has.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Collection, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zonepulse.llm.tables import written

TOKENIZER_FILE = public_tokenizers.path("word_bpe_49k.json")
SEQUENCE_TOKENS = 2048
# The id that ends every document.
END_ID = 0

# A character that no text between blanks shares a token with: it stands between strings that are
# encoded at once.  Strings that hold it are encoded alone.
_MARK = "\x1f"
# What the tokenizer takes as one word in a lower-case ASCII string without blanks or apostrophes.
_WORDS = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+")
# Fixed value: the suffix of tokens that end a word.
_WORD_END = "</w>"
# Strings of which a worker remembers the ids, per generation, and the longest of them.
CACHE_ENTRIES = 400_000
_CACHED_CHARS = 48
# Documents encoded between two batches of output rows.
_SLICE = 2048


class _Memory:
    """Ids of strings in two generations: when the newer one is full, the older one is forgotten."""

    def __init__(self, entries: int):
        self._entries = entries
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def known(self, strings: Collection[str]) -> dict[str, bytes]:
        """What is remembered of ``strings``; what was about to be forgotten is kept on."""
        newer, older = self.newer.get, self.older.get
        found = {s: ids for s in strings if (ids := newer(s))}
        if len(found) < len(strings) and self.older:
            again = {s: ids for s in strings if s not in found and (ids := older(s))}
            self.newer |= again
            found |= again
        return found

    def keep(self, new: dict[str, bytes]) -> None:
        if len(self.newer) >= self._entries:
            self.newer, self.older = {}, self.newer
        self.newer.update((s, ids) for s, ids in new.items() if len(s) <= _CACHED_CHARS)


class Encoder:
    """Ids of whole texts, four little-endian bytes each.

    The tokenizer never looks across blanks, so what stands between them is encoded once and
    remembered, and so are the words that ASCII strings are made of.  What is new comes to the
    tokenizer many strings at a time.
    """

    def __init__(self, tokenizer_file: str, cache_entries: int = CACHE_ENTRIES):
        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        (self._mark,) = self._ids(_MARK)
        vocabulary = self._tokenizer.get_vocab()
        self._ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends_word[[i for t, i in vocabulary.items() if t.endswith(_WORD_END)]] = True
        self._strings, self._words = _Memory(cache_entries), _Memory(cache_entries)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    @staticmethod
    def _cut(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        data = ids.tobytes()
        return [data[i:j] for i, j in zip((4 * starts).tolist(), (4 * ends).tolist(), strict=True)]

    def _of_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of ASCII words: each ends with the only token of its that can end a word."""
        if not words:
            return {}
        ids = self._ids(" ".join(words))
        ends = np.flatnonzero(self._ends_word[ids]) + 1
        return dict(zip(words, self._cut(ids, np.concatenate([[0], ends[:-1]]), ends), strict=True))

    def _of_any(self, strings: list[str]) -> dict[str, bytes]:
        """Ids of strings without blanks."""
        alone = {s: self._ids(s).tobytes() for s in strings if _MARK in s}
        together = [s for s in strings if _MARK not in s]
        if not together:
            return alone
        ids = self._ids(f" {_MARK} ".join(together))
        marks = np.flatnonzero(ids == self._mark)
        found = self._cut(ids, np.concatenate([[0], marks + 1]), np.concatenate([marks, [ids.size]]))
        return alone | dict(zip(together, found, strict=True))

    def _of_strings(self, strings: list[str]) -> list[bytes]:
        """Ids of distinct strings without blanks, by what is remembered where it can be."""
        here = self._strings.known(strings)
        worded, others = {}, []
        for s in strings:
            if s not in here:
                if s.isascii() and "'" not in s:
                    worded[s] = _WORDS.findall(s.lower())
                else:
                    others.append(s)
        needed = set(chain.from_iterable(worded.values()))
        words = self._words.known(needed)
        new_words = self._of_words([w for w in needed if w not in words])
        words |= new_words
        new = {s: b"".join(map(words.__getitem__, w)) for s, w in worded.items()}
        new |= self._of_any(others)
        here |= new
        self._words.keep(new_words)
        self._strings.keep(new)
        return list(map(here.__getitem__, strings))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; none for null and empty ones."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        strings = split.flatten().dictionary_encode()
        ids = pa.array(self._of_strings(strings.dictionary.to_pylist()), pa.large_binary())
        taken = ids.take(strings.indices)
        _, offsets, data = taken.buffers()
        ends = np.frombuffer(offsets, np.int64)[taken.offset:taken.offset + len(taken) + 1]
        of_text = split.offsets.to_numpy() - split.offsets[0].as_py()
        whole = memoryview(data or b"")
        return [bytes(whole[i:j]) for i, j in pairwise(ends[of_text].tolist())]


@lru_cache(maxsize=2)
def _encoder(tokenizer_file: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(tokenizer_file)


def document_ids(texts: pa.Array, tokenizer_file: str = TOKENIZER_FILE) -> list[bytes]:
    """Per text its ids and the end id, four little-endian bytes each."""
    end = END_ID.to_bytes(4, "little")
    return [ids + end for ids in _encoder(tokenizer_file).encode(texts)]


def pieces(docs: DataFrame, capacity: int = SEQUENCE_TOKENS, with_ids: bool = False,
           tokenizer_file: str = TOKENIZER_FILE) -> DataFrame:
    """Every document's pieces: ``doc_id, piece, start, length, ids_crc32``, and ``ids`` if asked.

    Documents longer than ``capacity`` are cut, others are one piece.  ``task`` and ``nth`` place a
    piece among those of its length: it is the ``nth`` one of its task.
    """
    def out(rows: list[tuple], ids: list[bytes], kind: pa.DataType) -> pa.RecordBatch:
        kinds = (kind, *[pa.int64()] * 4, pa.int32(), pa.int64())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
        if with_ids:
            columns.append(pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids],
                                    pa.list_(pa.int32())))
            names.append("ids")
        columns[1] = columns[1].cast(pa.int32())
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for first in range(0, batch.num_rows, _SLICE):
                part = batch.slice(first, _SLICE)
                rows, kept = [], []
                for doc_id, ids in zip(part["doc_id"].to_pylist(),
                                       document_ids(part["text"], tokenizer_file), strict=True):
                    for n, start in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[start:start + 4 * capacity]
                        length = len(cut) // 4
                        rows.append((doc_id, n, start // 4, length, zlib.crc32(cut), task, seen[length]))
                        seen[length] += 1
                        kept.append(cut if with_ids else b"")
                yield out(rows, kept, part.schema.field("doc_id").type)

    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, "
              "length long, ids_crc32 long, task int, nth long")
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, schema + (", ids array<int>" if with_ids else ""))


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences that hold pieces of these lengths, longest first."""

    lengths: tuple[int, ...]
    times: int


def _tightest_pair(lengths: list[int], counts: Mapping[int, int], limit: int) -> tuple[int, int] | None:
    """The two available pieces with the greatest sum up to ``limit``; of equal sums the one with
    the longest piece."""
    some = np.array(lengths[:bisect_right(lengths, limit)])
    if not some.size:
        return None
    partner = np.searchsorted(some, limit - some, side="right") - 1
    single = np.array([counts[int(n)] < 2 for n in some])
    partner = np.where((partner == np.arange(some.size)) & single, partner - 1, partner)
    sums = np.where(partner >= 0, some + some[partner], -1)
    best = int(sums.size - 1 - sums[::-1].argmax())
    return None if sums[best] < 0 else (int(some[best]), int(some[partner[best]]))


def best_two_fit(counts: Mapping[int, int], capacity: int = SEQUENCE_TOKENS) -> list[Pattern]:
    """Plan all pieces, given how many there are of each length.

    There are at most ``capacity`` lengths.  A pattern is used until one of its lengths has fewer
    pieces left than the next bin would take, which happens to a length ``n`` at most about
    ``capacity / n`` times, so the plan has at most about ``capacity * ln(capacity)`` patterns
    however many pieces there are.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    lengths, plan = sorted(left), []

    def take(n: int) -> None:
        left[n] -= 1
        if not left[n]:
            del left[n]
            lengths.pop(bisect_right(lengths, n) - 1)

    def put_back(n: int, many: int = 1) -> None:
        if n not in left:
            insort(lengths, n)
            left[n] = 0
        left[n] += many

    while lengths:
        filled, room = [], capacity
        while at := bisect_right(lengths, room):
            n = lengths[at - 1]
            filled.append(n)
            take(n)
            room -= n
        greedy, smallest = Counter(filled), filled[-1]
        if len(filled) > 1 and room:
            pair = _tightest_pair(lengths, left, room + smallest)
            if pair and sum(pair) > smallest:
                filled.pop()
                filled += pair
                for n in pair:
                    take(n)
                put_back(smallest)
        final = Counter(filled)
        # The same bin comes next as long as every length that the two steps look at is left.
        more = min((left.get(n, 0) + final[n] - max(greedy[n], final[n])) // final[n] for n in final)
        for n, each in final.items():
            for _ in range(min(1, more)):
                left[n] -= each * more
                if not left[n]:
                    del left[n]
                    lengths.pop(bisect_right(lengths, n) - 1)
        plan.append(Pattern(tuple(sorted(filled, reverse=True)), 1 + more))
    return plan


@dataclass(frozen=True)
class _Slots:
    """Where the pieces of one length go, by rank: the runs of slots that the patterns have for them."""

    first_rank: np.ndarray
    per_sequence: np.ndarray
    first_sequence: np.ndarray
    offset: np.ndarray


def _slots(plan: list[Pattern]) -> dict[int, _Slots]:
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for pattern in plan:
        offset = 0
        for n, each in Counter(pattern.lengths).items():
            runs.setdefault(n, []).append((used[n], each, sequence, offset))
            used[n] += each * pattern.times
            offset += n * each
        sequence += pattern.times
    return {n: _Slots(*np.array(r, np.int64).T) for n, r in runs.items()}


def pack(docs: DataFrame, capacity: int = SEQUENCE_TOKENS, with_ids: bool = False,
         tokenizer_file: str = TOKENIZER_FILE) -> DataFrame:
    """Every piece of every document with the sequence it is packed into and its place there.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).  A sequence has
    no gaps and at most ``capacity`` tokens.  Null and empty texts are one piece of the end id;
    repeated rows are packed each; null ids stay null; an empty table gives no rows; columns other
    than ``doc_id`` and ``text`` are not looked at.  Pieces of one length are alike to the plan, so
    ties are settled by the order in which the table is read.

    Texts are encoded once and the pieces written.  The driver gets one count per length.  Ranks
    need no sort: a piece's rank is its number within its task plus the counts of the tasks before.
    """
    spark = docs.sparkSession
    found = written(pieces(docs, capacity, with_ids, tokenizer_file), "pieces")
    here = written(found.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = {r["length"]: r["n"] for r in here.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(best_two_fit(totals, capacity)))
    by_length = Window.partitionBy("length").orderBy("task")
    before = here.select("length", "task", (F.sum("n").over(by_length) - F.col("n")).alias("before"))
    ranked = found.join(before, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch[c].to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
            order = np.argsort(lengths, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                if not some.size:
                    continue
                length = int(lengths[some[0]])
                s = slots.value[length]
                at = np.searchsorted(s.first_rank, ranks[some], side="right") - 1
                times, copy = np.divmod(ranks[some] - s.first_rank[at], s.per_sequence[at])
                sequence[some] = s.first_sequence[at] + times
                offset[some] = s.offset[at] + copy * length
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in kept], pa.array(sequence), pa.array(offset)],
                [*kept, "sequence_id", "offset"])

    kinds = [f"{c} {ranked.schema[c].dataType.simpleString()}" for c in kept]
    return ranked.select(*kept, "rank").mapInArrow(
        run, ", ".join([*kinds, "sequence_id long", "offset long"]))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, from ``pack(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most a sequence's tokens
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
