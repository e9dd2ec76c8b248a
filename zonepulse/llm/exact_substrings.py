"""Removal of long byte strings that occurred before, over a whole corpus.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts earlier.  Strings are
found by anchors: of the 32-byte grams in such a string the one with the least hash.  Neighbouring
strings share an anchor, so an anchor stands for a run of string starts, and equal strings have
equal anchors at equal places.

1. Each task finds the runs of its texts.  A run is known by two hashes: of its anchor, and of all
   bytes that its strings cover.  Of equal runs in a task only the earliest is passed on.
2. Runs are dealt out by the anchor's hash.  Of equal runs all but the earliest are repeats as a
   whole.  Where an anchor stands in runs that differ, the earliest of each are compared by bytes.
3. Those are dealt out with their bytes and narrowed down in steps of nine starts: a step whose
   common bytes occur once holds no repeat, equal steps are settled at once, and for the rest a
   suffix array, built by linear grouping, brings equal strings next to each other.

An anchor may be very frequent with ever different surroundings (a line that many texts share).
Anchors frequent in a bounded sample are dealt out by both hashes, and their steps, and strings
where steps differ, one by one by hashes of their own; the sample decides about the way only, not
about the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.suffixes import suffix_array
from zonepulse.llm.tables import written

LENGTH = 100
GRAM = 32
# Starts per step, when runs are narrowed down, and bytes that all strings of a step cover.
STEP = 9
CORE = LENGTH - STEP + 1
# Bytes handled at once in a task, and symbols in one suffix array; common bytes that more symbols
# than the last number hang on are settled by hashes of their strings.
SLICE_BYTES = 1 << 20
ARRAY_SYMBOLS, MOST_SYMBOLS = 1 << 14, 1 << 18
# Documents in the sample for frequent anchors, and when an anchor is frequent: both must hold.
SAMPLE_DOCS, FREQUENT_RUNS, FREQUENT_SHARE = 20_000, 100, 0.01

_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_LOW32 = np.uint64(0xFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a hash: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse modulo 2^64, kept per worker."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.ones(n, np.uint64)
            table[1:] = base
            _POWERS[name] = np.multiply.accumulate(table)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class _Hashed:
    """Hashes of any parts of a byte buffer, from running sums."""

    def __init__(self, data: np.ndarray):
        up, self._down = _powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:-1], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        value = (self._sums[end] - self._sums[start]) * self._down[start]
        length = (end - start).astype(np.uint64)
        return _mixed(value + _mixed(length * np.uint64(1000003) + np.asarray(salt, np.uint64)))


def _least_positions(hashes: np.ndarray, width: int) -> np.ndarray:
    """Position of the least hash in every window; the leftmost of equal ones."""
    value = (hashes & ~_LOW32) | np.arange(len(hashes), dtype=np.uint64)
    n, size = len(hashes) - width + 1, 1
    while size * 2 <= width:
        value = np.minimum(value[:-size], value[size:])
        size *= 2
    if size < width:
        value = np.minimum(value[:n], value[width - size:width - size + n])
    return (value & _LOW32).astype(np.int64)


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of string starts with a common anchor: ``text, h, c, first, last, anchor``.

    Positions count within a text; ``h`` and ``c`` are the hashes of the anchor and of the bytes
    that the run covers.
    """
    empty = (np.zeros(0, np.int64),) * 6
    sizes = np.array([len(t) for t in texts], np.int64)
    if not len(texts) or sizes.sum() < LENGTH:
        return empty
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    hashed = _Hashed(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = hashed.of(at, at + GRAM)
    anchor = _least_positions(grams, LENGTH - GRAM + 1)
    inside = np.ones(len(anchor), bool)
    for end in ends[:-1].tolist():
        inside[max(0, end - LENGTH + 1):end] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return empty
    own = anchor[starts]
    new = np.append(True, (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1))
    first = starts[new]
    last = starts[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]
    p = own[new]
    c = hashed.of(first, last + LENGTH, p - first)
    text = np.searchsorted(ends, first, side="right")
    base = (ends - sizes)[text]
    return text, grams[p].view(np.int64), c.view(np.int64), first - base, last - base, p - base


def _sliced(texts: Iterable[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in slices of bounded size: their numbers, the offsets of their parts, the parts.

    A text longer than a slice is cut into parts that overlap, so that each start is in one part.
    """
    numbers: list[int] = []
    offsets: list[int] = []
    parts: list[bytes] = []
    held = 0
    for k, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - LENGTH + 1), SLICE_BYTES):
            part = text[offset:offset + SLICE_BYTES + LENGTH - 1]
            if held and held + len(part) > SLICE_BYTES + LENGTH:
                yield numbers, offsets, parts
                numbers, offsets, parts, held = [], [], [], 0
            numbers.append(k)
            offsets.append(offset)
            parts.append(part)
            held += len(part)
    if parts:
        yield numbers, offsets, parts


def _packed(first: np.ndarray, last: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """A run's place in one number; the order of numbers is that of the starts."""
    return (first << 16) | ((anchor - first) << 8) | (last - first)


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = place >> 16
    return first, first + (place & 255), first + ((place >> 8) & 255)


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """``doc`` with nulls as the least number, and ``tie``."""
    doc = batch["doc"].fill_null(np.iinfo(np.int64).min).to_numpy()
    return doc, batch["tie"].to_numpy()


def _doc_array(doc: np.ndarray) -> pa.Array:
    return pa.array(doc, mask=doc == np.iinfo(np.int64).min)


_RUN_FIELDS = "h long, c long, doc long, tie long, place long, frequent boolean"


def _runs(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Runs of all texts.  ``h`` is null for a run that repeats an earlier one of the same task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie = _keys(batch)
            for numbers, offsets, parts in _sliced(t.as_py().encode() for t in batch["text"]):
                text, h, c, first, last, anchor = runs_of(parts)
                if not len(text):
                    continue
                shift = np.array(offsets)[text]
                row = np.array(numbers)[text]
                place = _packed(first + shift, last + shift, anchor + shift)
                order = np.lexsort((place, tie[row], doc[row], c, h))
                h, c, row, place = h[order], c[order], row[order], place[order]
                again = np.append(False, (h[1:] == h[:-1]) & (c[1:] == c[:-1]))
                hot = np.isin(h, frequent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, mask=again), pa.array(c), _doc_array(doc[row]),
                     pa.array(tie[row]), pa.array(place), pa.array(hot)],
                    ["h", "c", "doc", "tie", "place", "frequent"])

    return docs.select("doc", "tie", "text").mapInArrow(run, _RUN_FIELDS)


def _frequent(docs: DataFrame) -> np.ndarray:
    """Anchors that stand in many different runs of a sample; at most a few ten thousand."""
    n = docs.count()
    span = 1 << 30
    share = min(1.0, SAMPLE_DOCS / max(1, n))
    sample = docs.filter(F.pmod(F.xxhash64("doc", "tie"), F.lit(span)) < int(share * span))
    least = max(FREQUENT_RUNS, int(FREQUENT_SHARE * share * n))
    found = (_runs(sample, np.zeros(0, np.int64)).filter(F.col("h").isNotNull())
             .groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
             .select("h").collect())
    return np.array(sorted(r.h for r in found), np.int64)


_FOUND_FIELDS = "h long, doc long, tie long, place long, frequent boolean, repeat boolean"


def _settled(runs: DataFrame) -> DataFrame:
    """Repeats of equal runs, and the first of each kind of run where an anchor has several.

    Rows are seen in order, so what is kept from one batch to the next is one row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The only kind of run so far of the last anchor, as long as no second one has been seen.
        waiting: pa.RecordBatch | None = None
        last: tuple[int, int] | None = None

        def out(batch: pa.RecordBatch, repeat: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [batch["h"], batch["doc"], batch["tie"], batch["place"], batch["frequent"],
                 pa.array(repeat)], ["h", "doc", "tie", "place", "frequent", "repeat"])

        for batch in batches:
            known = batch["h"].is_null().to_numpy(zero_copy_only=False)
            if known.any():
                yield out(batch.filter(pa.array(known)), np.ones(known.sum(), bool))
                batch = batch.filter(pa.array(~known))
            if not batch.num_rows:
                continue
            h, c = batch["h"].to_numpy(), batch["c"].to_numpy()
            hot = batch["frequent"].to_numpy(zero_copy_only=False)
            before_h = np.append(last[0] if last else 0, h[:-1])
            before_c = np.append(last[1] if last else 0, c[:-1])
            same_h = h == before_h
            if last is None:
                same_h[0] = False
            repeat = same_h & (c == before_c)
            kind = ~repeat
            # Anchors by number; number 0 is the one left open by the batch before, if it goes on.
            anchor = np.cumsum(~same_h) - (0 if same_h[0] else 1)
            kinds = np.bincount(anchor, weights=kind).astype(int)
            goes_on = bool(same_h[0])
            if goes_on:
                kinds[0] += 1
                if waiting is not None and kinds[0] > 1:
                    yield out(waiting, np.zeros(1, bool))
                    waiting = None
            if not goes_on or anchor[-1] > 0:
                waiting = None
            compare = kind & ((kinds[anchor] > 1) | hot)
            # A lone kind at the batch's end may get company from the next batch.
            lone = np.flatnonzero(kind & ~compare & (anchor == anchor[-1]))
            if len(lone):
                waiting = batch.slice(int(lone[0]), 1)
            last = (int(h[-1]), int(c[-1]))
            chosen = repeat | compare
            if chosen.any():
                yield out(batch.filter(pa.array(chosen)), repeat[chosen])

    by = F.when(F.col("frequent") | F.col("h").isNull(), F.xxhash64("h", "c", F.when(
        F.col("h").isNull(), F.col("place")))).otherwise(F.col("h"))
    return (runs.repartition(by).sortWithinPartitions("h", "c", "doc", "tie", "place")
            .mapInArrow(run, _FOUND_FIELDS))


def _with_bytes(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Runs to compare, with the bytes their strings cover: ``h, doc, tie, place, body``."""
    runs = found.groupBy("doc", "tie").agg(F.collect_list(F.struct("h", "place")).alias("runs"))
    both = docs.join(runs.withColumnsRenamed({"doc": "_doc", "tie": "_tie"}),
                     docs["doc"].eqNullSafe(F.col("_doc")) & (docs["tie"] == F.col("_tie"))
                     ).select("doc", "tie", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie = _keys(batch)
            for k in range(batch.num_rows):
                data = batch["text"][k].as_py().encode()
                runs_ = batch["runs"][k].values
                place = runs_.field("place").to_numpy()
                first, last, _ = _unpacked(place)
                bodies = [data[a:b + LENGTH] for a, b in zip(first.tolist(), last.tolist(),
                                                             strict=True)]
                n = len(bodies)
                yield pa.RecordBatch.from_arrays(
                    [runs_.field("h"), _doc_array(np.full(n, doc[k])), pa.array(np.full(n, tie[k])),
                     pa.array(place), pa.array(bodies, pa.binary())],
                    ["h", "doc", "tie", "place", "body"])

    return both.mapInArrow(run, "h long, doc long, tie long, place long, body binary")


class _Steps:
    """Runs cut into steps of at most nine starts, over one buffer of all their bytes."""

    def __init__(self, rank: np.ndarray, place: np.ndarray, bodies: list[bytes]):
        sizes = np.array([len(b) for b in bodies], np.int64)
        self.data = np.frombuffer(b"".join(bodies), np.uint8)
        self.hashed = _Hashed(self.data)
        base = np.cumsum(sizes) - sizes
        first, last, anchor = _unpacked(place)
        low, high = (anchor - last) // STEP, (anchor - first) // STEP
        count = high - low + 1
        run = np.repeat(np.arange(len(place)), count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[run]
        # Distances from the start to the anchor that belong to the step and to the run.
        most = np.minimum(anchor[run] - first[run], step * STEP + STEP - 1)
        least = np.maximum(anchor[run] - last[run], step * STEP)
        self.run = run
        self.start = base[run] + (anchor - first)[run] - most      # of the first string, in data
        self.count = most - least + 1                              # strings
        self.text_start = anchor[run] - most                       # of the first string, in its text
        self.rank = rank[run]                                      # of the text among all
        self.core_start = base[run] + (anchor - first)[run] - step * STEP
        self.core = self.hashed.of(self.core_start, self.core_start + CORE, step)
        self.whole = self.hashed.of(self.start, self.start + self.count + LENGTH - 1, most)


def _strings_that_repeat(s: _Steps, chosen: np.ndarray) -> np.ndarray:
    """Among the strings of some steps, a mask of those equal to an earlier one, step by step.

    Steps come sorted by their common bytes, which are one symbol of the text whose suffixes are
    sorted.  So a string has ``STEP`` symbols; equal strings are neighbours among the suffixes
    that start one.
    """
    counts = s.count[chosen]
    owner = np.repeat(np.arange(len(chosen)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = s.start[chosen][owner] + offset
    when = (s.rank[chosen][owner].astype(np.int64) << 40) | (s.text_start[chosen][owner] + offset)
    sizes = counts + STEP - 1
    if sizes.sum() > MOST_SYMBOLS:
        key = s.hashed.of(at, at + LENGTH)
        order = np.lexsort((when, key))
        same = np.append(False, key[order][1:] == key[order][:-1])
    else:
        text, begin = _symbols(s, chosen, sizes)
        number = np.full(len(text), -1)
        number[begin[owner] + offset] = np.arange(len(at))
        order = number[np.array(suffix_array(text.tolist()))]
        order = order[order >= 0]
        strings = np.lib.stride_tricks.sliding_window_view(text, STEP)[(begin[owner] + offset)[order]]
        same = np.append(False, (strings[1:] == strings[:-1]).all(axis=1))
    bunch = np.cumsum(~same) - 1
    earliest = np.full(bunch[-1] + 1 if len(bunch) else 0, np.iinfo(np.int64).max)
    np.minimum.at(earliest, bunch, when[order])
    repeats = np.zeros(len(at), bool)
    repeats[order] = when[order] > earliest[bunch]
    return repeats


def _symbols(s: _Steps, chosen: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The steps' bytes, counted from 1, each piece with a 0 behind it; and where pieces begin.

    Common bytes are one symbol above 256, the same for steps whose common bytes are the same.
    """
    ends = np.cumsum(sizes + 1)
    begin = ends - sizes - 1
    before = s.core_start[chosen] - s.start[chosen]
    piece = np.repeat(np.arange(len(chosen)), sizes)
    symbol = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    source = s.start[chosen][piece] + symbol + np.where(symbol > before[piece], CORE - 1, 0)
    text = np.zeros(ends[-1] if len(ends) else 0, np.int64)
    text[begin[piece] + symbol] = s.data[source].astype(np.int64) + 1
    bytes_ = np.lib.stride_tricks.sliding_window_view(s.data, CORE)[s.core_start[chosen]]
    changes = np.append(True, (bytes_[1:] != bytes_[:-1]).any(axis=1))
    text[begin + before] = 256 + np.cumsum(changes)
    return text, begin


def repeats_among(rank: np.ndarray, place: np.ndarray, bodies: list[bytes]
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which strings of some runs equal an earlier one: ``run, first start, last start``.

    ``rank`` orders the texts; ``place`` and ``bodies`` are the runs'.
    """
    s = _Steps(rank, place, bodies)
    when = (s.rank.astype(np.int64) << 40) | s.text_start
    order = np.lexsort((when, s.whole, s.core))
    core, whole = s.core[order], s.whole[order]
    same_core = np.append(False, core[1:] == core[:-1])
    equal = same_core & np.append(False, whole[1:] == whole[:-1])
    out = [(s.run[order[equal]], s.text_start[order[equal]],
            s.text_start[order[equal]] + s.count[order[equal]] - 1)]
    kinds = order[~equal]
    bunch = (np.cumsum(~same_core) - 1)[~equal]
    open_ = np.bincount(bunch)[bunch] > 1 if len(bunch) else np.zeros(0, bool)
    kinds, bunch = kinds[open_], bunch[open_]
    # Steps with equal common bytes go into one suffix array, several of them up to a size.
    cut = np.flatnonzero(np.append(True, bunch[1:] != bunch[:-1])) if len(bunch) else np.zeros(0, int)
    size = np.cumsum(s.count[kinds] + STEP)
    begin = 0
    for k, end in enumerate(np.append(cut[1:], len(kinds)).tolist() if len(cut) else []):
        if end < len(kinds) and size[cut[k + 1]] - (size[begin - 1] if begin else 0) < ARRAY_SYMBOLS:
            continue
        chosen = kinds[begin:end]
        begin = end
        repeats = _strings_that_repeat(s, chosen)
        counts = s.count[chosen]
        owner = np.repeat(np.arange(len(chosen)), counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        owner, offset = owner[repeats], offset[repeats]
        if not len(owner):
            continue
        new = np.append(True, (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1))
        tail = np.append(np.flatnonzero(new)[1:], len(owner)) - 1
        at = s.text_start[chosen]
        out.append((s.run[chosen][owner[new]], at[owner[new]] + offset[new],
                    at[owner[new]] + offset[tail]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


_SPAN_FIELDS = "doc long, tie long, first long, last long"


def _compared(runs: DataFrame) -> DataFrame:
    """Repeats among runs with bytes, anchor by anchor."""
    def solve(rows: pa.RecordBatch) -> pa.RecordBatch:
        doc, tie = _keys(rows)
        order = np.lexsort((tie, doc))
        new = np.append(True, (doc[order][1:] != doc[order][:-1]) | (tie[order][1:] != tie[order][:-1]))
        rank = np.empty(len(doc), np.int64)
        rank[order] = np.cumsum(new)
        run, first, last = repeats_among(rank, rows["place"].to_numpy(), rows["body"].to_pylist())
        return pa.RecordBatch.from_arrays(
            [_doc_array(doc[run]), pa.array(tie[run]), pa.array(first), pa.array(last)],
            ["doc", "tie", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch["h"].to_numpy()
            begin = int(np.searchsorted(h, h[-1]))
            if begin == 0 and held and held[-1]["h"][0].as_py() == h[-1]:
                held.append(batch)
                continue
            whole = [*held, batch.slice(0, begin)]
            held = [batch.slice(begin)]
            table = pa.Table.from_batches(whole).combine_chunks()
            for part in table.to_batches():
                if part.num_rows > 1:
                    yield solve(part)
        if held:
            for part in pa.Table.from_batches(held).combine_chunks().to_batches():
                if part.num_rows > 1:
                    yield solve(part)

    return (runs.repartition("h").sortWithinPartitions("h", "doc", "tie", "place")
            .mapInArrow(run, _SPAN_FIELDS))


def _one_by_one(runs: DataFrame) -> DataFrame:
    """Repeats among the runs of frequent anchors, without a task that sees all of an anchor's.

    Equal steps are settled first.  Where steps with equal common bytes differ, the earliest of
    each kind give their strings, each known by two hashes.  The earliest of equal steps or strings
    is found with partial sums, so that what a third of all texts have is no burden.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, tie = _keys(batch)
            s = _Steps(np.zeros(len(doc), np.int64), batch["place"].to_numpy(),
                       batch["body"].to_pylist())
            owner = np.repeat(np.arange(len(s.run)), s.count)
            begin = np.cumsum(s.count) - s.count
            at = s.start[owner] + np.arange(len(owner)) - begin[owner]
            strings = pa.StructArray.from_arrays(
                [pa.array(s.hashed.of(at, at + LENGTH).view(np.int64)),
                 pa.array(s.hashed.of(at, at + LENGTH // 2, 1).view(np.int64))], ["w1", "w2"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.core.view(np.int64)), pa.array(s.whole.view(np.int64)),
                 _doc_array(doc[s.run]), pa.array(tie[s.run]), pa.array(s.text_start),
                 pa.array(s.count.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(np.append(begin, len(owner)), pa.int32()), strings)],
                ["core", "whole", "doc", "tie", "at", "n", "strings"])

    steps = written(runs.mapInArrow(
        run, "core long, whole long, doc long, tie long, at long, n int, "
             "strings array<struct<w1: long, w2: long>>"), "steps")
    kinds = written(steps.groupBy("core", "whole").agg(
        F.min(F.struct("doc", "tie", "at", "strings")).alias("e"), F.count(F.lit(1)).alias("times")),
        "kinds")
    place = F.struct("doc", "tie", "at")
    again = steps.drop("strings").join(
        kinds.filter("times > 1").select("core", "whole", F.struct("e.doc", "e.tie", "e.at").alias("first")),
        ["core", "whole"]).filter(place > F.col("first")).select(
        "doc", "tie", F.col("at").alias("first"), (F.col("at") + F.col("n") - 1).alias("last"))
    several = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    strings = written(kinds.join(several.select("core"), "core").select(
        "e.doc", "e.tie", "e.at", F.posexplode("e.strings").alias("i", "s")).select(
        "doc", "tie", (F.col("at") + F.col("i")).alias("at"), "s.w1", "s.w2"), "strings")
    first = written(strings.groupBy("w1", "w2").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1").drop("times"), "first-strings")
    single = strings.join(first, ["w1", "w2"]).filter(place > F.col("first")).select(
        "doc", "tie", F.col("at").alias("first"), F.col("at").alias("last"))
    return again.unionByName(single)


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc, tie, text``: the id, and a hash of the text where ids are not unique.

    Once for every row, and once with one row per ``doc, tie``.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    doubled = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter(
        (F.col("n") > 1) | F.col("doc_id").isNull()).limit(1).count()
    tie = F.xxhash64(text) if doubled else F.lit(0).cast("long")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc"), tie.alias("tie"),
                        text.alias("text"))
    # Texts are written once more only where some id repeats.
    return keyed, written(keyed.dropDuplicates(["doc", "tie"]), "texts") if doubled else keyed


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc, tie, first, last``: runs of starts of strings that also start earlier.

    ``docs`` has ``doc, tie, text`` as ``_keyed`` gives them, one row per ``doc, tie``: of two equal
    rows the second would be a repeat of the first, and the spans hold for both.
    """
    found = written(_settled(_runs(docs, _frequent(docs))), "runs")
    whole = found.filter("repeat").select(
        "doc", "tie", F.shiftright("place", 16).alias("first"),
        (F.shiftright("place", 16) + F.col("place").bitwiseAND(F.lit(255))).alias("last"))
    compared = _compared(_with_bytes(docs, found.filter(~F.col("repeat") & ~F.col("frequent"))))
    frequent = _one_by_one(_with_bytes(docs, found.filter(~F.col("repeat") & F.col("frequent"))))
    return whole.unionByName(compared).unionByName(frequent)


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed, and the number of runs they formed."""
    if not spans:
        return data, 0, 0
    out, removed, count, end = [], 0, 0, 0
    begin, stop = None, 0
    for first, last in sorted(spans):
        if begin is not None and first <= stop:
            stop = max(stop, last + LENGTH)
            continue
        if begin is not None:
            out.append(data[end:begin])
            removed, count, end = removed + stop - begin, count + 1, stop
        begin, stop = first, last + LENGTH
    out += [data[end:begin], data[stop:]]
    return b"".join(out), removed + stop - begin, count + 1


def without_repeats(docs: DataFrame, with_bytes: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row; ``kept`` is binary
    and null unless asked for.

    Earlier is by ascending id, null ids first, then by position; texts with equal ids follow each
    other by a hash of the text.  Rows that repeat both id and text are one text: none is removed
    for another, and each gets the same result.  Null texts count as empty, texts under 100 bytes
    lose nothing, an empty table gives no rows, other columns are not looked at.
    """
    keyed, once = _keyed(docs)
    spans = repeated_spans(once).groupBy("doc", "tie").agg(
        F.collect_list(F.struct("first", "last")).alias("spans"))
    both = keyed.join(
        spans.withColumnsRenamed({"doc": "_doc", "tie": "_tie"}),
        keyed["doc"].eqNullSafe(F.col("_doc")) & (keyed["tie"] == F.col("_tie")), "left"
    ).select("doc", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            rows = []
            for text, spans_ in zip(batch["text"], batch["spans"], strict=True):
                data = text.as_py().encode()
                kept, removed, count = kept_bytes(
                    data, [(s["first"], s["last"]) for s in spans_.as_py() or []])
                rows.append((len(data), removed, count, hashlib.sha256(kept).hexdigest(),
                             kept if with_bytes else None))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                "kept_sha256 string, kept binary")
