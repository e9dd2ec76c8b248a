"""Near-duplicates by SimHash fingerprints, searched with BK-trees.

Two fingerprints that differ in at most three of 64 bits agree in one of four 16-bit blocks.  Rows
are dealt out by (block, value); each such shard builds a BK-tree, whose children are keyed by
their Hamming distance to the parent, and sends its fingerprints down the tree along those edges
only that the triangle inequality leaves open.  A shard that is too large for one tree is dealt out
once more by the blocks of its other 48 bits, and what is still too large becomes several trees,
each of which meets the fingerprints of the others.  A shard emits a spanning forest of its links,
never all pairs; components are then found across shards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.components import components
from zonepulse.llm.tables import written

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
# Fingerprints in one tree.
TREE_SIZE = 1024

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SLICE = 1 << 15


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a whole text; zero if it has no words."""
    found = _WORD.findall(text.encode().lower()) if text else []
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, _SLICE):
        hashes = np.array([
            xxhash.xxh64_intdigest(b" ".join(found[i:i + words]), SEED)
            for i in range(start, min(n, start + _SLICE))], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the ``carried`` columns and the SimHash of every whole text as a signed ``fp``.

    Null and empty texts have fingerprint zero; rows, null ids included, are kept as they are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in kept], pa.array(found.view(np.int64))], [*kept, "fp"])

    kept = ["doc_id", *carried]
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept]
    return docs.select(*kept, docs["text"].cast("string").alias("text")).mapInArrow(
        run, ", ".join([*kinds, "fp long"]))


class BkTree:
    """Fingerprints in insertion order; ``children[i]`` maps a distance to a later node."""

    def __init__(self, values: list[int]):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        for new in range(1, len(values)):
            at = 0
            while True:
                edge = (values[at] ^ values[new]).bit_count()
                nearer = self.children[at].setdefault(edge, new)
                if nearer == new:
                    break
                at = nearer

    def hits(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each node that has queries within the radius, with the indices of those queries.

        All queries go down together; an edge is followed by those it may still serve.
        """
        stack = [(0, np.arange(len(queries)))] if self.values and len(queries) else []
        while stack:
            node, active = stack.pop()
            gap = np.bitwise_count(queries[active] ^ np.uint64(self.values[node])).astype(np.int16)
            near = active[gap <= radius]
            if near.size:
                yield node, near
            for edge, child in self.children[node].items():
                below = active[np.abs(gap - edge) <= radius]
                if below.size:
                    stack.append((child, below))


def forest(tree: np.ndarray, others: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Links ``[value, root]`` that span all pairs within the radius in a tree, or with others.

    Inputs are unsigned 64-bit values, each without repeats.
    """
    values = np.concatenate([tree, others])
    label = np.arange(len(values))
    queries, shift = (others, len(tree)) if len(others) else (tree, 0)
    for node, near in BkTree(tree.tolist()).hits(queries, radius):
        joined = np.append(label[near + shift], label[node])
        if (joined != joined[0]).any():
            label[np.isin(label, joined)] = joined.min()
    linked = label != np.arange(len(values))
    return np.stack([values[linked], values[label[linked]]], axis=1)


def _key(fp: Column, bits: int, offset: int) -> Column:
    return F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << bits) - 1))


def _first_keys(fp: Column) -> Column:
    """(block, value) for the four 16-bit blocks, as one number each."""
    return F.array(*[_key(fp, 16, 16 * b) + (b << 16) for b in range(4)])


def _second_keys(key: Column, rest: Column) -> Column:
    """A first key with each of four 12-bit blocks of the 48 bits it leaves open."""
    return F.array(*[(key * 4 + b) * (1 << 12) + _key(rest, 12, 12 * b) + (1 << 40)
                     for b in range(4)])


def _sized(rows: DataFrame) -> DataFrame:
    """Keys that hold more than one fingerprint, with their number; combined before the shuffle."""
    return written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shards")


def _pieces(distinct: DataFrame, tree_size: int) -> DataFrame:
    """``(key, a, b, side, fp)``: what each tree holds (side 0) and meets (side 1)."""
    first = distinct.select("fp", F.explode(_first_keys(F.col("fp"))).alias("key"))
    first = first.join(_sized(first), "key")
    small = first.filter(F.col("n") <= tree_size).select("key", "fp", F.lit(1).alias("trees"))
    second = (
        first.filter(F.col("n") > tree_size)
        .withColumn("low", (F.col("key") / (1 << 16)).cast("int") * 16)
        .withColumn("rest", F.expr(
            "(fp & (shiftleft(1L, low) - 1L)) | "
            "if(low = 48, 0L, shiftleft(shiftrightunsigned(fp, low + 16), low))"))
        .select("fp", F.explode(_second_keys(F.col("key"), F.col("rest"))).alias("key")))
    second = second.join(_sized(second), "key").select(
        "key", "fp", F.ceil(F.col("n") / tree_size).cast("int").alias("trees"))
    dealt = small.union(second).withColumn(
        "t", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
    # Tree a holds its own fingerprints and meets those of every later tree b.
    holds = F.transform(F.sequence(F.col("t"), F.col("trees") - 1), lambda b: F.struct(
        F.col("t").alias("a"), b.alias("b"), F.lit(0).alias("side")))
    meets = F.when(F.col("t") > 0, F.transform(
        F.sequence(F.lit(0), F.col("t") - 1),
        lambda a: F.struct(a.alias("a"), F.col("t").alias("b"), F.lit(1).alias("side"))))
    empty = F.array().cast("array<struct<a:int,b:int,side:int>>")
    return dealt.select("key", "fp", F.explode(F.concat(holds, F.coalesce(meets, empty))).alias("p")
                        ).select("key", "p.a", "p.b", "p.side", "fp")


def links(distinct: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Links ``(u, v)`` that span all pairs of distinct fingerprints ``fp`` within the radius."""
    if radius > 3:
        raise ValueError("four blocks prove at most three differing bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(found: list[np.ndarray]) -> pa.RecordBatch:
            both = np.concatenate(found).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1])], ["u", "v"])

        def solve(rows: np.ndarray) -> Iterator[np.ndarray]:
            """Rows of whole groups, sorted by group and side."""
            change = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
            cuts = np.flatnonzero(change) + 1
            for start, end in zip(np.append(0, cuts), np.append(cuts, len(rows)), strict=True):
                if end - start > 1:
                    group = rows[start:end]
                    split = int(np.searchsorted(group[:, 3], 1))
                    values = group[:, 4].view(np.uint64)
                    if group[0, 1] == group[0, 2] or 0 < split < len(group):
                        yield forest(values[:split], values[split:], radius)

        for batch in batches:
            rows = np.stack([batch[c].to_numpy().astype(np.int64)
                             for c in ("key", "a", "b", "side", "fp")], axis=1)
            if not len(rows):
                continue
            rows = np.concatenate([*held, rows])
            last = (rows[:, :3] == rows[-1, :3]).all(axis=1)
            first_of_last = len(rows) - int(last[::-1].argmin()) if not last.all() else 0
            held = [rows[first_of_last:]]
            if first_of_last and (found := list(solve(rows[:first_of_last]))):
                yield out(found)
        if held and (found := list(solve(held[0]))):
            yield out(found)

    return (_pieces(distinct, tree_size).repartition("key", "a", "b")
            .sortWithinPartitions("key", "a", "b", "side", "fp")
            .mapInArrow(run, "u long, v long"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Fingerprints link at ``radius`` or fewer differing bits, texts without words too, and
    ``component_id`` is the least id reachable.  Equal fingerprints are one node however many rows
    have them.  Repeated rows are kept, null ids stay null and never name a component unless it has
    no other, an empty table gives no rows, and other columns are not looked at.
    """
    rows = written(fingerprints(docs), "simhash")
    rooted = _rooted(rows, radius, tree_size)
    least = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    named = written(rooted.join(least, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _rooted(rows: DataFrame, radius: int, tree_size: int) -> DataFrame:
    """Every fingerprint of ``rows`` with the least id that has it and its component's ``root``."""
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(distinct.select("fp"), radius, tree_size))
    return written(
        distinct.join(roots, F.col("fp") == F.col("node"), "left")
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")


def keep_first(docs: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """One document of each group, the one with the least id; all columns stay.

    An id may name several texts, and they may belong to different groups, so a row is known by its
    id and a hash of all its columns: of a group's rows with the least id the one with the least
    hashes (of the text, then of the row) stays, and a row that repeats it wholly does not.  Every
    run keeps the same rows.  Rows with a null id name no group and all stay.  Columns of a map
    type take no part in the hash.
    """
    hashable = [c for c, kind in docs.dtypes if "map<" not in kind]
    marked = docs.withColumns({"_text_hash": F.xxhash64("text"), "_row_hash": F.xxhash64(*hashable)})
    rows = written(fingerprints(marked, ("_text_hash", "_row_hash")).filter(
        F.col("doc_id").isNotNull()), "simhash")
    order = F.struct("doc_id", "_text_hash", "_row_hash")
    rooted = _rooted(rows, radius, tree_size)
    firsts = (rows.groupBy("fp").agg(F.min(order).alias("first")).join(rooted, "fp")
              .groupBy("root").agg(F.min("first").alias("first"))
              .select("first.doc_id", "first._row_hash"))
    key = ["doc_id", "_row_hash"]
    named = marked.join(firsts, key, "left_semi").dropDuplicates(key)
    return named.unionByName(marked.filter(F.col("doc_id").isNull())).drop(
        "_text_hash", "_row_hash")
