"""A Merkle manifest of a dataset, kept as a content-addressed graph, and proofs of its rows.

Rows are leaves; the leaves of a source, in order, are hashed together in runs until one node, its
subroot, is left, and so are the subroots of all sources.  Inner nodes are stored as records from a
digest to the digests of its children.  They are stored by segments of a few levels, under the
digest of the segment's top node, so that a tree of any size is a handful of rounds deep and a task
never holds more than one segment.

A proof is read off the stored records alone: a request carries a digest and a rank.  It looks up
the records under the digest, goes down by the digits of the rank, collects at every node the
children it does not choose, and hands what it found to the requests below.  The path is found from
the root, so each segment's part is reversed and put before the part above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.llm.tables import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_OUT = 3
# Levels in a segment: at most 3 ** 7 = 2,187 nodes at its lower edge.
LEVELS = 7

_RECORDS = "array<struct<digest: binary, children: array<binary>>>"
_PATH = "array<struct<place: int, siblings: array<binary>>>"
_PATH_TYPE = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.binary()))]))
_RECORDS_TYPE = pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))]))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each as ``bytes:value``, or ``-`` where it is null."""
    def form(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[form(c) for c in fields]), 256))


def combine(children: Sequence[bytes]) -> bytes:
    """The digest of a node: SHA-256 of its children's digests as lowercase hex text."""
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


def _ranked(nodes: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``nodes`` with ``idx``, the place in its ``tree`` by ``order``, and ``n``, the tree's size.

    Rows are sorted by ranges, so a tree that holds a third of all rows is spread over a third of
    the tasks; a row's place is its place within its task plus the sizes of the tasks before.
    """
    rows = written(nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                   .withColumn("pos", F.monotonically_increasing_id()), label)
    task = F.shiftright("pos", 33)
    counts = rows.groupBy("tree", task.alias("task")).agg(
        F.count(F.lit(1)).alias("here"), F.min("pos").alias("first"))
    by_tree = Window.partitionBy("tree")
    starts = counts.select(
        F.col("tree").alias("of_tree"), F.col("task").alias("of_task"), "first",
        (F.sum("here").over(by_tree.orderBy("task")) - F.col("here")).alias("before"),
        F.sum("here").over(by_tree).alias("n"))
    joined = rows.join(starts, rows["tree"].eqNullSafe(F.col("of_tree")) & (task == F.col("of_task")))
    return joined.select(*[c for c in rows.columns if c != "pos"],
                         (F.col("before") + F.col("pos") - F.col("first")).alias("idx"), "n")


def _levels_of(n: int, fan_out: int, levels: int) -> int:
    """Levels between the nodes of a segment and its top: all, unless the tree ends sooner."""
    if n > fan_out ** levels:
        return levels
    found = 0
    while n > 1:
        n, found = -(-n // fan_out), found + 1
    return found


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _segments(nodes: DataFrame, fan_out: int, levels: int) -> DataFrame:
    """Hash each run of ``fan_out ** levels`` neighbours up to one node and keep the inner records.

    ``nodes`` has ``tree, idx, n, digest``; the result ``tree, chunk, n, digest, nodes, levels,
    records``, where ``digest`` is the top node and ``nodes`` counts those at the lower edge.
    """
    width = fan_out ** levels

    def solve(key: tuple, digests: list[bytes]) -> tuple:
        tree, chunk, n = key
        height, records = _levels_of(n, fan_out, levels), {}
        row = digests
        for _ in range(height):
            runs = [row[i:i + fan_out] for i in range(0, len(row), fan_out)]
            row = [combine(r) for r in runs]
            records.update(zip(row, runs, strict=True))
        return (tree, chunk, n, row[0], len(digests), height,
                [{"digest": d, "children": c} for d, c in records.items()])

    def out(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), _RECORDS_TYPE)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
            ["tree", "chunk", "n", "digest", "nodes", "levels", "records"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digests, found, held = None, [], [], 0
        for *new, digest in _rows(batches):
            if key != new and digests:
                found.append(solve(tuple(key), digests))
                held += len(digests)
                digests = []
                if held >= width:
                    yield out(found)
                    found, held = [], 0
            key = new
            digests.append(digest)
        if digests:
            found.append(solve(tuple(key), digests))
        if found:
            yield out(found)

    chunk = F.floor(F.col("idx") / width).cast("long").alias("chunk")
    return (nodes.select("tree", chunk, "n", "idx", "digest").repartition("tree", "chunk")
            .sortWithinPartitions("tree", "chunk", "idx").drop("idx")
            .mapInArrow(run, "tree string, chunk long, n long, digest binary, nodes int, levels int, "
                             f"records {_RECORDS}"))


@dataclass(frozen=True)
class Trees:
    """Trees with the stored segments of every round, the lowest first."""

    rounds: list[DataFrame]
    fan_out: int
    levels: int

    @property
    def width(self) -> int:
        return self.fan_out ** self.levels

    def tops(self) -> DataFrame:
        """``tree, digest, round``: the top node of each tree and the round whose segment has it."""
        found = [s.filter(F.col("n") <= self.width).select("tree", "digest", F.lit(r).alias("round"))
                 for r, s in enumerate(self.rounds)]
        all_ = found[0]
        for more in found[1:]:
            all_ = all_.unionByName(more)
        return all_

    def records(self, at: int) -> DataFrame:
        """The segments of a round by the digest of their top; equal digests hold equal records."""
        return (self.rounds[at].select("digest", "nodes", "levels", "records")
                .dropDuplicates(["digest"]))

    def nodes(self) -> DataFrame:
        """``digest, children`` of every inner node."""
        found = [s.select(F.explode("records").alias("r")).select("r.*") for s in self.rounds]
        all_ = found[0]
        for more in found[1:]:
            all_ = all_.unionByName(more)
        return all_.dropDuplicates(["digest"])


def grow(nodes: DataFrame, fan_out: int = FAN_OUT, levels: int = LEVELS) -> Trees:
    """Hash ranked ``nodes`` (``tree, idx, n, digest``) up to one node per tree.

    Each round writes its segments; the next one starts from their top nodes.  Only the size of the
    largest tree reaches the driver.
    """
    width, rounds = fan_out ** levels, []
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        rounds.append(written(_segments(nodes, fan_out, levels), "segments"))
        if largest <= width:
            return Trees(rounds, fan_out, levels)
        largest = -(-largest // width)
        nodes = rounds[-1].filter(F.col("n") > width).select(
            "tree", F.col("chunk").alias("idx"), F.ceil(F.col("n") / width).cast("long").alias("n"),
            "digest")


def _down(root: bytes, rank: int, levels: int, fan_out: int,
          children: dict[bytes, list[bytes]]) -> tuple[bytes, list[tuple[int, list[bytes]]]]:
    """The node of a rank below ``root``, and the way there, lowest level first: the place of the
    chosen child and the others, which are its siblings."""
    at, way, below = root, [], fan_out ** levels
    for _ in range(levels):
        below //= fan_out
        place, rank = divmod(rank, below)
        kids = children[at]
        way.append((place, kids[:place] + kids[place + 1:]))
        at = kids[place]
    way.reverse()
    return at, way


def _answered(requests: DataFrame, trees: Trees, at: int) -> DataFrame:
    """Requests for whole segments (``tree, chunk, digest, above`` and more) answered by the nodes
    at their lower edge: ``tree, chunk, digest, above`` again, one level of segments deeper."""
    fan_out, width = trees.fan_out, trees.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, chunk, digest, above, nodes, levels, records in _rows(batches):
            children = {r["digest"]: r["children"] for r in records}
            above = [(a["place"], a["siblings"]) for a in above]
            found = [_down(digest, rank, levels, fan_out, children) for rank in range(nodes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * nodes, pa.string()),
                 pa.array(range(chunk * width, chunk * width + nodes), pa.int64()),
                 pa.array([d for d, _ in found], pa.binary()),
                 pa.array([[{"place": p, "siblings": s} for p, s in way + above]
                           for _, way in found], _PATH_TYPE)],
                ["tree", "chunk", "digest", "above"])

    looked_up = requests.select("tree", "chunk", "digest", "above").join(trees.records(at), "digest")
    return looked_up.select("tree", "chunk", "digest", "above", "nodes", "levels", "records").mapInArrow(
        run, f"tree string, chunk long, digest binary, above {_PATH}")


def _requests(starts: DataFrame, trees: Trees) -> DataFrame:
    """Requests for the lowest segments, from one request per tree (``tree, digest, round, above``)."""
    requests = None
    for at in reversed(range(len(trees.rounds))):
        here = starts.filter(F.col("round") == at).select(
            "tree", F.lit(0).cast("long").alias("chunk"), "digest", "above")
        requests = here if requests is None else here.unionByName(
            written(_answered(requests, trees, at + 1), "requests"))
    return requests


@dataclass(frozen=True)
class Manifest:
    """A dataset's trees: one per source, and one over their subroots."""

    leaves: DataFrame
    sources: Trees
    subroots: DataFrame
    top: Trees

    def root(self) -> str | None:
        """The digest of the dataset; null for an empty one."""
        row = self.top.tops().first()
        return row and bytes(row["digest"]).hex()

    def nodes(self) -> DataFrame:
        """``digest, children`` of every inner node of every tree."""
        return self.sources.nodes().unionByName(self.top.nodes()).dropDuplicates(["digest"])

    def proofs(self) -> DataFrame:
        """Every leaf's proof, and what its presented digest folds up to with it.

        ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.
        """
        fan_out, width = self.sources.fan_out, self.sources.width
        top = self.top.tops().select(
            "tree", "round", "digest", F.array().cast(_PATH).alias("above"))
        paths = _answered(_requests(top, self.top), self.top, 0).select(
            F.col("chunk").alias("idx"), "above")
        starts = written(self.subroots.join(paths, "idx").select(
            F.col("source").alias("tree"), "digest", "round", "above"), "starts")
        lowest = _requests(starts, self.sources)
        tops = starts.select(F.col("tree").alias("of_tree"), F.col("digest").alias("subroot"))
        id_type = self.leaves.schema["doc_id"].dataType
        headers = (
            lowest.join(self.sources.records(0), "digest")
            .join(tops, F.col("tree").eqNullSafe(F.col("of_tree")))
            .select("tree", "chunk", F.lit(-1).cast("long").alias("idx"), "digest", "above", "levels",
                    "records", "subroot", F.lit(None).cast(id_type).alias("doc_id"),
                    F.lit(None).cast("binary").alias("presented")))
        leaves = self.leaves.select(
            "tree", F.floor(F.col("idx") / width).cast("long").alias("chunk"), "idx", "digest",
            *[F.lit(None).cast(headers.schema[c].dataType).alias(c)
              for c in ("above", "levels", "records", "subroot")], "doc_id", "presented")
        rows = (headers.unionByName(leaves).repartition("tree", "chunk")
                .sortWithinPartitions("tree", "chunk", "idx"))
        root = self.root()
        read = ("idx", "digest", "above", "levels", "records", "subroot", "presented")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # A segment's header comes just before its leaves; it may lie in an earlier batch.
            held: dict = {}
            for batch in batches:
                yield from proved(batch, held)

        def proved(batch: pa.RecordBatch, held: dict) -> Iterator[pa.RecordBatch]:
            ids, out = [], []
            columns = [batch[c].to_pylist() for c in read]
            for row, (idx, digest, above, levels, records, subroot, presented) in enumerate(
                    zip(*columns, strict=True)):
                if idx < 0:
                    held.update(
                        top=digest, levels=levels, subroot=subroot.hex(),
                        children={r["digest"]: r["children"] for r in records},
                        above=[(a["place"], a["siblings"]) for a in above])
                    continue
                _, way = _down(held["top"], idx % width, held["levels"], fan_out, held["children"])
                siblings, node = hashlib.sha256(), presented
                for place, others in way + held["above"]:
                    siblings.update(b"".join(o.hex().encode() for o in others))
                    node = combine([*others[:place], node, *others[place:]])
                subroot = held["subroot"]
                ids.append(row)
                out.append((digest.hex(), subroot, root, siblings.hexdigest(), node.hex(),
                            node.hex() == root))
            if ids:
                kinds = [*[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(ids)),
                     *[pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]],
                    ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

        return rows.mapInArrow(
            run, f"doc_id {id_type.simpleString()}, leaf string, subroot string, root string, "
                 "proof_sha256 string, folded_root string, verified boolean")


def build(docs: DataFrame, presented: dict[str, Column] | None = None,
          fields: Sequence[str] = FIELDS, fan_out: int = FAN_OUT, levels: int = LEVELS) -> Manifest:
    """The manifest of ``docs``; ``presented`` are columns that a row comes with when it is checked.

    Leaves ascend by ``doc_id`` within their ``source``, null ids first, equal ids by digest; a
    repeated row is a leaf of its own.  Null sources are one source, before all others.  A lone leaf
    is the subroot of its source, a lone subroot the root.  An empty table has no nodes, no root and
    no proofs.  Columns other than ``fields`` are not looked at.
    """
    cells = {c: F.col(c) for c in fields}
    leaves = written(docs.select(
        F.col("source").cast("string").alias("tree"), "doc_id",
        leaf_digest(list(cells.values())).alias("digest"),
        leaf_digest(list({**cells, **(presented or {})}.values())).alias("presented"),
        # Rows that are alike in all else are told apart, so that ranges can split them.
        F.monotonically_increasing_id().alias("row")), "leaves")
    ranked = written(_ranked(leaves, ("doc_id", "digest", "row"), "sorted-leaves").drop("row"), "ranked")
    sources = grow(ranked, fan_out, levels)
    tops = sources.tops().select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest", "round")
    subroots = written(_ranked(tops, ("source",), "sorted-subroots"), "subroots")
    return Manifest(ranked, sources, subroots, grow(subroots, fan_out, levels))


def without_line_feeds(docs: DataFrame) -> dict[str, Column]:
    """A tampering: every second row, by the CRC of its id, comes without its line feeds."""
    even = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0
    text = docs["text"].cast("string")
    return {"text": F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)}


def check_tampered(docs: DataFrame) -> DataFrame:
    """Proofs of all rows of ``docs``, checked against rows of which some were tampered with.

    ``doc_id, leaf, subroot, root, proof_sha256`` are those of the untampered rows; ``folded_root``
    is what the presented row folds up to and ``verified`` whether that is the root.  Rows with a
    null id are not tampered with.  Edge cases are those of ``build``.
    """
    return build(docs, without_line_feeds(docs)).proofs()


# Levels of a tree that the SQL spells out: up to 3 ** 12 leaves of a source, and as many sources.
_SQL_LEVELS = 12


def oracle_sql(fields: Sequence[str] = FIELDS, fan_out: int = FAN_OUT) -> str:
    """The same rows level by level, all proofs in step."""
    def form(cell: str) -> str:
        value = f"CAST({cell} AS VARCHAR)"
        return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"

    def leaf(cells: Sequence[str]) -> str:
        return f"sha256({' || '.join(form(c) for c in cells)})"

    # CRC-32 of the id's digits: each byte is followed by seven steps without one.
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform("
        "range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: "
        "[ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
        "lambda c, x: CASE WHEN xor(c, x) & 1 = 1 THEN xor(xor(c, x) >> 1, 3988292384) "
        "ELSE xor(c, x) >> 1 END), 4294967295)")
    tampered = [f"CASE WHEN doc_id IS NOT NULL AND {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
                if c == "text" else c for c in fields]
    parts = [f"""
leaves AS (
    SELECT doc_id, source, {leaf(fields)} AS leaf, {leaf(tampered)} AS presented FROM documents),
n0 AS (
    SELECT doc_id, source, leaf, presented, count(*) OVER (PARTITION BY source) AS n,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
    FROM leaves),
s0 AS (SELECT source, idx, n, leaf AS digest FROM n0),
p0 AS (SELECT doc_id, source, idx, n, leaf, presented AS node, '' AS siblings FROM n0)"""]

    def climb(nodes: str, paths: str, k: int) -> None:
        at = f"b.source IS NOT DISTINCT FROM p.source AND b.run = p.idx // {fan_out}"
        left = f"array_to_string(b.kids[1:p.idx % {fan_out}], '')"
        right = f"array_to_string(b.kids[p.idx % {fan_out} + 2:], '')"
        up = f"(n + {fan_out - 1}) // {fan_out}"
        parts.append(f"""
{nodes}r{k} AS (
    SELECT source, idx // {fan_out} AS run, any_value(n) AS n, list(digest ORDER BY idx) AS kids
    FROM {nodes}{k} GROUP BY source, idx // {fan_out}),
{nodes}{k + 1} AS (
    SELECT source, run AS idx, {up} AS n,
           CASE WHEN n = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS digest
    FROM {nodes}r{k}),
{paths}{k + 1} AS (
    SELECT p.* EXCLUDE (idx, n, node, siblings), p.idx // {fan_out} AS idx,
           (p.n + {fan_out - 1}) // {fan_out} AS n,
           CASE WHEN p.n = 1 THEN p.node ELSE sha256({left} || p.node || {right}) END AS node,
           p.siblings || {left} || {right} AS siblings
    FROM {paths}{k} p JOIN {nodes}r{k} b ON {at})""")

    for k in range(_SQL_LEVELS):
        climb("s", "p", k)
    parts.append(f"""
subroots AS (
    SELECT source AS name, digest, count(*) OVER () AS n,
           row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx FROM s{_SQL_LEVELS}),
t0 AS (SELECT 0 AS source, idx, n, digest FROM subroots),
q0 AS (
    SELECT p.doc_id, p.leaf, r.digest AS subroot, 0 AS source, r.idx, r.n, p.node, p.siblings
    FROM p{_SQL_LEVELS} p JOIN subroots r ON r.name IS NOT DISTINCT FROM p.source)""")
    for k in range(_SQL_LEVELS):
        climb("t", "q", k)
    return f"""
WITH {",".join(parts)}
SELECT q.doc_id, q.leaf, q.subroot, r.digest AS root, sha256(q.siblings) AS proof_sha256,
       q.node AS folded_root, q.node = r.digest AS verified
FROM q{_SQL_LEVELS} q JOIN t{_SQL_LEVELS} r ON r.source = q.source
"""
