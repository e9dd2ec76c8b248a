"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Vectors are dealt out to lists by the nearest of some centroids.  In its list a vector is kept as
the signs of its rotated, unit-length difference from the centroid, packed into bits, with two
scalars: the length of the difference and the inner product of the unit vector with its code.  From
these a query's inner product with every vector of a list is estimated, with a bound on the error
that holds with high probability.  The lists nearest to a query give it a first k-th best score;
all other lists are then scanned too, but for those that cannot reach that score, and only vectors
whose upper bound reaches it are compared exactly, in double precision.  The estimator and its bound
are those of RaBitQ (Gao and Long, 2024).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.llm.tables import written

NEIGHBOURS = 20
# Vectors that the centroids are fitted on at most, and rows that a list holds on average.
FIT_ROWS = 20_000
LIST_ROWS = 512
MAX_LISTS = 256
# Lists that give a query its first k-th best score.
FIRST_LISTS = 2
# Vectors and queries that meet in one group at most.
PIECE_ROWS, BLOCK_QUERIES = 8192, 16_384
# Parts in which the candidates of a query are thinned before they meet.
PARTS = 32
# Standard errors in the bounds of an estimate and of a whole list.
ERROR_WIDTH, LIST_WIDTH = 3.0, 5.0
SEED = 20


@dataclass(frozen=True)
class Lists:
    """Centroids and, per list, the pieces its rows are dealt to and the greatest distance."""
    centroids: np.ndarray
    pieces: np.ndarray
    radius: np.ndarray

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for equal arguments."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` of the vectors that take part: not null, not zero, all components finite.

    Single-precision vectors travel as such and are widened where they are compared.
    """
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    v = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    nonzero = F.exists(v, lambda x: x != 0)
    return (vectors.select(F.col(id_col).alias("id"), v.alias("v"), bad.alias("bad"),
                           nonzero.alias("nonzero"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.col("bad")
                    & F.col("nonzero")).select("id", "v"))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def _kmeans(points: np.ndarray, k: int, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centroids = points[rng.choice(len(points), size=min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _nearest(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centroids))
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
    return centroids


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    half = 0.5 * (centroids ** 2).sum(axis=1)
    return np.concatenate([np.argmax(p @ centroids.T - half, axis=1)
                           for p in np.array_split(points, max(1, len(points) // 4096))])


def fit_centroids(rows: DataFrame, dim: int, fit_rows: int = FIT_ROWS,
                  list_rows: int = LIST_ROWS) -> np.ndarray:
    """Centroids from a sample of at most about ``fit_rows`` vectors, chosen by a hash of the id."""
    n = rows.count()
    lists = int(min(MAX_LISTS, max(1, n // list_rows), max(1, fit_rows // 4)))
    span = 1 << 30
    share = min(1.0, fit_rows / max(1, n))
    taken = rows.filter(F.pmod(F.xxhash64("id"), F.lit(span)) < int(share * span)).select("v")
    sample = np.array([r.v for r in taken.collect()], float).reshape(-1, dim)
    return _kmeans(sample, lists) if len(sample) else np.zeros((1, dim))


def encode(vectors: np.ndarray, centroid: np.ndarray, turn: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths, and inner products of unit vectors with their codes."""
    gap = vectors - centroid
    length = np.sqrt((gap ** 2).sum(axis=1))
    turned = gap @ turn.T
    bits = turned > 0
    dim = vectors.shape[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        fit = np.abs(turned).sum(axis=1) / math.sqrt(dim) / length
    return np.packbits(bits, axis=1), length, np.where(length > 0, fit, 1.0)


def estimate(queries: np.ndarray, centroid: np.ndarray, turn: np.ndarray, codes: np.ndarray,
             length: np.ndarray, fit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries with encoded vectors, and half the width of their bounds.

    A vector is its centroid plus its length times a unit vector; the unit vector's inner product
    with a query is that of its code divided by ``fit``.
    """
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = (queries @ turn.T).astype(np.float32)
    with_code = turned @ signs.T / math.sqrt(dim)
    value = (queries @ centroid)[:, None] + length * with_code / fit
    norm = np.sqrt((queries ** 2).sum(axis=1))
    spread = np.sqrt(np.maximum(0.0, 1 - fit ** 2)) / fit / math.sqrt(max(1, dim - 1))
    # The last term covers the single precision above.
    return value, ERROR_WIDTH * norm[:, None] * (length * spread) + 1e-4 * norm[:, None] * length


def best_of_piece(q_ids: np.ndarray, queries: np.ndarray, reach: np.ndarray, ids: np.ndarray,
                  vectors: np.ndarray, centroid: np.ndarray, turn: np.ndarray, k: int
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's best ``k`` in a piece as ``(query row, vector row, score)``, ties to smaller ids.

    ``reach`` is the score per query that a result must reach.  Vectors are given in ascending
    order of ids.
    """
    codes, length, fit = encode(vectors, centroid, turn)
    out_q, out_v, out_s = [], [], []
    for start in range(0, len(queries), 512):
        block, block_ids = queries[start:start + 512], q_ids[start:start + 512]
        value, width = estimate(block, centroid, turn, codes, length, fit)
        own = np.searchsorted(ids, block_ids)
        hit = np.flatnonzero((own < len(ids)) & (ids[np.minimum(own, len(ids) - 1)] == block_ids))
        upper = value + width
        upper[hit, own[hit]] = -np.inf
        floor = reach[start:start + 512].copy()
        if len(ids) > 4 * k:
            # The exact k-th best of the vectors with the best estimates bounds the piece's own.
            top = np.argpartition(-upper, 2 * k, axis=1)[:, :2 * k]
            exact = np.einsum("id,ijd->ij", block, vectors[top])
            exact[np.take_along_axis(upper, top, axis=1) == -np.inf] = -np.inf
            floor = np.maximum(floor, np.partition(exact, k, axis=1)[:, k])
        rows, columns = np.nonzero((upper >= floor[:, None]) & (upper > -np.inf))
        score = np.einsum("ij,ij->i", block[rows], vectors[columns])
        enough = score >= floor[rows]
        rows, columns, score = rows[enough], columns[enough], score[enough]
        order = np.lexsort((columns, -score, rows))
        rows, columns, score = rows[order], columns[order], score[order]
        first = np.searchsorted(rows, np.arange(len(block)))
        kept = np.arange(len(rows)) - first[rows] < k
        out_q.append(rows[kept] + start)
        out_v.append(columns[kept])
        out_s.append(score[kept])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _fields(rows: DataFrame) -> str:
    return ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "v"))


def _assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, v, list, distance``: the nearest centroid of every vector and how far it is."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                points = _matrix(pdf["v"])
                nearest = _nearest(points, centroids)
                gap = np.sqrt(((points - centroids[nearest]) ** 2).sum(axis=1))
                yield pdf.assign(list=nearest.astype("int32"), distance=gap)

    return rows.mapInPandas(run, f"{_fields(rows)}, list int, distance double")


def _probing(queries: DataFrame, lists: Lists, first: bool, blocks: int) -> DataFrame:
    """A row per query, list, piece and block: either the first lists of a query, those with the
    largest inner products, or all others that may reach its score ``reach``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = min(FIRST_LISTS, len(lists.centroids))
        for pdf in batches:
            if not len(pdf):
                continue
            points = _matrix(pdf["v"])
            score = points @ lists.centroids.T
            wanted = np.zeros(score.shape, bool)
            np.put_along_axis(wanted, np.argpartition(-score, n - 1, axis=1)[:, :n], True, axis=1)
            if not first:
                norm = np.sqrt((points ** 2).sum(axis=1))[:, None]
                share = min(1.0, LIST_WIDTH / math.sqrt(lists.dim))
                upper = score + norm * lists.radius * share
                wanted = ~wanted & (upper >= pdf["reach"].to_numpy()[:, None])
            row, chosen = np.nonzero(wanted)
            times = lists.pieces[chosen]
            piece = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, chosen = np.repeat(row, times), np.repeat(chosen, times)
            yield pd.DataFrame({"id": pdf["id"].to_numpy()[row], "v": pdf["v"].to_numpy()[row],
                                "reach": pdf["reach"].to_numpy()[row],
                                "list": chosen.astype("int32"), "piece": piece.astype("int32")})

    asked = queries.mapInPandas(
        run, f"{_fields(queries)}, reach double, list int, piece int")
    return asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id",
           vector_col: str = "embedding", k: int = NEIGHBOURS, fit_rows: int = FIT_ROWS,
           list_rows: int = LIST_ROWS) -> DataFrame:
    """Each query's ``k`` nearest by inner product: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on ``id``.  Null and zero vectors and those with null or non-finite
    components take no part; nor does a query with itself.  Ties go to the smaller id, repeated
    rows of one id are one vector, a query with fewer candidates gets all of them, an empty table
    gives no rows, other columns are not looked at.  An inner product needs two vectors of one
    length: those of another length than most (of lengths as frequent, the greatest) take no part.

    All vectors are indexed; centroids alone come from a bounded sample.  A large list is dealt to
    pieces and many queries to blocks, so no group grows with the table.
    """
    kind = vectors.schema[id_col].dataType
    # Of vectors with one id the least counts.
    fit = usable(vectors, id_col, vector_col)
    usual = fit.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = written(fit.filter(F.size("v") == (usual.n if usual else 0))
                   .groupBy("id").agg(F.min("v").alias("v")), "usable")
    head = rows.select(F.size("v").alias("n")).first()
    schema = (f"query_id {kind.simpleString()}, vec_id {kind.simpleString()}, score double, "
              "part int")
    if head is None:
        return rows.sparkSession.createDataFrame([], f"query_id {kind.simpleString()}, rank int, "
                                                 f"vec_id {kind.simpleString()}, score double")
    centroids = fit_centroids(rows, head.n, fit_rows, list_rows)
    placed = written(_assigned(rows, centroids), "vectors")
    sizes = {r["list"]: r for r in placed.groupBy("list").agg(
        F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius")).collect()}
    lists = Lists(
        centroids,
        np.array([-(-sizes[i].n // PIECE_ROWS) if i in sizes else 0 for i in range(len(centroids))]),
        np.array([sizes[i].radius if i in sizes else 0.0 for i in range(len(centroids))]))
    queries = placed.filter(is_query).select("id", "v")
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    pieces = F.element_at(F.array(*[F.lit(max(1, int(p))) for p in lists.pieces]), F.col("list") + 1)
    held = placed.select(
        "id", "v", "list", F.pmod(F.xxhash64("id"), pieces).cast("int").alias("piece"),
        F.explode(F.array(*[F.lit(b) for b in range(blocks)])).alias("block"))
    turn = rotation(head.n)

    def solve(key, asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(own):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "part": []})
        own = own.sort_values("id")
        ids, q_ids = own["id"].to_numpy(), asked["id"].to_numpy()
        q, v, s = best_of_piece(q_ids, _matrix(asked["v"]), asked["reach"].to_numpy(), ids,
                                _matrix(own["v"]), lists.centroids[key[0]], turn, k)
        return pd.DataFrame({"query_id": q_ids[q], "vec_id": ids[v], "score": s,
                             "part": key[0] % PARTS})

    def found_in(asked: DataFrame) -> DataFrame:
        by = ("list", "piece", "block")
        return asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(solve, schema)

    unbounded = queries.withColumn("reach", F.lit(-math.inf))
    first = written(found_in(_probing(unbounded, lists, True, blocks)), "first-lists")
    reach = best(first, k).filter(F.col("rank") == k).select(
        F.col("query_id").alias("id"), F.col("score").alias("reach"))
    bounded = queries.join(reach, "id", "left").select(
        "id", "v", F.coalesce("reach", F.lit(-math.inf)).alias("reach"))
    return best(first.unionByName(found_in(_probing(bounded, lists, False, blocks))), k)


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best candidates per query, thinned in parts first, so that no query gathers many."""
    ordered = F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i"))

    def thinned(df: DataFrame, by: list[str], item: Column) -> DataFrame:
        return df.groupBy(*by).agg(F.slice(F.sort_array(F.collect_list(item)), 1, k).alias("top"))

    parts = thinned(found, ["query_id", "part"], ordered).select("query_id", F.explode("top").alias("x"))
    return thinned(parts, ["query_id"], F.col("x")).select(
        "query_id", F.posexplode("top").alias("place", "x")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"),
        (-F.col("x.s")).alias("score"))
