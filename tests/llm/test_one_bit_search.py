from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepulse.llm import one_bit_search as S


def nearest(ids, vectors, q, k):
    score = vectors @ vectors[q]
    order = [i for i in np.lexsort((ids, -score)) if i != q][:k]
    return [(int(ids[i]), float(score[i])) for i in order]


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], float)
    found = by_query(S.search(table, F.col("id") % 20 == 0))
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        want = nearest(ids, vectors, q, 20)
        got = found[ids[q]]
        hits += len({i for i, _ in want} & {i for i, _ in got})
        total += len(want)
        scores = dict(zip(ids.tolist(), (vectors @ vectors[q]).tolist(), strict=True))
        assert all(abs(s - scores[i]) < 1e-12 for i, s in got)
    assert hits / total >= 0.9


def test_many_lists_blocks_and_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE_ROWS", 40)
    monkeypatch.setattr(S, "BLOCK_QUERIES", 5)
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((600, 16)).astype(np.float32)
    vectors[::3] = vectors[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<float>")
    found = by_query(S.search(df, F.col("id") % 50 == 0, list_rows=60))
    wide = vectors.astype(float)
    hits = 0
    for q in range(0, 600, 50):
        want = nearest(np.arange(600), wide, q, 20)
        hits += len({i for i, _ in want} & {i for i, _ in found[q]})
    assert hits / (12 * 20) >= 0.9


def test_bounds_hold():
    rng = np.random.default_rng(2)
    vectors, queries = rng.standard_normal((400, 64)), rng.standard_normal((50, 64))
    centre, turn = vectors.mean(axis=0), S.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    value, width = S.estimate(queries, centre, turn, *S.encode(vectors, centre, turn))
    exact = queries @ vectors.T
    assert (np.abs(value - exact) <= width).mean() > 1 - 2 * np.exp(-S.ERROR_WIDTH ** 2 / 2)
    assert np.corrcoef(value.ravel(), exact.ravel())[0, 1] > 0.7


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "a"), (20, [0.0, 0.0], "b"), (40, None, "c"), (1, [nan, 1.0], None),
            (2, [inf, 1.0], "d"), (3, [1.0, None], "e"), (4, [2.0, 0.0], "f"), (5, [2.0, 0.0], "f"),
            (5, [2.0, 0.0], "f"), (None, [9.0, 9.0], "g"), (60, [-1.0, 0.5], "h")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    found = by_query(S.search(df, F.col("id") % 20 == 0))
    assert found == {0: [(4, 2.0), (5, 2.0), (60, -1.0)],
                     60: [(0, -1.0), (4, -2.0), (5, -2.0)]}
    assert S.search(df.limit(0), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("k", [1, 3])
def test_fewer_neighbours(spark, k):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)],
                               "vec_id long, embedding array<double>")
    found = by_query(S.search(df, F.col("id") == 20, k=k))
    assert [i for i, _ in found[20]] == [29, 28, 27][:k]


def test_vectors_of_another_length_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0]), (2, [1.0, 1.0]), (3, [5.0, 5.0, 5.0]), (4, [0.0, 9.0]),
            (20, [7.0]), (4, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert by_query(S.search(df, F.col("id") % 20 == 0)) == {0: [(4, 18.0), (2, 3.0)]}
