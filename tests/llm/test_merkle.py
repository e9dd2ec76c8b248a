from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from tests.compare import difference
from tests.llm.conftest import AWKWARD, SF_DIR
from zonepulse.llm import merkle
from zonepulse.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, idx long, tree string"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    cells = (row[0], row[3], row[2], row[4], row[1])
    return h("-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells)


def grown(leaves, fan_out=3):
    """All levels of a tree, and per leaf its path as (left, right) siblings."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(row[i:i + fan_out]) for i in range(0, len(row), fan_out)])
    paths = []
    for i in range(len(leaves)):
        path = []
        for row in levels[:-1]:
            first = i // fan_out * fan_out
            path.append((row[first:i], row[i + 1:first + fan_out]))
            i //= fan_out
        paths.append(path)
    return levels[-1][0], paths


def plain(rows, fan_out=3):
    """What the query returns, tree by tree."""
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda x: x[:3])
        trees[s] = grown([x[2] for x in by_source[s]], fan_out)
    root, tops = grown([trees[s][0] for s in order], fan_out)
    out = []
    for s, top in zip(order, tops, strict=True):
        for (*_, digest, r), path in zip(by_source[s], trees[s][1], strict=True):
            path = path + top
            node = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None:
                node = leaf((r[0], r[1].replace("\n", ""), *r[2:]))
            for left, right in path:
                node = h([*left, node, *right])
            proof = h(x for left, right in path for x in left + right)
            out.append((r[0], digest, trees[s][0], root, proof, node, node == root))
    return out


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def found(spark, rows, fan_out=3, levels=merkle.LEVELS):
    df = spark.createDataFrame([(*r, 99, "x") for r in rows], SCHEMA)
    manifest = merkle.build(df, merkle.without_line_feeds(df), fan_out=fan_out, levels=levels)
    return sorted((tuple(r) for r in manifest.proofs().collect()), key=key), manifest


def awkward_rows():
    rows = [(i, t, [None, "en"][i % 2], ["s", None, "", "é", "z"][i % 5], None if i % 3 else len(t or ""))
            for i, t in enumerate(AWKWARD)]
    rows += [(i, f"line {i}\nmore\n", "en", "hot", 7) for i in range(100, 160)]
    rows += [(5, "same", "en", "s", 4)] * 7 + [(None, "no\nid", None, None, 5), (None, None, None, "s", None)]
    return rows


@pytest.mark.parametrize(("fan_out", "levels"), [(3, 7), (3, 1), (3, 2), (2, 3), (5, 1)])
def test_proofs_against_whole_trees(spark, fan_out, levels):
    rows = awkward_rows()
    got, manifest = found(spark, rows, fan_out, levels)
    want = sorted(plain(rows, fan_out), key=key)
    assert got == want
    assert {r[3] for r in got} == {manifest.root()}
    bad = [r for r in got if not r[6]]
    assert bad and all(zlib.crc32(str(r[0]).encode()) % 2 == 0 for r in bad)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_runs_that_do_not_come_out_even(spark, n):
    rows = [(i, f"t{i}", "en", "only", i) for i in range(n)]
    got, manifest = found(spark, rows, levels=2)
    assert got == sorted(plain(rows), key=key)
    if n == 1:
        assert got[0][1] == got[0][2] == got[0][3] == manifest.root()


def test_the_graph_is_content_addressed(spark):
    _, manifest = found(spark, awkward_rows(), levels=2)
    nodes = {bytes(r.digest): [bytes(c) for c in r.children] for r in manifest.nodes().collect()}
    assert all(merkle.combine(c) == d for d, c in nodes.items())
    leaves, todo = set(), [bytes.fromhex(manifest.root())]
    while todo:
        at = todo.pop()
        if at in nodes:
            todo += nodes[at]
        else:
            leaves.add(at.hex())
    assert leaves == {leaf(r) for r in awkward_rows()}


def test_one_source_and_no_rows(spark):
    rows = [(i, "t", None, None, None) for i in range(5)]
    assert found(spark, rows)[0] == sorted(plain(rows), key=key)
    got, manifest = found(spark, [])
    assert got == [] and manifest.root() is None and manifest.nodes().count() == 0


def test_query_equals_its_sql(spark):
    df = QUERIES["op12_merkle_manifest"](spark, SF_DIR)
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert difference(df, ORACLE_SQL["op12_merkle_manifest"], SF_DIR) == ""


def test_sql_agrees_with_whole_trees():
    rows = awkward_rows()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, "
                "n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    got = con.execute(ORACLE_SQL["op12_merkle_manifest"]).fetchall()
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
