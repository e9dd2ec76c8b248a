from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from zonepulse.llm import simhash
from zonepulse.llm.components import components


def slow_fingerprint(text):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(pairs):
    """Least id per component from (id, fingerprint)."""
    parent = {f: f for _, f in pairs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = sorted(parent)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for i, f in pairs:
        least[find(f)] = min(i, least.get(find(f), i))
    return {i: least[find(f)] for i, f in pairs}


def test_against_brute_force(documents):
    pairs = [(r.doc_id, slow_fingerprint(r.text)) for r in documents.collect()]
    want = groups(pairs)
    for r in simhash.near_duplicates(documents).collect():
        assert int(r.fingerprint, 16) == dict(pairs)[r.doc_id]
        assert r.component_id == want[r.doc_id]


@pytest.mark.parametrize("tree_size", [2, 5, 1024])
def test_links_of_crowded_shards(spark, tree_size):
    """Dense clusters of near values: shards are dealt out again and become several trees."""
    rng = random.Random(3)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(25):
            v = centre
            for _ in range(rng.randrange(0, 6)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    df = spark.createDataFrame(signed, "fp long")
    roots = {r.node: r.root for r in components(simhash.links(df, tree_size=tree_size)).collect()}
    want = groups([(s[0], s[0] & (1 << 64) - 1) for s in signed])
    ours = {}
    for (s,) in signed:
        ours.setdefault(roots.get(s, s), set()).add(s)
    theirs = {}
    for s, least in want.items():
        theirs.setdefault(least, set()).add(s)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_a_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 1 << 12, 300, dtype=np.uint64))
    found = {(n, int(q)) for n, near in simhash.BkTree(values.tolist()).hits(values, 3) for q in near}
    want = {(i, j) for i in range(len(values)) for j in range(len(values))
            if int(values[i] ^ values[j]).bit_count() <= 3}
    assert found == want


def test_more_than_three_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), radius=4)


def test_awkward_rows(awkward, empty):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[0].component_id == by_id[1].component_id == by_id[2].component_id == 0
    assert by_id[0].fingerprint == "0" * 16
    assert by_id[9].component_id == 8
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and ids.count(5) == 1 and 9 not in ids and 1 not in ids
    assert simhash.near_duplicates(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    df = spark.createDataFrame(links, "u long, v long")
    roots = {r.node: r.root for r in components(df).collect()}
    assert roots == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_a_repeated_id_costs_no_unique_text(spark):
    """Rows of one id in different groups, in one group, and a copy under a greater id."""
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six seven",
               "north south east west up down left")
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, c, "y"), (3, c, "x"), (3, c, "x"), (4, c, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for shuffled in (df, df.repartition(5), df.orderBy(F.desc("doc_id"), "source")):
        kept = sorted(tuple(r) for r in simhash.keep_first(shuffled).collect())
        assert [r[:2] for r in kept] == [(1, a), (2, b), (3, c)]
        assert simhash.keep_first(shuffled).columns == df.columns
        first = kept if shuffled is df else first
        assert kept == first
