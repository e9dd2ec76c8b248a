from __future__ import annotations

import re
from itertools import permutations

import pytest

from tests.compare import difference
from tests.llm.conftest import AWKWARD, SF_DIR
from zonepulse.llm import filter_audit
from zonepulse.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(rows):
    """Each row's set of failed filters, from its text alone."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text) if w]
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > least[text],
        }
        out.append({f for f, fails in failed.items() if fails})
    return out


def plain(rows, labels):
    """Every order applied to every document in turn."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    failed, out = failures(rows), {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failed, strict=True) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        table = {}
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [(i, m) for i, m in left if f in m]
                left = [(i, m) for i, m in left if f not in m]
                shapley[f] += len(gone)
                table["".join(order), step] = [
                    len(left), len(gone), sum(f in m for _, m in mine) - len(gone),
                    sum(m == {f} for _, m in mine), sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone), f]
        out |= {(part, *k): (*v[:-1], shapley[v[-1]]) for k, v in table.items()}
    return out


def audited(spark, rows, labels):
    docs = spark.createDataFrame(
        [(*r, "x", 7, 8, b"9") for r in rows],
        "doc_id long, text string, source string, part string, mask int, n long, digest binary")
    marks = spark.createDataFrame(
        [(*r, 5, "y") for r in labels], "doc_id long, quality int, toxic int, good int, source string")
    got = filter_audit.audit(docs, marks).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COLUMNS) for r in got}
    assert len(found) == len(got)
    return found


def test_awkward_rows_against_every_order_in_turn(spark):
    long_words = " ".join(f"word{i}" for i in range(300))
    texts = [*AWKWARD, long_words, long_words, "SHOUTED " * 250, "a # b", long_words + " $",
             "A" * 2 + "b" * 98, "A" * 3 + "b" * 97, " ".join(["twin"] * 201), "x y " * 100,
             "😀" * 50 + "A", "one two   three"]
    rows = [(i, t, ["s", None, "", "é"][i % 4]) for i, t in enumerate(texts)]
    rows += [(5, AWKWARD[5], "s"), (5, AWKWARD[5], None), (None, AWKWARD[5], "s"),
             (None, "no id", None), (-3, long_words, "late"), (None, None, None)]
    labels = [(5, 1, 0), (5, 0, 1), (8, 1, 1), (9, None, 1), (12, 1, None), (13, 1, 0), (None, 1, 1),
              (9999, 1, 1)]
    assert audited(spark, rows, labels) == plain(rows, labels)


def test_no_documents_or_no_labels(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    rows = [(1, "a", "s"), (2, "a", "s")]
    assert audited(spark, rows, []) == plain(rows, [])


@pytest.mark.parametrize("n", [1, 3, 5])
def test_ranks_are_lexicographic(n):
    for k in range(n + 1):
        for rank, order in enumerate(permutations(range(n))):
            first = min(r for r, o in enumerate(permutations(range(n))) if o[:k] == order[:k])
            assert filter_audit.rank_of(order[:k], n) == first <= rank


def test_each_mask_goes_once_in_every_order():
    removed, redundant = (a.cumsum(axis=2)[:, :, :-1] for a in filter_audit.interval_ends(5))
    for mask in range(32):
        assert (removed[mask].sum(axis=0) == (mask > 0)).all()
        # Each filter that fails stands at one step of each order.
        assert ((removed + redundant)[mask].sum(axis=0) == mask.bit_count()).all()


def test_query_equals_its_sql(spark):
    df = QUERIES["op13_filter_audit"](spark, SF_DIR)
    assert dict(df.dtypes) == {"part": "string", "filter_order": "string", "step": "int",
                               **dict.fromkeys(COLUMNS, "bigint")}
    assert difference(df, ORACLE_SQL["op13_filter_audit"], SF_DIR) == ""
