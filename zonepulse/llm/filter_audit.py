"""What every order of a set of filters removes, from one count per failure mask.

A document matters only by the set of filters that it fails, its mask.  In the lexicographic order
of the permutations, those that begin with the same letters are neighbours: a prefix of ``k`` of
``n`` filters covers ``(n - k)!`` ranks.  A mask is removed at step ``k`` by the prefixes whose last
filter is its first one that fails, so its count goes up at the first rank of each such interval
and down behind the last; one running sum over the ranks then gives every order its totals.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.tables import written

# What separates words, and which characters are special.
_BLANKS = r"[\x20\x09-\x0D]+"
_SPECIAL = r"[#$%&*|]"
FILTERS = "ABCDE"


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides alone, by letter.

    Words are maximal runs without blanks and are compared by case; lengths are in code points.
    """
    words = F.filter(F.split(text, _BLANKS), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": count < 200,
        "B": 100 * distinct.cast("long") < 50 * count.cast("long"),
        "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike(_SPECIAL),
    }


def masks(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part`` (the source, empty if null) and ``mask`` of every row.

    Bit ``i`` is set where the filter ``FILTERS[i]`` fails.  The last filter is the one of copies:
    a row fails it if a smaller id has the same text anywhere in the table.  A null id is smaller
    than none and greater than none.  Texts are compared by their SHA-256 and length, the least id
    is found with a partial minimum in every task, and only rows of a few bytes are shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       text.alias("text"))
    decided = rows.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
        sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(
            text_filters(F.col("text")).values())), F.lit(0)).alias("mask"))
    decided = written(decided, "masks")
    least = decided.groupBy("digest").agg(F.min("doc_id").alias("least"),
                                          F.count(F.lit(1)).alias("rows"))
    # A text that only one row has is no copy; what is left to join is the groups of copies.
    copied = least.filter("rows > 1").select("digest", "least")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return decided.join(copied, "digest", "left").select(
        "doc_id", "part",
        (F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))


def mask_counts(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: rows, and those whose id a label calls good or toxic.

    Of contradicting labels of one id the greater counts.  Ids without a label, and null ids, are
    neither good nor toxic.
    """
    marked = (labels.filter(F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
              .groupBy("doc_id").agg(F.max(F.col("quality") == 1).cast("long").alias("good"),
                                     F.max(F.col("toxic") == 1).cast("long").alias("toxic")))
    return (masked.join(marked, "doc_id", "left").groupBy("part", "mask")
            .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))


def rank_of(prefix: tuple[int, ...], n: int) -> int:
    """The lexicographic rank of the first permutation of ``range(n)`` that begins with ``prefix``.

    Its Lehmer digits count the smaller elements that are still free.
    """
    free, rank = list(range(n)), 0
    for place, element in enumerate(prefix):
        rank += free.index(element) * factorial(n - 1 - place)
        free.remove(element)
    return rank


@lru_cache(maxsize=4)
def interval_ends(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two difference arrays of shape ``(2 ** n masks, n steps, n! + 1 ranks)``.

    The first marks the orders in which a mask is removed at a step, the second those in which the
    step's filter would fail but the mask is gone: +1 at the first rank of an interval, -1 behind
    its last.
    """
    removed = np.zeros((1 << n, n, factorial(n) + 1), np.int64)
    redundant = np.zeros_like(removed)
    masks_ = np.arange(1 << n)
    for k in range(1, n + 1):
        for prefix in permutations(range(n), k):
            start = rank_of(prefix, n)
            end = start + factorial(n - k)
            earlier = sum(1 << f for f in prefix[:-1])
            fails = masks_[masks_ >> prefix[-1] & 1 == 1]
            gone = (fails & earlier) != 0
            for array, chosen in ((removed, fails[~gone]), (redundant, fails[gone])):
                array[chosen, k - 1, start] += 1
                array[chosen, k - 1, end] -= 1
    return removed, redundant


def _totals(counts: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """Totals per (part, rank, step) from ``counts`` of shape ``(parts, masks, 3)``."""
    removed, redundant = interval_ends(n)

    def by_rank(ends: np.ndarray, measure: int) -> np.ndarray:
        added = np.tensordot(counts[:, :, measure], ends, axes=(1, 0))
        return np.cumsum(added, axis=2)[:, :, :-1].transpose(0, 2, 1)

    gone = by_rank(removed, 0)
    orders = np.array(list(permutations(range(n))))
    alone = counts[:, [1 << f for f in range(n)], 0]
    shapley = np.stack([(gone * (orders == f)).sum(axis=(1, 2)) for f in range(n)], axis=1)
    return {
        "kept": counts[:, :, 0].sum(axis=1)[:, None, None] - np.cumsum(gone, axis=2),
        "removed": gone,
        "redundant": by_rank(redundant, 0),
        "unique_fails": alone[:, orders],
        "good_lost": by_rank(removed, 1),
        "toxic_lost": by_rank(removed, 2),
        "shapley": shapley[:, orders],
    }


_MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in _MEASURES)
# Parts whose totals are worked out at once; a part is 600 rows of seven numbers.
_PARTS = 64


def every_order(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, zeros included, from ``mask_counts``.

    A part reaches its task as at most ``2 ** len(filters)`` counts, whatever number of rows it has.
    An empty table has no parts and gives no rows.
    """
    n = len(filters)
    orders = ["".join(filters[f] for f in p) for p in permutations(range(n))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _PARTS):
                some = batch.slice(start, _PARTS)
                table = np.zeros((some.num_rows, 1 << n, 3), np.int64)
                for i, listed in enumerate(some["counts"].to_pylist()):
                    for c in listed:
                        table[i, c["mask"]] = c["n"], c["good"], c["toxic"]
                totals = _totals(table, n)
                each = len(orders) * n
                yield pa.RecordBatch.from_arrays(
                    [some["part"].take(pa.array(np.repeat(np.arange(some.num_rows), each))),
                     pa.array([o for o in orders for _ in range(n)] * some.num_rows),
                     pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32),
                                      some.num_rows * len(orders))),
                     *[pa.array(np.ascontiguousarray(totals[m]).reshape(-1)) for m in _MEASURES]],
                    ["part", "filter_order", "step", *_MEASURES])

    rows = counts.groupBy("part").agg(F.collect_list(F.struct(
        F.col("mask").cast("int").alias("mask"), "n", "good", "toxic")).alias("counts"))
    return rows.mapInArrow(run, _SCHEMA)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All orders of the five filters over ``docs``, per source.

    Columns ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``.  Null texts count as empty, null sources as the part of the empty
    string, repeated rows count each, other columns are not looked at, and no documents give no
    rows.
    """
    return every_order(mask_counts(masks(docs), labels))


def oracle_sql() -> str:
    """The same rows, order by order, without masks or ranks."""
    orders = ", ".join(f"('{''.join(p)}')" for p in permutations(FILTERS))
    fails = "CASE {} {} END"

    def by_letter(letter: str) -> str:
        return fails.format(letter, " ".join(f"WHEN '{f}' THEN f.{f}" for f in FILTERS))

    def before(alias: str) -> str:
        return " OR ".join(
            f"({alias}.step > {k} AND {by_letter(f'substr({alias}.filter_order, {k}, 1)')})"
            for k in range(1, len(FILTERS)))

    words = r"regexp_extract_all(body, '[^\x20\x09-\x0D]+')"
    return rf"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
first_ids AS (SELECT body, min(doc_id) AS least FROM texts GROUP BY body),
words AS (SELECT doc_id, part, body, {words} AS listed FROM texts),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
           max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
judged AS (
    SELECT w.doc_id, w.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
           len(w.listed) < 200 AS A,
           100 * len(list_distinct(w.listed)) < 50 * len(w.listed) AS B,
           100 * length(regexp_replace(w.body, '[^A-Z]', '', 'g')) > 2 * length(w.body) AS C,
           regexp_matches(w.body, '[#$%&*|]') AS D,
           coalesce(w.doc_id > i.least, false) AS E
    FROM words w JOIN first_ids i ON i.body = w.body LEFT JOIN marks m ON m.doc_id = w.doc_id),
steps AS (
    SELECT o.filter_order, s.step, substr(o.filter_order, s.step, 1) AS letter
    FROM (VALUES {orders}) o(filter_order), range(1, {len(FILTERS) + 1}) s(step)),
outcomes AS (
    SELECT f.part, s.filter_order, s.step, s.letter, f.good, f.toxic,
           {by_letter('s.letter')} AS fails, ({before('s')}) AS gone,
           f.A::INT + f.B::INT + f.C::INT + f.D::INT + f.E::INT AS failures
    FROM judged f, steps s),
totals AS (
    SELECT part, filter_order, step, letter,
           count(*) FILTER (NOT gone AND NOT fails) AS kept,
           count(*) FILTER (fails AND NOT gone) AS removed,
           count(*) FILTER (fails AND gone) AS redundant,
           count(*) FILTER (fails AND failures = 1) AS unique_fails,
           count(*) FILTER (fails AND NOT gone AND good = 1) AS good_lost,
           count(*) FILTER (fails AND NOT gone AND toxic = 1) AS toxic_lost
    FROM outcomes GROUP BY part, filter_order, step, letter),
shares AS (SELECT part, letter, sum(removed)::BIGINT AS shapley FROM totals GROUP BY part, letter)
SELECT t.part, t.filter_order, t.step::INT AS step, t.kept, t.removed, t.redundant,
       t.unique_fails, t.good_lost, t.toxic_lost, h.shapley
FROM totals t JOIN shares h ON h.part = t.part AND h.letter = t.letter
"""
