"""Toxic passages as maximal scoring segments of token log-odds.

A word scores the log-odds of meeting it in a toxic rather than a clean document, under a Dirichlet
prior, shrunk towards zero by its standard error: above zero where it speaks for a toxic text, below
where it speaks for a clean one.  A longer word whose beginning speaks for a toxic text scores as
that.  Words that tell nothing score a small negative constant.  The scan of Ruzzo and Tompa finds
every maximal segment in linear time.  What scores chance alone gives in clean text follows an extreme-value law (Karlin and Altschul): the number of
segments of score S or more expected in n tokens is K n exp(-lambda S).  Lambda comes from the
scores' distribution in clean text, K from the best segments of clean documents.  A segment is a
passage if that expectation is small; a document's score is a logistic function of how unlikely its
best segments are together, fitted on labelled rows that the weights have not seen.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.tables import held_out, written
from zonepulse.llm.training import TRAIN_ROWS, labelled_sample

FOLDS, HELD_OUT = 5, 0
# Dirichlet prior: so many observations per word and class, besides its share of the background.
PRIOR_FLAT, PRIOR_BACKGROUND = 0.5, 100.0
# Standard errors that a log-odds is moved towards zero.
SHRINK = 1.64
# Score of a word that tells nothing; ends a passage after some clean words.
CLEAN_SCORE = -0.5
# Best segments per document that the fit of the last step looks at.
FIT_SEGMENTS = 64
# Passages expected by chance in a document, below which a segment is reported.
MAX_EXPECTED = 0.01

# Lengths of the beginnings of longer words that count as tokens too (compounds, endings).
PREFIXES = range(4, 9)
# Words whose score a worker remembers before it starts afresh.
MEMORY_WORDS = 500_000

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    rate: float          # lambda
    factor: float        # K
    intercept: float
    slope: float

    def surprise(self, score: float, tokens: int) -> float:
        """Negative logarithm of the number of segments that good expected by chance."""
        return self.rate * score - math.log(self.factor * tokens)

    def evidence(self, scores: Sequence[float], tokens: int) -> float:
        """How far the best segments together are beyond chance; 0 if not at all.

        By the sum statistic of Karlin and Altschul (1993): the chance that the surprises of the
        best r segments sum to x or more is about exp(-x) x^(r-1) / (r! (r-1)!).  The r for which
        that is least counts, for a price of log 2 per further segment.
        """
        best, total = 0.0, 0.0
        found = sorted((self.surprise(s, tokens) for s in scores), reverse=True)
        for r, one in enumerate(found, 1):
            total += one
            if one <= 0 or total <= 0:
                break
            log_chance = (-total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
                          + (r - 1) * math.log(2))
            best = max(best, -log_chance)
        return best

    @property
    def tells(self) -> bool:
        """Whether scores differ between texts at all."""
        return bool(self.weights) and self.slope > 0

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-(self.intercept + self.slope * evidence)))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` in order, in linear time.

    Neighbouring scores of one sign are added up first; they never part.  No positive score gives
    no segments.
    """
    if not (scores > 0).any():
        return []
    positive = scores > 0
    starts = np.flatnonzero(np.append(True, positive[1:] != positive[:-1]))
    ends = np.append(starts[1:], len(scores))
    sums = np.add.reduceat(scores, starts)
    # Each entry: start, end, sum of all before it, sum of all up to its end, index of the nearest
    # earlier entry with a smaller sum before it.
    found: list[list] = []
    total = 0.0
    for start, end, value in zip(starts.tolist(), ends.tolist(), sums.tolist(), strict=True):
        before, total = total, total + value
        if value <= 0:
            continue
        entry = [start, end, before, total, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= entry[2]:
                j = found[j][4]
            entry[4] = j
            if j < 0 or found[j][3] >= entry[3]:
                found.append(entry)
                break
            entry = [found[j][0], entry[1], found[j][2], entry[3], -1]
            del found[j:]
    return [(s, e, right - left) for s, e, left, right, _ in found]


def tokens_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features_of(word: str) -> list[str]:
    """The word, and its beginnings marked as such."""
    return [word, *(word[:n] + "*" for n in PREFIXES if n < len(word))]


class _Scorer(dict):
    """Scores of the words a worker has met: the greatest weight above zero of the word and its
    beginnings, else the word's own below zero, else the constant."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self._weights = weights

    def __missing__(self, word: str) -> float:
        known = self._weights.get
        score = max(known(f, 0.0) for f in features_of(word))
        if score <= 0:
            score = known(word, CLEAN_SCORE)
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[word] = score
        return score

    def scores(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), float, len(tokens))

    def segments(self, tokens: list[str]) -> list[tuple[int, int, float]]:
        return maximal_segments(self.scores(tokens)) if tokens else []

    def segment_scores(self, text: str | None) -> tuple[int, list[float]]:
        """Number of tokens and the scores of all segments."""
        tokens = tokens_of(text)
        return len(tokens), [s for _, _, s in self.segments(tokens)]


def _word_counts(sample: DataFrame) -> DataFrame:
    """``word, y0, y1``: occurrences of words and beginnings in clean and toxic documents, combined
    before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [Counter(), Counter()]
            for text, y in zip(batch["text"], batch["y"], strict=True):
                words[y.as_py()].update(tokens_of(text.as_py()))
            counts: dict[str, list[int]] = {}
            for toxic, counter in enumerate(words):
                for word, n in counter.items():
                    for feature in features_of(word):
                        counts.setdefault(feature, [0, 0])[toxic] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts, pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
                 pa.array([c[1] for c in counts.values()], pa.int64())], ["word", "y0", "y1"])

    return (sample.select("text", "y").mapInArrow(run, "word string, y0 long, y1 long")
            .groupBy("word").agg(F.sum("y0").alias("y0"), F.sum("y1").alias("y1")))


def _weighted_words(counts: DataFrame) -> tuple[dict[str, float], dict[str, int], float]:
    """Weights of the words that tell toxic from clean text beyond their standard error, of either
    sign (of beginnings: above zero), their counts in clean text, and the number of clean tokens.

    Only weighted words reach the driver; the sample bounds them.
    """
    whole = ~F.col("word").endswith("*")
    n0, n1, words = counts.filter(whole).agg(
        F.sum("y0"), F.sum("y1"), F.count(F.lit(1))).first()
    if not n0 or not n1:
        return {}, {}, float(n0 or 0)
    total = n0 + n1
    prior = F.lit(PRIOR_FLAT) + PRIOR_BACKGROUND * (F.col("y0") + F.col("y1")) / F.lit(total)
    mass = PRIOR_FLAT * words + PRIOR_BACKGROUND

    def log_odds(y, n):
        return F.log((y + prior) / (F.lit(n + mass) - y - prior))

    gap = log_odds(F.col("y1"), n1) - log_odds(F.col("y0"), n0)
    error = F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior))
    weight = F.signum(gap) * F.greatest(F.abs(gap) - SHRINK * error, F.lit(0.0))
    rows = counts.select("word", "y0", weight.alias("w")).filter(
        (F.col("w") > 0) | (whole & (F.col("w") < 0))).collect()
    return {r.word: r.w for r in rows}, {r.word: r.y0 for r in rows}, float(n0)


def _rate(weights: dict[str, float], seen_clean: dict[str, int], clean: float) -> float:
    """Lambda: the positive root of E[exp(lambda * score)] = 1 over clean text."""
    if not weights:
        return 1.0
    values = np.array([weights[w] for w in weights])
    share = np.array([seen_clean[w] + 0.5 * (weights[w] > 0) for w in weights]) / (clean + 1.0)
    share /= max(1.0, share.sum())  # a word may stand beside its beginnings
    rest = max(0.0, 1.0 - share.sum())

    def excess(x: float) -> float:
        return float((share * np.exp(x * values)).sum() + rest * math.exp(x * CLEAN_SCORE) - 1.0)

    low, high = 1e-6, 20.0 / values.max()
    if excess(low) >= 0:
        return low
    while excess(high) < 0:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return low


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Intercept and slope by Newton's method; a slope below zero is set to zero."""
    beta = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - ridge * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Fit on about ``rows`` labelled documents at most, none of them held out.

    Without labels of both kinds no word has a weight and every text gets the same score;
    ``drop_toxic`` then keeps all rows.
    """
    allowed = ~held_out(F.col("doc_id"), FOLDS, HELD_OUT)
    sample = written(labelled_sample(docs, labels, "toxic", allowed, rows), "toxic-sample")
    second = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    counts = written(_word_counts(sample.filter(~second)), "toxic-words")
    weights, seen, clean = _weighted_words(counts)
    rate = _rate(weights, seen, clean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scorer = _Scorer(weights)
            found = [scorer.segment_scores(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["y"], pa.array([n for n, _ in found], pa.int64()),
                 pa.array([heapq.nlargest(FIT_SEGMENTS, s) for _, s in found],
                          pa.list_(pa.float64()))], ["y", "n", "s"])

    unseen = sample.filter(second).select("text", "y").mapInArrow(
        run, "y int, n long, s array<double>").collect()  # some numbers per row of the sample
    y = np.array([r.y for r in unseen], float)
    clean_rows = [r for r in unseen if not r.y and r.n]
    chance = sum(r.n * math.exp(-rate * max(r.s, default=0.0)) for r in clean_rows)
    factor = len(clean_rows) / chance if chance > 0 else 1.0
    model = ToxicityModel(weights, rate, factor, 0.0, 0.0)
    evidence = np.array([model.evidence(r.s, r.n) for r in unseen])
    intercept, slope = _logistic(evidence, y) if len(y) else (0.0, 0.0)
    return ToxicityModel(weights, rate, factor, intercept, slope)


def passages(docs: DataFrame, model: ToxicityModel,
             max_expected: float = MAX_EXPECTED) -> DataFrame:
    """One row per toxic passage: ``doc_id, start, end`` (characters), ``score, expected, passage``.

    A passage ends with its last word.  Null and empty texts have none.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "end", "score", "expected", "passage"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model.weights)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, value in zip(batch["doc_id"], batch["text"], strict=True):
                # Lower case may change lengths, so words are found first and lowered one by one.
                text = value.as_py() or ""
                words = list(_WORD.finditer(text))
                if not words:
                    continue
                for first, end, score in scorer.segments([w.group().lower() for w in words]):
                    expected = math.exp(-model.surprise(score, len(words)))
                    if expected <= max_expected:
                        a, b = words[first].start(), words[end - 1].end()
                        out.append((doc_id.as_py(), a, b, score, expected, text[a:b]))
            columns = list(zip(*out, strict=True)) or [()] * 6
            types = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.float64(),
                     pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, start long, end long, score double, expected double, passage string")


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Every row of ``docs`` with ``score``, ``predicted`` and ``n_passages``.

    Result: ``doc_id, held_out, score, predicted, n_passages``.  Null and empty texts get the score
    of a text without any toxic word.  Rows are kept as they are, repeated ones and null ids too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model.weights)
        for batch in batches:
            scores, counts = [], []
            for value in batch["text"]:
                tokens = tokens_of(value.as_py())
                found = [s for _, _, s in scorer.segments(tokens)]
                scores.append(model.probability(model.evidence(found, len(tokens))))
                counts.append(sum(model.surprise(s, len(tokens)) >= -math.log(MAX_EXPECTED)
                                  for s in found))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(scores, pa.float64()), pa.array(counts, pa.int64())],
                ["doc_id", "score", "n_passages"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, n_passages long")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below the threshold, all columns as they were.

    A model that gives every text the same score, as one fitted without usable labels of both kinds
    does, rejects nothing: all rows stay.
    """
    if not model.tells:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model.weights)
        for batch in batches:
            keep = []
            for value in batch["text"]:
                n, found = scorer.segment_scores(value.as_py())
                keep.append(model.probability(model.evidence(found, n)) < threshold)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
