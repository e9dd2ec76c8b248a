"""Mixing towards target weights with soft domain membership.

A classifier fitted on the labelled table predicts for every document the probability that it
belongs to each domain.  Each document then gets a rate, how many times it should be seen, such
that the expected tokens per domain match the targets: nonnegative least squares, by projected
gradient steps from one copy each.  A step moves a rate by the inner product of its posteriors with
one number per domain, and not below the least rate allowed; so documents stay where they are, and
a round sums up some numbers per pair of domains.  Gaps are measured, and steps preconditioned, by
the inverse of the domains' Gram matrix, which makes a hot domain and a rare one equally steep.
"""

from __future__ import annotations

import logging
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.llm.tables import written
from zonepulse.llm.training import TRAIN_ROWS

# Words are hashed to so many buckets; the classifier's size hangs on nothing else.
BUCKETS = 1 << 15
SMOOTHING = 0.5
# Target weights are the domains' shares to this power, unless given.
TEMPERATURE = 0.5
# Gaps to reach, as shares of all tokens and of a domain's own target.
TOLERANCE, OWN_TOLERANCE = 1e-3, 1e-2
# The rounds end too when so many of them have not lowered the loss to this share of what it was.
PATIENCE, PROGRESS = 5, 0.9
# Lengths of a step that are looked at in one round.
PARTS = (1.0, 0.5, 0.25, 1 / 16, 1 / 64)
MEMORY_WORDS = 500_000

_WORD = re.compile(r"\w+")
_LOG = logging.getLogger(__name__)


class _Buckets(dict):
    """Buckets of the words a worker has met."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[word] = bucket = zlib.crc32(word.encode()) % BUCKETS
        return bucket

    def of(self, text: str | None) -> np.ndarray:
        words = _WORD.findall(text.lower()) if text else []
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    prior: np.ndarray                 # logarithms, one per domain
    weights: np.ndarray               # buckets x domains, logarithms of likelihoods
    sharpness: float = 1.0

    def posterior(self, buckets: np.ndarray) -> np.ndarray:
        """Probabilities per domain; the prior for a text without words."""
        value = self.prior + self.sharpness * self.weights[buckets].sum(axis=0)
        e = np.exp(value - value.max())
        return e / e.sum()


@dataclass(frozen=True)
class Mix:
    """A fitted mix: the classifier, the domains' numbers of each step, and how far each domain's
    expected tokens are from its target, as a share of all tokens."""
    model: DomainModel
    targets: np.ndarray
    slopes: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    least: float = 0.0
    residual: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def rates(self, posteriors: np.ndarray) -> np.ndarray:
        return rates(posteriors, self.slopes, self.least)


def rates(posteriors: np.ndarray, slopes: Sequence[np.ndarray], least: float = 0.0) -> np.ndarray:
    """Rates of at least ``least`` after the projected steps so far, from one copy each."""
    rate = np.ones(len(posteriors))
    for slope in slopes:
        rate = np.maximum(least, rate + posteriors @ slope)
    return rate


def _sample(docs: DataFrame, labels: DataFrame, domain: str, rows: int) -> DataFrame:
    usable = labels.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    share = min(1.0, rows / max(1, usable.count()))
    span = 1 << 30
    ids = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < int(share * span))
    return docs.filter(F.col(domain).isNotNull()).select(
        "doc_id", docs["text"].cast("string").alias("text"),
        docs[domain].cast("string").alias("domain")).join(F.broadcast(ids), "doc_id")


def fit_domains(docs: DataFrame, labels: DataFrame, domain: str, rows: int = TRAIN_ROWS
                ) -> DomainModel:
    """Naive Bayes over hashed words, fitted on about ``rows`` labelled documents at most.

    A third of the sample is kept back to fit the sharpness that makes its posteriors calibrated.
    Without labelled rows there is one domain, of all documents.
    """
    sample = written(_sample(docs, labels, domain, rows), "mix-sample")
    kept_back = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in batches:
            found: dict[str, Counter] = {}
            for name, text in zip(batch["domain"], batch["text"], strict=True):
                found.setdefault(name.as_py(), Counter()).update(
                    [-1, *buckets.of(text.as_py()).tolist()])
            rows_ = [(d, b, n) for d, c in found.items() for b, n in c.items()]
            columns = list(zip(*rows_, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
                 pa.array(columns[2], pa.int64())], ["domain", "bucket", "n"])

    counts = (sample.filter(~kept_back).select("domain", "text")
              .mapInArrow(count, "domain string, bucket int, n long")
              .groupBy("domain", "bucket").agg(F.sum("n").alias("n")).collect())
    names = tuple(sorted({r.domain for r in counts}))
    if not names:
        return DomainModel(("all",), np.zeros(1), np.zeros((BUCKETS, 1)))
    place = {d: i for i, d in enumerate(names)}
    documents = np.zeros(len(names))
    seen = np.full((BUCKETS, len(names)), SMOOTHING)
    for r in counts:
        if r.bucket < 0:
            documents[place[r.domain]] = r.n
        else:
            seen[r.bucket, place[r.domain]] += r.n
    weights = np.log(seen / seen.sum(axis=0))
    weights -= weights.mean(axis=1, keepdims=True)
    model = DomainModel(names, np.log(documents / documents.sum()), weights)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in batches:
            sums = [weights[buckets.of(t.as_py())].sum(axis=0).tolist() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["domain"], pa.array(sums, pa.list_(pa.float64()))], ["domain", "sums"])

    rest = [r for r in sample.filter(kept_back).select("domain", "text").mapInArrow(
        evidence, "domain string, sums array<double>").collect() if r.domain in place]
    if not rest:
        return model
    y = np.array([place[r.domain] for r in rest])
    sums = np.array([r.sums for r in rest])

    def loss(sharpness: float) -> float:
        value = model.prior + sharpness * sums
        value -= value.max(axis=1, keepdims=True)
        return float((np.log(np.exp(value).sum(axis=1)) - value[np.arange(len(y)), y]).mean())

    best = min(np.geomspace(1e-3, 2.0, 60), key=loss)
    return DomainModel(names, model.prior, weights, float(best))


def posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """``doc_id, n_tokens, p`` of every row; ``p`` has one probability per domain."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Buckets()
        for batch in batches:
            found = [memory.of(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(b) for b in found], pa.int64()),
                 pa.array([model.posterior(b).tolist() for b in found], pa.list_(pa.float64()))],
                ["doc_id", "n_tokens", "p"])

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, p array<double>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _looked_at(table: DataFrame, width: int, slopes: list[np.ndarray], steps: Sequence[np.ndarray],
               least: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Where each of ``steps`` would lead after ``slopes``, summed over the cluster: the expected
    tokens per domain, and the Gram matrix of the documents whose rates are free to move on."""
    size = width + width * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(steps), size))
        for batch in batches:
            p, n = _matrix(batch["p"], width), batch["n_tokens"].to_numpy().astype(float)
            now = rates(p, slopes, least)
            for k, step in enumerate(steps):
                rate = np.maximum(least, now + p @ step)
                total[k, :width] += (n * rate) @ p
                total[k, width:] += ((p * (n * (rate > least))[:, None]).T @ p).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["i", "x"])

    out = np.zeros(len(steps) * size)
    for r in (table.select("n_tokens", "p").mapInArrow(run, "i int, x double")
              .groupBy("i").agg(F.sum("x").alias("x")).collect()):
        out[r.i] = r.x
    return [(row[:width], row[width:].reshape(width, width)) for row in out.reshape(-1, size)]


def _inverse(gram: np.ndarray, cut: float) -> np.ndarray:
    return np.linalg.pinv(gram, rcond=cut, hermitian=True)


def _descend(table: DataFrame, targets: np.ndarray, now: np.ndarray, gram: np.ndarray, least: float,
             allowed: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Steps until all gaps are allowed, or the loss sinks no more; and the tokens they lead to.

    The loss is the gap measured by the inverse of the Gram matrix of all documents, in which it
    curves by one at most: a step of the whole gap never raises it, and closes it where no rate
    meets its bound.  Once rates have met it, the documents that are free to move make up less of
    the Gram matrix and may move further; so each round also looks at parts of the step that is
    preconditioned by theirs, and takes the lowest of all.
    """
    measure = _inverse(gram, 1e-9)
    free, slopes = measure, []
    losses = [float((targets - now) @ measure @ (targets - now))]
    while not (np.abs(targets - now) <= allowed).all():
        gap = targets - now
        steps = [part * (free @ gap) for part in PARTS] + [measure @ gap]
        found = _looked_at(table, len(targets), slopes, steps, least)
        heights = [float((targets - t) @ measure @ (targets - t)) for t, _ in found]
        best = int(np.argmin(heights))
        if not heights[best] < losses[-1]:
            break
        slopes.append(steps[best])
        now, free = found[best][0], _inverse(found[best][1], 1e-6)
        losses.append(heights[best])
        if len(losses) > PATIENCE and losses[-1] > PROGRESS * losses[-1 - PATIENCE]:
            break
    return slopes, now


def fit_mix(table: DataFrame, model: DomainModel, weights: Mapping[str, float] | None = None,
            budget: float | None = None) -> Mix:
    """Rates for a table from ``posteriors``.

    ``weights`` are the wanted shares per domain, by default each domain's share to the power
    ``TEMPERATURE``, which lifts small domains.  ``budget`` is the wanted number of tokens, by
    default the least at which no domain has to shrink; rates are then at least 1, so that no
    document is left out, and else at least 0.

    The rounds end when every gap is within the tolerances.  Soft posteriors cannot reach all
    targets; then they end when the loss sinks no more, and the gaps left are logged.  ``residual``
    has them in any case.
    """
    width, least = len(model.domains), 1.0 if budget is None else 0.0
    # With a bound far below, all documents are free: the first look has the whole Gram matrix.
    now, gram = _looked_at(table, width, [], [np.zeros(width)], -1.0)[0]
    if now.sum() <= 0:
        return Mix(model, now, np.zeros((0, width)), least)
    if weights is None:
        wanted = (now / now.sum()) ** TEMPERATURE
    else:
        wanted = np.array([max(0.0, weights.get(d, 0.0)) for d in model.domains])
    wanted = wanted / wanted.sum() if wanted.sum() > 0 else now / now.sum()
    if budget is None:
        present = (wanted > 0) & (now > 0)
        budget = float((now[present] / wanted[present]).max())
    targets = budget * wanted
    scale = now.sum()
    allowed = np.clip(OWN_TOLERANCE * targets, OWN_TOLERANCE * TOLERANCE * scale, TOLERANCE * scale)
    slopes, reached = _descend(table, targets, now, gram, least, allowed)
    residual = (targets - reached) / scale
    if (np.abs(residual) * scale > allowed).any():
        _LOG.warning("mix misses its targets: %s", {
            d: f"{t / scale:.4f} wanted, {r:+.4f} missing"
            for d, t, r in zip(model.domains, targets, residual, strict=True)})
    return Mix(model, targets, np.array(slopes).reshape(-1, width), least, residual)


def copies_of(rate: Column, doc_id: Column) -> Column:
    """A rate rounded up or down by a hash of the id, so that it holds on average."""
    share = F.pmod(F.xxhash64(doc_id, F.lit("mix")), F.lit(1 << 20)) / float(1 << 20)
    return F.floor(rate + share).cast("int")


def document_rates(docs: DataFrame, labels: DataFrame, domain: str = "lang",
                   weights: Mapping[str, float] | None = None, budget: float | None = None,
                   rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, n_tokens, domain, posterior, rate, copies`` of every row.

    ``domain`` is the most likely one and ``posterior`` its probability.  A null or empty text has
    no tokens, the prior as posterior, and a rate like any other; a null in the domain column only
    keeps a row out of the fit.  Rows are kept one by one, repeated ones and null ids too; an empty
    table gives no rows; other columns are not looked at.
    """
    model = fit_domains(docs, labels, domain, rows)
    table = written(posteriors(docs, model), "posteriors")
    mix = fit_mix(table, model, weights, budget)
    width = len(model.domains)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch["p"], width)
            top = p.argmax(axis=1) if len(p) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_tokens"],
                 pa.array([model.domains[i] for i in top], pa.string()),
                 pa.array(p[np.arange(len(p)), top]), pa.array(mix.rates(p))],
                ["doc_id", "n_tokens", "domain", "posterior", "rate"])

    rated = table.mapInArrow(run, f"doc_id {kind}, n_tokens long, domain string, "
                                  "posterior double, rate double")
    return rated.withColumn("copies", copies_of(F.col("rate"), F.col("doc_id")))


def mixed(docs: DataFrame, labels: DataFrame, domain: str = "lang",
          weights: Mapping[str, float] | None = None, budget: float | None = None,
          rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with every row repeated as often as its rate says; columns stay.

    The rate is found again from the text in the same pass that repeats it, so no text is moved.
    """
    model = fit_domains(docs, labels, domain, rows)
    mix = fit_mix(written(posteriors(docs, model), "posteriors"), model, weights, budget)
    rate = "_mix_rate"
    while rate in docs.columns:
        rate += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Buckets()
        for batch in batches:
            p = np.array([model.posterior(memory.of(t.as_py())) for t in batch["text"]]
                         ).reshape(-1, len(model.domains))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(mix.rates(p))], [*batch.schema.names, rate])

    rated = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(rate, T.DoubleType())]))
    times = F.array_repeat(F.lit(0), copies_of(F.col(rate), F.col("doc_id")))
    return rated.withColumn(rate, F.explode(times)).drop(rate)
