"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled rows a classifier is fitted on at most (in expectation); the only bound on training.
TRAIN_ROWS = 30_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column,
                    rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, ``text`` and ``y`` (0 or 1) of about ``rows`` labelled documents at most.

    ``allowed`` is a condition on ``doc_id``.  Which rows are taken hangs on a hash of the id, so
    every run takes the same.  Rows with a null id or label are left out; of contradicting labels
    of one id the greatest counts.  The sample's ids are broadcast, being bounded by ``rows``.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & allowed)
    share = min(1.0, rows / max(1, usable.count()))
    span = 1 << 30
    taken = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < int(share * span))
    ids = taken.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y"))
    return docs.select("doc_id", F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
                       ).join(F.broadcast(ids), "doc_id")
