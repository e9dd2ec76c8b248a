"""A training corpus from raw documents: toxic texts out, one of each near-duplicate group, personal
data replaced, languages mixed to target weights, texts encoded as tokens.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm import byte_bpe, mixing, pseudonyms, simhash, toxicity
from zonepulse.llm.queries import PSEUDONYM_KEY
from zonepulse.llm.tables import read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms and the length brought up to date."""
    replaced = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their rates; small languages are lifted and none is left out."""
    return mixing.mixed(docs, read(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its very bytes."""
    return byte_bpe.encode_checked(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("pseudonyms", replace_personal_data),
    ("mixing", mix),
    ("byte_bpe", encode),
]

# Fitted models and hashes: no SQL says the same; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
