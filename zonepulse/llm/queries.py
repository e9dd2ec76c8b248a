"""The operators of this package as registered queries, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm import byte_bpe, exact_substrings, filter_audit, licences, merkle, mixing, one_bit_search, packing, pseudonyms, quality, simhash, syncmers, toxicity
from zonepulse.llm.tables import read


# A real run takes its key from a secret store; this one is for the registered queries.
PSEUDONYM_KEY = "registered-query-key"


def op1_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_pairs(read(spark, sf_dir, "documents"))


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY, counts=True)


def op3_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_bit_search.search(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(read(spark, sf_dir, "documents"))


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_rates(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_simhash_bk_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op7_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op9_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_substrings.without_repeats(
        read(spark, sf_dir, "documents"), with_bytes=False).drop("kept")


def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.check_tampered(read(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_syncmer_fingerprints, op2_feistel_pseudonyms, op3_one_bit_codes, op4_byte_bpe, op5_soft_mixing, op6_simhash_bk_tree, op7_toxic_passages, op8_quality_rules,
                                     op9_licence_digests, op10_suffix_array_dedup, op11_best_two_fit, op12_merkle_manifest,
                                     op13_filter_audit)}
ORACLE_SQL: dict[str, str] = {
    "op9_licence_digests": licences.oracle_sql(),
    "op12_merkle_manifest": merkle.oracle_sql(),
    "op13_filter_audit": filter_audit.oracle_sql(),
}
