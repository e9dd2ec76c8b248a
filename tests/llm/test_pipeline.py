from __future__ import annotations

import tiktoken
import public_tokenizers
import pytest

import corpus_pipeline
from tests.llm.test_simhash import groups, slow_fingerprint
from zonepulse.llm import byte_bpe, simhash, toxicity
from zonepulse.llm import mixing, pseudonyms
from zonepulse.llm.queries import PSEUDONYM_KEY, QUERIES


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash", "pseudonyms", "mixing", "byte_bpe"]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_run_against_a_plain_version(spark, sf_dir, documents, labels):
    """Every decision again, document by document on the driver."""
    docs = {r.doc_id: r for r in documents.collect()}
    model = toxicity.fit(documents, labels)
    scorer = toxicity._Scorer(model.weights)
    clean = {}
    for i, r in docs.items():
        n, found = scorer.segment_scores(r.text)
        if model.probability(model.evidence(found, n)) < 0.5:
            clean[i] = r
    first = groups([(i, slow_fingerprint(r.text)) for i, r in clean.items()])
    kept = [r for i, r in clean.items() if first[i] == i]
    frame = spark.createDataFrame(kept, documents.schema)
    replaced = {r.doc_id: r.text for r in pseudonyms.pseudonymise(frame, PSEUDONYM_KEY).collect()}
    mixed = spark.createDataFrame(
        [(r.doc_id, replaced[r.doc_id], r.lang) for r in kept], "doc_id long, text string, lang string")
    copies = {r.doc_id: r.copies for r in mixing.document_rates(mixed, labels).collect()}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=byte_bpe.read_ranks(byte_bpe.RANK_FILE))
    want = sorted((i, library.encode_ordinary(replaced[i])) for i, n in copies.items()
                  for _ in range(n))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in got) == want
    assert all(r.exact and r.n_tokens == len(r.ids) for r in got)


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_the_columns_and_take_awkward_rows(spark, sf_dir, documents, awkward, k):
    schema = documents.schema
    rows = [(r.doc_id, r.text, None, None, None) for r in awkward.collect()]
    df = spark.createDataFrame(rows, schema)
    out = corpus_pipeline.STAGES[k][1](spark, df, sf_dir)
    assert out.columns == documents.columns
    assert out.count() > 0
    assert corpus_pipeline.STAGES[k][1](spark, df.limit(0), sf_dir).count() == 0


def test_an_empty_labels_table_rejects_no_document(spark, documents, labels, tmp_path):
    some = documents.limit(40)
    some.write.parquet(str(tmp_path / "documents.parquet"))
    labels.limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r.doc_id for r in simhash.keep_first(spark.read.parquet(
        str(tmp_path / "documents.parquet"))).select("doc_id").collect()}
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()}
    assert got == kept and len(got) > 30
