from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"

AWKWARD = [None, "", " \n\t ", "a", "one two", "one two three four five six", "x" * 5000,
           "word " * 4000, "tie tie tie", "tie tie tie", "ünï çödé 中文字符 😀 text", "a\u0000b"]


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Null and empty texts, very long ones, ties, repeated rows, null ids, clashing columns."""
    rows = [(i, t, None, i) for i, t in enumerate(AWKWARD)]
    rows += [(5, AWKWARD[5], "x", 1), (None, "no id here at all", None, 2), (None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, score string, rank long").withColumnsRenamed(
        {"score": "fp", "rank": "key"})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, hash string")
