"""Every batch query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle.sql import ORACLE_SQL as SQL
from tests.compare import difference, oracle_rows
from zonepulse.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
BATCH = [n for n in QUERIES if not n.startswith("stream_")]


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", BATCH)
def test_batch_query(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), SQL[name], SF_DIR) == ""


@pytest.mark.parametrize("name", list(QUERIES))
def test_every_answer_has_rows(name):
    """A query that returns nothing must not pass for one that agrees."""
    assert oracle_rows(SQL[name], SF_DIR)[1]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["window_start", "window_end", "window_type", "zone_id"]
    assert df.count() > 0
