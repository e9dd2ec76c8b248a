from __future__ import annotations

import pytest

from tests.compare import difference
from zonepulse.llm import licences as L
from zonepulse.llm import queries


def test_against_sql(spark, sf_dir):
    name = "op9_licence_digests"
    assert difference(queries.QUERIES[name](spark, sf_dir), queries.ORACLE_SQL[name], sf_dir) == ""


@pytest.mark.parametrize("text, licence, notices", [
    (L._PERMISSION, "MIT", ""),
    ("The MIT Licence\n\nCopyright (c) 2020 Some One\n\n" + L._PERMISSION.upper(), "MIT", ""),
    ("(c) 1999 X\n" + L._PERMISSION.replace(",", " ;").replace("\n\n", "\n \n\t"), "MIT", ""),
    (L._PERMISSION + " And more.", None, ""),
    (L._BSD_HEAD + L._BSD_THIRD + L._BSD_TAIL, "BSD-3-Clause", ""),
    ("words\nReleased under the MIT License.\nwords", None, "MIT"),
    ("Licensed under the Apache Licence, version 2.0\nLicensed under CC BY-NC 4.0.", None,
     "Apache-2.0,CC-BY-NC-4.0"),
    ("this work is licensed under the GNU General Public License, version 3", "GPL-3.0", "GPL-3.0"),
    ("# SPDX-License-Identifier: MIT", "MIT", "MIT"),
    ("Copyright 2020", None, ""),
    ("nothing of the kind", None, ""),
])
def test_texts(spark, text, licence, notices):
    r = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.licence, r.notices) == (licence, notices)


def test_own_table_of_known_texts(spark):
    known = L.known_digests(spark, [("House", "Our own terms."), ("Other", "our OWN terms")])
    docs = spark.createDataFrame([(1, "our own, terms")], "doc_id long, text string")
    assert L.scan(docs, known).first().licence == "House"


def test_awkward_rows(awkward, empty):
    rows = L.scan(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r.canonical_sha256 is None and r.notices == "" for r in rows if r.doc_id in (0, 1, 2))
    assert L.scan(empty).count() == 0
