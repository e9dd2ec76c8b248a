"""Licence scans by digests of canonical texts.

A text is brought into a canonical form: copyright lines go, letters become lower-case, spellings
that licences use alike become one, and punctuation and white space become single blanks.  The
SHA-256 digest of that form is looked up, with a hash join, among the digests of known licences:
once for a document as a whole, which finds documents that are a licence, and once for each of its
lines, which finds notices that name one.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.llm.syncmers import let

# Marks of comments before a copyright line, and its beginnings, in lower case.
COMMENT_MARKS = " \t#*/;-"
COPYRIGHT_STARTS = ["copyright", "(c)", "©", "all rights reserved"]

# Spellings that count as equal, in lower case, as a licence list matches them; fixed values.
EQUIVALENT = [
    ("licence", "license"),
    ("acknowledgement", "acknowledgment"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("per cent", "percent"),
    ("initialise", "initialize"),
    ("organisation", "organization"),
    ("analogue", "analog"),
    ("judgement", "judgment"),
    ("http://", "https://"),
    ("&", " and "),
    ("version 2.0", "2.0"),
    ("version 3", "3"),
    ("version 2", "2"),
    ("version 4.0", "4.0"),
]

# Short licences in full; fixed values.
_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:\n\nThe above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
    "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
    "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.")
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted{notice}.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
    "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
    "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT "
    "OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:\n\n1. Redistributions of source code must "
    "retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.\n\n")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission.\n\n")
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE.")

FULL_TEXTS: list[tuple[str, str]] = [
    ("MIT", _PERMISSION),
    ("MIT", "MIT License\n\n" + _PERMISSION),
    ("MIT", "The MIT License\n\n" + _PERMISSION),
    ("MIT", "The MIT License (MIT)\n\n" + _PERMISSION),
    ("ISC", _ISC_GRANT.format(notice=", provided that the above copyright notice and this "
                                     "permission notice appear in all copies")),
    ("ISC", "ISC License\n\n" + _ISC_GRANT.format(notice=", provided that the above copyright "
                                                  "notice and this permission notice appear in "
                                                  "all copies")),
    ("0BSD", _ISC_GRANT.format(notice="")),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
]

# Names by which notices call licences; fixed values.
NAMES: dict[str, list[str]] = {
    "MIT": ["MIT License"],
    "ISC": ["ISC License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0-1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "CC-BY-4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "CC-BY-NC-4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "CC-BY-ND-4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"],
}
_SUBJECTS = ["", "This work is ", "This file is ", "This software is ", "This program is ",
             "This project is ", "This document is "]
_VERBS = ["licensed", "released", "distributed", "available", "published", "made available"]


def known_texts() -> list[tuple[str, str]]:
    """``(licence, text)``: short licences in full, and notices made from names."""
    notices = [(licence, f"{subject}{verb} under {article}{name}")
               for licence, names in NAMES.items() for name in names for subject in _SUBJECTS
               for verb in _VERBS for article in ("", "the ", "a ", "the terms of the ")]
    tags = [(licence, f"SPDX-License-Identifier: {licence}{suffix}")
            for licence in NAMES for suffix in ("", "-only", "-or-later")]
    return [*FULL_TEXTS, *notices, *tags]


def canonical_lines(text: Column) -> Column:
    """The canonical form of every line that has one, in order.

    Their concatenation with blanks is that of the text, for a line's end is white space.
    """
    plain = F.lower(F.coalesce(text, F.lit("")))
    for spelling, one in EQUIVALENT:
        plain = F.replace(plain, F.lit(spelling), F.lit(one))

    def kept(line: Column) -> Column:
        start = F.ltrim(line, F.lit(COMMENT_MARKS))
        return ~reduce(or_, [start.startswith(s) for s in COPYRIGHT_STARTS])

    forms = F.transform(F.filter(F.split(plain, "\n"), kept), lambda line: F.trim(
        F.regexp_replace(line, r"[^\p{L}\p{N}]+", " ")))
    return F.filter(forms, lambda form: form != "")


def digest(lines: Column) -> Column:
    """SHA-256 of the canonical form of a text, from its lines'; null if there are none."""
    return F.when(F.size(lines) > 0, F.sha2(F.array_join(lines, " "), 256))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``digest, licence`` of known texts; of licences with one digest the first by name counts."""
    schema = T.StructType([T.StructField("licence", T.StringType()),
                           T.StructField("text", T.StringType())])
    rows = spark.createDataFrame(known if known is not None else known_texts(), schema)
    return (rows.select(digest(canonical_lines(F.col("text"))).alias("digest"), "licence")
            .filter(F.col("digest").isNotNull())
            .groupBy("digest").agg(F.min("licence").alias("licence")))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id, canonical_sha256, licence, notices`` of every row.

    ``licence`` is that of the whole text, null if it is none; ``notices`` lists the licences that
    single lines name, in order, joined by commas, empty if there are none.  ``known`` is a table
    of ``digest, licence``.  Null and empty texts have no digest and no notices; rows are kept one
    by one, repeated ones and null ids too; other columns are not looked at.
    """
    if known is None:
        # The built-in table is a constant of this module, of less than a megabyte.
        known = F.broadcast(known_digests(docs.sparkSession))
    text = docs["text"].cast("string")

    def units(lines: Column) -> Column:
        whole = F.array(F.struct(F.lit(True).alias("whole"), digest(lines).alias("digest")))
        single = F.transform(F.array_distinct(lines), lambda line: F.struct(
            F.lit(False).alias("whole"), F.sha2(line, 256).alias("digest")))
        return F.concat(whole, single)

    found = (
        docs.select("doc_id", F.xxhash64(text).alias("_text"),
                    F.explode(let(canonical_lines(text), units)).alias("u"))
        .select("doc_id", "_text", "u.whole", "u.digest").join(known, "digest", "left")
        .filter(F.col("whole") | F.col("licence").isNotNull()))
    by_text = found.groupBy("doc_id", "_text").agg(
        F.count_if("whole").alias("times"),
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("canonical_sha256"),
        F.max(F.when(F.col("whole"), F.col("licence"))).alias("licence"),
        F.array_join(F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("licence")))), ",")
        .alias("notices"))
    # Rows that repeat an id and its text come out as often as they went in.
    return by_text.select(
        "doc_id", "canonical_sha256", "licence", "notices",
        F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))).alias("_copy")).drop("_copy")


def oracle_sql() -> str:
    """The same as DuckDB SQL over ``documents``."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def form(column: str) -> str:
        sql = f"lower({column})"
        for spelling, one in EQUIVALENT:
            sql = f"replace({sql}, {quoted(spelling)}, {quoted(one)})"
        starts = "|".join(s.replace("(", "\\(").replace(")", "\\)") for s in COPYRIGHT_STARTS)
        line = f"(?m)^[{COMMENT_MARKS}]*(?:{starts})[^\n]*$"
        sql = f"regexp_replace({sql}, {quoted(line)}, '', 'g')"
        sql = f"trim(regexp_replace({sql}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        return f"nullif({sql}, '')"

    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known_texts())
    return f"""
WITH known_texts(licence, body) AS (VALUES {values}),
known AS (SELECT sha256({form('body')}) AS digest, min(licence) AS licence FROM known_texts GROUP BY 1),
lines AS (SELECT doc_id, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM documents),
notices AS (
  SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
  FROM (SELECT doc_id, sha256({form('line')}) AS digest FROM lines) JOIN known USING (digest)
  GROUP BY doc_id),
whole AS (SELECT doc_id, sha256({form("coalesce(text, '')")}) AS digest FROM documents)
SELECT doc_id, digest AS canonical_sha256, licence, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known USING (digest) LEFT JOIN notices USING (doc_id)
"""
