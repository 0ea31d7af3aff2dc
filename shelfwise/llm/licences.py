"""Operator 7, licence scan: digests of canonical texts, looked up among the digests of known licences and notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import lower_ascii, table

#: Spellings that count as one.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("favour", "favor"),
    ("merchantibility", "merchantability"),
    ("http://", "https://"),
    ("&", " and "),
]
#: Fixed patterns: lines of copyright holders, and what separates words within a line.
HOLDER = r"(^|\n)[ \t*#/;-]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*"
BETWEEN = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Public licence texts and the notices that stand for a licence.
KNOWN = [
    (
        "MIT",
        "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _AS_IS,
    ),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _AS_IS),
    ("BSD-2-Clause", _BSD + _BSD_END),
    (
        "BSD-3-Clause",
        _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. " + _BSD_END,
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
]


def canonical_lines(text: Column) -> Column:
    """Lines in canonical form, empty ones left out: lower case, one spelling, no punctuation, no copyright lines."""
    out = F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), HOLDER, "$1")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, BETWEEN, " ")
    return F.filter(F.transform(F.split(out, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def known_digests(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """(digest, license_id): one row a digest; the smaller id if two licences have one canonical text."""
    rows = spark.createDataFrame(known, "license_id string, text string")
    canon = F.array_join(canonical_lines(F.col("text")), " ")
    return rows.where(canon != "").groupBy(F.sha2(canon, 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: list[tuple[str, str]] = KNOWN, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_lines, whole_license (the whole text is a known one, or null), n_notices (lines
    that are), licenses (their ids and the whole one's, distinct, sorted, comma-joined; empty if none).

    The whole text and each of its lines are looked up entire; nothing is searched within them. Null and empty texts,
    and texts of copyright lines only, match nothing. Repeated rows are rows each; other columns are not returned.

    Digests of one document lie together, so the sums per row combine before the shuffle; the table of known digests
    has at most one row an entry of `known`, a list in the program.
    """
    lines = docs.select(F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("lines")).withColumn("row", F.monotonically_increasing_id())
    whole = F.struct(F.sha2(F.array_join("lines", " "), 256).alias("digest"), F.lit(True).alias("whole"))
    parts = F.transform("lines", lambda x: F.struct(F.sha2(x, 256).alias("digest"), F.lit(False).alias("whole")))
    units = lines.select("doc_id", "row", F.size("lines").cast("long").alias("n_lines"), F.explode(F.concat(F.array(whole), parts)).alias("u"))
    found = units.select("doc_id", "row", "n_lines", "u.*").join(F.broadcast(known_digests(docs.sparkSession, known)), "digest", "left")
    got = found.groupBy("row", "doc_id", "n_lines").agg(
        F.max(F.when(F.col("whole"), F.col("license_id"))).alias("whole_license"),
        F.count(F.when(~F.col("whole"), F.col("license_id"))).alias("n_notices"),
        F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("licenses"),
    )
    return got.drop("row")


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def canon(text: str) -> str:
        out = f"regexp_replace(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {quoted(HOLDER)}, '\\1', 'g')"
        for old, new in SPELLINGS:
            out = f"replace({out}, {quoted(old)}, {quoted(new)})"
        out = f"regexp_replace({out}, {quoted(BETWEEN)}, ' ', 'g')"
        return f"list_filter(list_transform(string_split({out}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"

    rows = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in KNOWN)
    return f"""
    WITH known AS (
        SELECT array_to_string({canon("body")}, ' ') AS canon, min(id) AS id FROM (VALUES {rows}) AS v(id, body) GROUP BY ALL
    ),
    doc AS MATERIALIZED (SELECT doc_id, {canon("text")} AS lines FROM documents),
    line AS (
        SELECT doc_id, count(*) AS n, string_agg(id, ',') AS ids
        FROM (SELECT doc_id, unnest(lines) AS line FROM doc) JOIN known ON line = canon GROUP BY doc_id
    )
    SELECT doc.doc_id, len(lines)::BIGINT AS n_lines, known.id AS whole_license, coalesce(n, 0)::BIGINT AS n_notices,
           array_to_string(list_sort(list_distinct(list_filter(list_concat(string_split(coalesce(ids, ''), ','), [known.id]), lambda x: x <> ''))), ',') AS licenses
    FROM doc LEFT JOIN known ON array_to_string(lines, ' ') = canon LEFT JOIN line ON line.doc_id = doc.doc_id"""


SQL = _sql()
