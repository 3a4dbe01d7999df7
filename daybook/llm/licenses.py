"""License scans: canonical text digests looked up among those of known licences.

A text is brought to a canonical form (lower case, copyright lines dropped,
equivalent spellings made one, punctuation and white space reduced to single
spaces) and digested; the digest is hash-joined to the digests of known
licence texts, a table (by default KNOWN and the file known_licenses.json).
The whole text is looked up, and so is each of its lines, which finds notices
and licences written as one line.

Scale: the known table's digests are broadcast, so no text is shuffled; the
few lines found are aggregated by (doc_id, text digest) and joined back to the
rows' digests.  Defined cases: null and
empty texts match nothing; repeated rows are each reported; ties cannot occur,
as a digest belongs to one licence; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known texts by licence id, whole licences and one-line notices.
KNOWN = [
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
]
# Equivalent spellings, canonical one second, applied to lower-cased words in this order.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("non-infringement", "noninfringement"), ("merchantibility", "merchantability"), ("copyright holder's", "copyright holders"),
    ("favour", "favor"), ("organisation", "organization"), ("whilst", "while"),
]
COPYRIGHT_LINE = r"(?m)^[^\S\n]*(?:copyright\b|©|\(c\)\s)[^\n]*$"
#: The SQL below looks up lines that name a licence and are no longer than this; ``scan`` looks up every line.
NOTICE_CHARS = 400


def canonical(text: Column) -> Column:
    """Canonical form: single-spaced letters and digits."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.btrim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_texts(spark) -> DataFrame:
    """license, body: KNOWN and the whole texts and standard notices of the file beside this module."""
    listed = json.loads((Path(__file__).parent / "known_licenses.json").read_text(encoding="utf-8"))
    return spark.createDataFrame(KNOWN + [(x["license"], x["body"]) for x in listed], "license string, body string")


def known_digests(texts: DataFrame) -> DataFrame:
    """known (digest), license of a table of known texts; of several licences of one digest the first by name.

    Each text counts as listed and as one line without its copyright notices: ``canonical`` drops every line that
    starts with the word copyright, so a listed line "COPYRIGHT HOLDERS BE LIABLE" is missing from the first.
    """
    one_line = F.translate(F.regexp_replace("body", r"(?mi)^[^\S\n]*(?:copyright\s+(?:\(c\)|©|[0-9])|©|\(c\)\s)[^\n]*$", " "), "\n", " ")
    return texts.select("license", F.explode(F.array("body", one_line)).alias("body")).groupBy(digest(F.col("body")).alias("known")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """doc_id, digest (of the whole text; null if nothing is left of it), license (or null), notices (ids, sorted, comma-joined)."""
    known = F.broadcast(known_digests(known_texts(docs.sparkSession) if texts is None else texts))
    row = F.md5(F.coalesce("text", F.lit("")))
    lines = F.array_distinct(F.transform(F.split("text", "\n"), digest))
    found = docs.select(F.col("doc_id").alias("n_id"), row.alias("n_key"), F.explode(lines).alias("line"))
    notices = found.join(known, F.col("line") == F.col("known")).groupBy("n_id", "n_key").agg(
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"))
    rows = docs.select("doc_id", row.alias("row_key"), F.when(
        canonical(F.col("text")) != "", digest(F.col("text"))).alias("digest"))
    return (
        rows.join(known, F.col("digest") == F.col("known"), "left")
        .join(notices, (F.col("row_key") == F.col("n_key")) & F.col("doc_id").eqNullSafe(F.col("n_id")), "left")
        .select("doc_id", "digest", "license", F.coalesce("notices", F.lit("")).alias("notices"))
    )


def op6_licenses(docs: DataFrame) -> DataFrame:
    return scan(docs)


def _canonical_sql(column: str) -> str:
    out = f"regexp_replace(lower({column}), '(?m)^[^\\S\\n]*(?:copyright\\b|©|\\(c\\)\\s)[^\\n]*$', ' ', 'g')"
    for old, new in SPELLINGS:
        out = "replace(" + out + ", '" + old.replace("'", "''") + "', '" + new.replace("'", "''") + "')"
    return f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


ORACLE = f"""
WITH k AS (
  SELECT DISTINCT sha256({_canonical_sql('body')}) AS known, license
  FROM (VALUES {', '.join("('" + i + "', '" + b.replace("'", "''") + "')" for i, b in KNOWN)}) AS t(license, body)
), d AS (SELECT row_number() OVER () AS r, doc_id, text, {_canonical_sql('text')} AS c FROM documents
), l AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d
), n AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM l JOIN k ON sha256({_canonical_sql('line')}) = known
  WHERE length(line) <= {NOTICE_CHARS} AND regexp_matches(line, '(?i)licen[cs]e') GROUP BY r
)
SELECT doc_id, CASE WHEN c <> '' THEN sha256(c) END AS digest, license, coalesce(notices, '') AS notices
FROM d LEFT JOIN k ON c <> '' AND sha256(c) = known LEFT JOIN n USING (r)
"""
