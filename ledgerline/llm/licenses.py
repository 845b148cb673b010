"""Licence scans: Dice coefficient over word bigrams against licence templates.

Every document is cut into segments (its lines, its paragraphs between blank
lines, and the whole text). A segment is normalised (lower case, every run of
characters other than letters and digits is one space) and compared, as a set
of word bigrams, with every template whose size can still reach the threshold:
with Dice = 2c / (a + b) and c <= min(a, b), a template of b bigrams is
possible only for b * t / (2 - t) <= a <= b * (2 - t) / t.

Only DataFrame functions run. The templates are a fixed list, so their bigram
table (a few hundred rows) is broadcast; documents are never shuffled, only
the bigrams that hit a template are, grouped by segment.

Defined results: NULL and empty texts have no segments and give no row; other
NULL columns pass through; a segment equal to a larger one of the same
document (a one-line text) is reported once, under the largest scope; repeated
rows (same doc_id and segment) give one finding; ties between templates are
all reported; very long texts are cut to segments first and long segments fall
to the size bound; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import let

THRESHOLD = 0.8

# Licence notices and licence texts as published.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "all-rights-reserved": ("All rights reserved.",),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    "bsd-2-clause": (
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
}

PARAGRAPH_GAP = r"\n[ \t\r]*\n"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def bigrams(text: Column) -> Column:
    """Distinct word bigrams of a normalised text."""
    return let(F.split(text, " "), lambda w: F.array_distinct(F.zip_with(
        F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))))


def template_table(spark, templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per template bigram: license_id, template_no, size bounds, bigram."""
    rows = [(name, no, text) for name, texts in sorted(templates.items()) for no, text in enumerate(texts)]
    sized = (spark.createDataFrame(rows, "license_id string, template_no int, text string")
             .withColumn("grams", bigrams(normalised(F.col("text"))))
             .withColumn("template_bigrams", F.size("grams")))
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    return sized.select(
        "license_id", "template_no", "template_bigrams",
        F.ceil(F.col("template_bigrams") * low - 1e-9).alias("least"),
        F.floor(F.col("template_bigrams") * high + 1e-9).alias("most"),
        F.explode("grams").alias("bigram"))


def segments(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, scope, segment_no, segment: the whole text, its paragraphs and its lines."""
    text = F.col(text_col)

    def pieces(gap: str, scope: str) -> Column:
        parts = F.split(text, gap)
        kept = F.when(F.size(parts) > 1, parts).otherwise(F.array().cast("array<string>"))
        return F.transform(kept, lambda s, i: F.struct(F.lit(scope).alias("scope"), i.alias("segment_no"), s.alias("segment")))

    # a line that is a paragraph by itself is seen as a line only
    paragraphs = F.filter(pieces(PARAGRAPH_GAP, "paragraph"), lambda x: F.instr(F.trim(x["segment"]), "\n") > 0)
    whole = F.array(F.struct(F.lit("text").alias("scope"), F.lit(0).alias("segment_no"), text.alias("segment")))
    return docs.where(text.isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.inline(F.concat(whole, paragraphs, pieces("\n", "line"))))


def scan_licenses(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Findings: one row per document segment and licence template at or above ``threshold``.

    Columns: doc_id, scope (text, paragraph, line), segment_no (from 0),
    license_id, template_no, n_bigrams, template_bigrams, shared, dice.
    """
    table = template_table(docs.sparkSession, templates, threshold)
    # the longest template bounds the segments worth cutting into words: a run of
    # n words has n - 1 bigrams at most, and repeats only lower their number, so
    # the bound on distinct bigrams is applied after they are made
    sized = (segments(docs, id_col, text_col)
             .withColumn("grams", bigrams(normalised(F.col("segment"))))
             .withColumn("n_bigrams", F.size("grams")))
    hits = (sized.select("doc_id", "scope", "segment_no", F.xxhash64("segment").alias("segment_hash"),
                         "n_bigrams", F.explode("grams").alias("bigram"))
            .join(F.broadcast(table), "bigram")
            .where(F.col("n_bigrams").between(F.col("least"), F.col("most"))))
    keys = ["doc_id", "scope", "segment_no", "segment_hash", "license_id", "template_no", "n_bigrams", "template_bigrams"]
    scored = hits.groupBy(*keys).agg(F.count_distinct("bigram").alias("shared"))
    return (scored.withColumn("dice", 2 * F.col("shared") / (F.col("n_bigrams") + F.col("template_bigrams")))
            .where(F.col("dice") >= threshold).drop("segment_hash"))


def oracle_sql(templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same findings in DuckDB, every segment against every template (no pruning)."""
    quoted = ",\n".join(
        "('{}', {}, '{}')".format(name, no, text.replace("'", "''"))
        for name, texts in sorted(templates.items()) for no, text in enumerate(texts))

    def grams(words: str) -> str:
        return (f"list_distinct(list_transform(range(1, len({words})), "
                f"lambda i: {words}[i] || ' ' || {words}[i + 1]))")

    clean = "string_split(trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    return f"""
WITH templates(license_id, template_no, text) AS (VALUES {quoted}),
t AS (SELECT license_id, template_no, {grams('w')} AS g
      FROM (SELECT *, {clean.format('text')} AS w FROM templates)),
parts AS (
  SELECT doc_id, 'text' AS scope, [text] AS p FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, 'paragraph', regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, 'line', string_split(text, chr(10)) FROM documents WHERE text IS NOT NULL),
cut AS (
  SELECT DISTINCT doc_id, scope, i - 1 AS segment_no, p[i] AS segment
  FROM parts, unnest(range(1, len(p) + 1)) AS r(i)
  WHERE (scope = 'text' OR len(p) > 1) AND (scope <> 'paragraph' OR instr(trim(p[i], ' '), chr(10)) > 0)),
s AS (SELECT doc_id, scope, segment_no, {grams('w')} AS g
      FROM (SELECT *, {clean.format('segment')} AS w FROM cut) WHERE len(w) BETWEEN 2 AND 100000),
pairs AS (
  SELECT s.doc_id, s.scope, s.segment_no, t.license_id, t.template_no, len(s.g) AS n_bigrams,
         len(t.g) AS template_bigrams, len(list_intersect(s.g, t.g)) AS shared
  FROM s JOIN t ON list_has_any(s.g, t.g))
SELECT *, 2 * shared / (n_bigrams + template_bigrams) AS dice FROM pairs
WHERE 2 * shared / (n_bigrams + template_bigrams) >= {threshold}
"""
