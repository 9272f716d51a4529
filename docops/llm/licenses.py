"""License statements found by votes of word k-grams on offset diagonals.

All rolling word k-grams of the documents are joined by hash to the places of the
templates' k-grams. A match votes for the diagonal (place in the document minus place in
the template) on which the template would lie. Votes are gathered by diagonal, diagonals
that neighbour each other (words put in or left out) are merged, and what is merged is a
span only if it covers enough of the template's words and is not stretched. Every vote is
checked word by word, so a hash never decides.

Templates shorter than a k-gram are one gram of their own length. Phrases are templates of
which every word has to be there; they are never merged, so each place counts.

Only DataFrame functions are used. The k-grams are never shuffled, only the votes; the
templates' grams are broadcast, with their number checked.

* A-Z are lower-cased, words are runs of letters, digits and non-ASCII characters. Null and
  empty texts have no word: no place, no label, score 0.
* Rows that repeat id and text get the same result, each its own row; rows with one id and
  different texts are told apart by a hash of the text. A null id is kept.
* A span's score is the share of the template's words that it covers, less what a short
  template could be by chance: share * (1 - 0.5 ** words covered). A document has its best
  span's score. A text that repeats a statement has it once for each place.
* An empty table, or no template at all, gives no span. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docops.llm.common import stored, table
from docops.plans.skew import checked_broadcast, local_frame

K = 3
#: A template of at least this many words may miss some; a shorter one has to be there whole.
LONG = 20
#: Share of a long template's words that a span covers at least.
MIN_SHARE = 0.8
#: Words put in or left out between neighbouring diagonals, as a share of the template.
DRIFT = 0.1
#: A span is at most this many times as long as its template.
STRETCH = 1.5

_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["_doc", "_text"]

# Phrases whose places are counted, and the label of each.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Statements and notices of public licenses, and the label of each.
STATEMENTS = [
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "Licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "Licensed under the GNU General Public License, version 2."),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-4.0", "Creative Commons Attribution 4.0 International"),
    ("cc0", "CC0 1.0 Universal"),
    ("bsd", "Released under the BSD License."),
    ("mpl-2.0", "Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at",
    ),
]


def template_words(text: str) -> list[str]:
    lowered = text.translate(str.maketrans(_UPPER, _LOWER))
    return re.findall(_WORD, lowered)


def template_rows(phrases: Mapping[str, str], statements: Sequence[tuple[str, str]]) -> list[tuple]:
    """(template, label, is_phrase, words, least words covered, drift) for every template with a word."""
    rows = []
    for is_phrase, label, text in [(True, v, k) for k, v in phrases.items()] + [(False, *s) for s in statements]:
        words = template_words(text)
        if words:
            long = not is_phrase and len(words) >= LONG
            least = -(-len(words) * int(MIN_SHARE * 100) // 100) if long else len(words)
            drift = int(len(words) * DRIFT) if long else 0
            rows.append((len(rows), label, is_phrase, words, least, drift))
    return rows


def _lowered(text: str) -> Column:
    """A-Z in lower case; the quick function does the same where every character is ASCII."""
    column = F.coalesce(F.col(text), F.lit(""))
    ascii_only = F.octet_length(column) == F.char_length(column)
    return F.when(ascii_only, F.lower(column)).otherwise(F.translate(column, _UPPER, _LOWER))


def _words(text: str) -> Column:
    return F.regexp_extract_all(_lowered(text), F.lit(_WORD), F.lit(0))


def _n_words(text: str) -> Column:
    # The pattern's letters are all non-ASCII ones and a-z; A-Z need not be lower-cased to be counted.
    column = F.coalesce(F.col(text), F.lit(""))
    return F.regexp_count(column, F.lit("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")).cast("long")


def _keyed(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_doc"), F.xxhash64("text").alias("_text")]


def _gram(words: str, at: Column, size: int) -> Column:
    """Hash of the ``size`` words from ``at``; at the end of a text, of the words that are left."""
    return F.xxhash64(F.lit(size), *[F.get(words, at + i) for i in range(size)])


def diagonals(docs: DataFrame, templates: Sequence[tuple]) -> DataFrame:
    """(_doc, _text, template, diagonal, covered): template words that votes cover, by diagonal."""
    places = [
        (template, at, words[at : at + K], len(words[at : at + K]))
        for template, _, _, words, _, _ in templates
        for at in range(max(1, len(words) - K + 1))
    ]
    sizes = sorted({size for *_, size in places}) or [K]
    grams = local_frame(docs.sparkSession, places, "template int, place int, gram array<string>, size int")
    hashes = F.lit(None).cast("long")
    for size in sizes:
        hashes = F.when(F.col("size") == size, _gram("gram", F.lit(0), size)).otherwise(hashes)
    side = checked_broadcast(grams.withColumn("_h", hashes))
    words = docs.select(*_keyed(docs), _words("text").alias("_w"))
    # Grams are hashed row by row in generated code, not in a lambda over the array.
    rolled = words.select(*_KEY, "_w", F.posexplode("_w").alias("_at", "_word")).select(
        *_KEY, "_w", "_at", F.explode(F.array(*[_gram("_w", F.col("_at"), size) for size in sizes])).alias("_h")
    )
    votes = (
        rolled.join(side, "_h")
        .where(F.slice("_w", F.col("_at") + 1, F.col("size")) == F.col("gram"))
        .select(*_KEY, "template", (F.col("_at") - F.col("place")).alias("diagonal"), "place", "size")
    )
    # A set of places is no larger than the template; rows that repeat a document add nothing to it.
    return (
        votes.groupBy(*_KEY, "template", "diagonal")
        .agg(F.collect_set(F.struct("place", "size")).alias("_votes"))
        .withColumn(
            "covered",
            F.array_sort(
                F.array_distinct(
                    F.flatten(
                        F.transform("_votes", lambda v: F.sequence(v["place"], v["place"] + v["size"] - 1))
                    )
                )
            ),
        )
        .drop("_votes")
    )


def license_spans(
    docs: DataFrame, phrases: Mapping[str, str] = PHRASES, statements: Sequence[tuple[str, str]] = STATEMENTS
) -> DataFrame:
    """Verified spans: _doc, _text, label, is_phrase, start, n_words, n_covered, score."""
    templates = template_rows(phrases, statements)
    known = local_frame(
        docs.sparkSession,
        [(t, label, is_phrase, len(words), least, drift) for t, label, is_phrase, words, least, drift in templates],
        "template int, label string, is_phrase boolean, length int, least int, drift int",
    )
    votes = diagonals(docs, templates).join(checked_broadcast(known), "template")
    # One row for each diagonal; a document's diagonals are no more than its words and templates' places.
    order = Window.partitionBy(*_KEY, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order)
    new = F.when(apart <= F.col("drift"), 0).otherwise(1)
    merged = votes.withColumn("_new", new).withColumn("_span", F.sum("_new").over(order))
    of_span = [*_KEY, "template", "_span"]
    spans = merged.groupBy(*of_span).agg(
        *[F.first(c).alias(c) for c in ("label", "is_phrase", "length", "least")],
        F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("n_covered"),
        F.min(F.col("diagonal") + F.element_at("covered", 1)).alias("start"),
        (F.max(F.col("diagonal") + F.element_at("covered", -1)) + 1).alias("_end"),
    )
    share = F.col("n_covered") / F.col("length")
    return (
        spans.withColumn("n_words", F.col("_end") - F.col("start"))
        .where((F.col("n_covered") >= F.col("least")) & (F.col("n_words") <= F.col("length") * STRETCH))
        .withColumn("score", share * (1 - F.pow(F.lit(0.5), F.col("n_covered"))))
        .select(*_KEY, "label", "is_phrase", "start", "n_words", "n_covered", "score")
    )


def scan_licenses(
    docs: DataFrame, phrases: Mapping[str, str] = PHRASES, statements: Sequence[tuple[str, str]] = STATEMENTS
) -> DataFrame:
    """One row for each row of ``docs``: places of phrases, labels of all spans, and the best score."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = (
        license_spans(docs, phrases, statements)
        .groupBy(*_KEY)
        .agg(
            F.count(F.when(F.col("is_phrase"), 1)).alias("n_base"),
            F.min(F.when(F.col("is_phrase"), F.col("start"))).alias("first_word"),
            F.max(F.when(F.col("is_phrase"), F.col("start"))).alias("last_word"),
            F.collect_set(F.when(F.col("is_phrase"), F.col("label"))).alias("base_labels"),
            F.collect_set("label").alias("labels"),
            F.max("score").alias("score"),
        )
    )
    found = stored(found, "licenses-found")
    rows = docs.select("doc_id", *_keyed(docs), _n_words("text").alias("n_words"))
    joined = rows.join(found.hint("merge"), _KEY, "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        *[F.array_join(F.array_sort(F.coalesce(c, none)), ",").alias(c) for c in ("base_labels", "labels")],
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op11_licenses(spark, directory: str) -> DataFrame:
    return scan_licenses(table(spark, directory, "documents"))


def licenses_sql(phrases: Mapping[str, str] = PHRASES, statements: Sequence[tuple[str, str]] = STATEMENTS) -> str:
    """DuckDB SQL: grams compared as word lists, for tables without repeated ids."""
    templates = template_rows(phrases, statements)
    values = ",\n".join(
        f"({t}, '{label}', {is_phrase}, {words}, {least}, {drift})" for t, label, is_phrase, words, least, drift in templates
    )
    grams = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS size, unnest(range(0, len(w) - {k - 1})) AS pos, "
        f"unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: w[i:i + {k - 1}])) AS gram "
        f"FROM words WHERE len(w) >= {k}"
        for k in sorted({min(K, len(t[3])) for t in templates})
    )
    return f"""
WITH templates(template, label, is_phrase, words, least, drift) AS (VALUES
{values}),
places AS (SELECT template, least({K}, len(words)) AS size,
    unnest(range(0, greatest(1, len(words) - {K - 1}))) AS place, words FROM templates),
tgrams AS (SELECT template, size, place, words[place + 1:place + size] AS gram FROM places),
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '{_WORD}') AS w FROM documents),
grams AS ({grams}),
covered AS (SELECT DISTINCT doc_id, template, pos - place AS diagonal,
    unnest(range(place, place + size)) AS word FROM grams JOIN tgrams USING (size, gram)),
apart AS (SELECT doc_id, template, diagonal,
    diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS d
    FROM (SELECT DISTINCT doc_id, template, diagonal FROM covered)),
numbered AS (SELECT doc_id, template, diagonal, sum(CASE WHEN d <= drift THEN 0 ELSE 1 END)
    OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM apart JOIN templates USING (template)),
spans AS (SELECT doc_id, template, span, count(DISTINCT word) AS n, min(diagonal + word) AS start,
    max(diagonal + word) + 1 AS stop FROM numbered JOIN covered USING (doc_id, template, diagonal) GROUP BY ALL),
good AS (SELECT doc_id, label, is_phrase, start, n / len(words) * (1 - pow(0.5, n)) AS score
    FROM spans JOIN templates USING (template) WHERE n >= least AND stop - start <= len(words) * {STRETCH}),
found AS (SELECT doc_id, count(*) FILTER (is_phrase) AS n_base, min(start) FILTER (is_phrase) AS first_word,
    max(start) FILTER (is_phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_phrase) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM good GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM words LEFT JOIN found USING (doc_id)"""


QUERIES = {"op11_licenses": op11_licenses}
SQL = {"op11_licenses": licenses_sql()}
