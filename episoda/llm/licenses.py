"""Licence scan: normalised segments of a text against licence templates by the Dice coefficient of their word bigrams.

A segment is a line, a paragraph of several lines, or the whole of a text of several paragraphs. Segments and templates are normalised alike
(lower case, everything but letters and digits to single blanks) and compared as sets of word bigrams. A template of B bigrams can reach the
threshold t only with segments of t/(2-t)*B to (2-t)/t*B bigrams, of which it shares t/(2-t)*B or more; others are never compared. A text as
a whole has all bigrams of its segments, so it is cut into them only if it shares that many with some template; word pairs become strings
only if templates have both words, or to count the bigrams of what is then left. Everything is a DataFrame expression; the templates are
literals of the expression, so there is neither a join nor a shuffle.

Defined results: null and empty texts have no segments; equal segments of a text are reported each; of equally good templates the first by
name is reported; repeated rows are reported each; null ids are kept; a text of any length is scanned whole, with memory in proportion to
it; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Notices and licence texts by name, as commonly written.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("bsd", "Released under the BSD License."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def normalised(text: str) -> str:
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def template_bigrams(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> list[tuple[str, list[str]]]:
    """(name, sorted distinct bigrams), by name; templates of fewer than two words have none and are left out."""
    out = []
    for name, text in templates:
        w = normalised(text).split(" ")
        grams = sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})
        if grams:
            out.append((name, grams))
    return sorted(out)


def _normal(text: Column) -> Column:
    """Lower case, letters and digits, line feeds where they were; everything else is blanks, of which several may follow each other."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z \n\p{L}\p{N}]+", " ")


def segments(text: Column) -> Column:
    """array<struct<kind,place,body>>: lines, paragraphs of several lines, and the whole if it has several paragraphs."""
    numbered = lambda parts, kind: F.transform(parts, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("place"), x.alias("body")))

    def longer(paragraphs: Column) -> Column:
        several = F.filter(numbered(paragraphs, "paragraph"), lambda x: F.contains(x["body"], F.lit("\n")))
        return F.concat(several, F.filter(numbered(F.array(text), "whole"), lambda x: F.size(paragraphs) > 1))

    return F.concat(numbered(F.split(text, "\n"), "line"), F.flatten(F.transform(F.array(F.split(text, "\n\n")), longer)))


def scan(docs: DataFrame, threshold: float = THRESHOLD, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """doc_id, kind, place, license, dice (6 decimals), bigrams for every segment of docs(doc_id, text) with a template at `threshold` or more."""
    known = template_bigrams(templates)
    least = max(threshold - 1e-6, threshold / 2)  # the bounds leave room for the rounding of dice
    low, high = least / (2 - least), (2 - least) / least
    fewest, most = min((low * len(g) for _, g in known), default=1), max((high * len(g) for _, g in known), default=0)
    grams = sorted({x for _, g in known for x in g})
    vocabulary = sorted({w for x in grams for w in x.split(" ")})
    names = sorted({n for n, _ in known}, reverse=True)  # of equal scores the largest place wins
    literal = json.dumps([{"place": names.index(n), "size": len(g), "grams": g} for n, g in known])
    all_templates = F.from_json(F.lit(literal), "array<struct<place:int,size:int,grams:array<string>>>")  # folded to one constant

    def words_of(body: Column) -> Column:
        return F.array_remove(F.split(F.replace(body, F.lit("\n"), F.lit(" ")), " "), "")

    # each step's value is bound to a lambda variable: it is computed once however often the next step uses it
    def shared(words: Column) -> Column:
        """The distinct bigrams that some template has. Only pairs of the templates' words become strings: most segments have none."""
        pairs = F.transform(words, lambda x, i: F.when(x.isin(vocabulary) & F.get(words, i + 1).isin(vocabulary), F.concat(x, F.lit(" "), F.get(words, i + 1))))
        return F.array_distinct(F.filter(pairs, lambda x: x.isin(grams)))

    def reachable(hits: Column) -> Column:
        """Whether a template shares enough bigrams for the threshold, had the segment no others."""
        return (F.size(hits) >= fewest) & F.exists(all_templates, lambda t: F.size(F.array_intersect(t["grams"], hits)) >= low * t["size"])

    def n_bigrams(words: Column) -> Column:
        return F.size(F.array_distinct(F.transform(F.slice(words, 2, F.size(words)), lambda x, i: F.concat(F.get(words, i), F.lit(" "), x))))

    def scored(hits: Column, n: Column) -> Column:
        near = F.filter(all_templates, lambda t: (n >= low * t["size"]) & (n <= high * t["size"]))
        dice = F.transform(near, lambda t: F.struct(F.round(2.0 * F.size(F.array_intersect(t["grams"], hits)) / (n + t["size"]), 6).alias("dice"), t["place"].alias("at"), n.alias("bigrams")))
        return F.filter(dice, lambda x: x["dice"] >= threshold)

    def best(words: Column) -> Column:
        # a text of more bigrams than any template allows shows it in its beginning, mostly; if not, all are counted
        beginning = F.array(F.slice(words, 1, 4 * math.ceil(most) + 1))
        likely = F.filter(F.array(shared(words)), lambda hits: reachable(hits) & F.exists(F.transform(beginning, n_bigrams), lambda n: n <= most))
        return F.array_max(F.flatten(F.flatten(F.transform(likely, lambda hits: F.transform(F.array(n_bigrams(words)), lambda n: scored(hits, n))))))

    def judged(segment: Column) -> Column:
        return F.struct(segment["kind"].alias("kind"), segment["place"].alias("place"), F.array_max(F.transform(F.array(words_of(segment["body"])), best)).alias("best"))

    def possible(text: Column) -> Column:
        """A text has all bigrams of its segments: where no template is in reach of it, none is in reach of a segment."""
        return F.exists(F.transform(F.array(words_of(text)), shared), reachable)

    parts = F.flatten(F.transform(F.filter(F.array(_normal(F.col("text"))), possible), segments))
    found = F.filter(F.transform(parts, judged), lambda x: x["best"].isNotNull())
    rows = docs.select("doc_id", F.explode(found).alias("s")).select("doc_id", "s.kind", "s.place", "s.best")
    return rows.select("doc_id", "kind", "place", F.get(F.array(*[F.lit(n) for n in names]), F.col("best.at")).alias("license"), F.col("best.dice").alias("dice"), F.col("best.bigrams").alias("bigrams"))


def oracle_sql(threshold: float = THRESHOLD, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> str:
    """The same scan in DuckDB, templates compared with every segment and no pruning."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(n)}, [{', '.join(map(quote, g))}])" for n, g in template_bigrams(templates))
    return f"""
WITH t(license, known) AS (VALUES {rows}),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (
  SELECT doc_id, 'line' AS kind, unnest(range(len(string_split(text, chr(10))))) AS place, unnest(string_split(text, chr(10))) AS body FROM d
  UNION ALL
  SELECT * FROM (SELECT doc_id, 'paragraph', unnest(range(len(string_split(text, chr(10) || chr(10))))), unnest(string_split(text, chr(10) || chr(10))) AS body FROM d) WHERE contains(body, chr(10))
  UNION ALL
  SELECT doc_id, 'whole', 0, text FROM d WHERE contains(text, chr(10) || chr(10))
),
w AS (SELECT doc_id, kind, place, string_split(trim(regexp_replace(lower(body), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM s),
g AS (SELECT doc_id, kind, place, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM w WHERE len(w) > 1),
c AS (SELECT doc_id, kind, place, license, len(grams) AS bigrams, round(2.0 * len(list_intersect(grams, known)) / (len(grams) + len(known)), 6) AS dice FROM g, t),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind, place ORDER BY dice DESC, license) AS k FROM c WHERE dice >= {threshold})
SELECT doc_id, kind, CAST(place AS INTEGER) AS place, license, dice, CAST(bigrams AS INTEGER) AS bigrams FROM r WHERE k = 1
"""
