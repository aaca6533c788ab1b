"""Licence scans: lines, paragraphs and word windows against licence templates by Dice over word bigrams.

Both sides are lower-cased and reduced to words of letters, digits and inner points. With m
and n distinct bigrams, Dice is 2 * common / (m + n), at most 2 * min(m, n) / (m + n); a
template whose size cannot reach the threshold is never compared.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

THRESHOLD = 0.8

# Licence identifiers and the wording of their notices.
TEMPLATES: dict[str, str] = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0-text": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
    "proprietary": "All rights reserved.",
}

# Further wordings, which the tables do not hold.
MORE_TEMPLATES: dict[str, str] = {
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-text": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "EPL-2.0-text": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
}

_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_CLAUSES = (
    TEMPLATES["BSD-text"]
    + "\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    + "\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)

# Whole licences, of several paragraphs; a text that holds little else is compared with them as it stands.
WHOLE_TEMPLATES: dict[str, str] = {
    "MIT-whole": TEMPLATES["MIT-text"]
    + "\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    + "\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-whole": TEMPLATES["ISC-text"]
    + "\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-whole": _CLAUSES + "\n\n" + _AS_IS,
    "BSD-3-Clause-whole": _CLAUSES + "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n" + _AS_IS,
    "Unlicense-whole": MORE_TEMPLATES["Unlicense-text"]
    + "\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."
    + "\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Zlib-whole": MORE_TEMPLATES["Zlib-text"]
    + "\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required."
    + "\n\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software."
    + "\n\n3. This notice may not be removed or altered from any source distribution.",
}

WORD = r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*"
#: The same words for Python's re.
_TOKEN = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def bigrams(tokens: Column) -> Column:
    """Distinct neighbouring word pairs; of a single word, the word itself."""

    def of(w: Column) -> Column:
        n = F.size(w) - 1
        pairs = F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.concat_ws(" ", a, b))
        return F.when(n > 0, F.array_distinct(pairs)).otherwise(w)

    return F.element_at(F.transform(F.array(tokens), of), 1)  # the lambda has the words cut once


def _templates(spark, templates: dict[str, str]) -> list[tuple[str, list[str]]]:
    rows = spark.createDataFrame(list(templates.items()), "license string, text string")
    return [(r["license"], r["b"]) for r in rows.select("license", bigrams(words(F.col("text"))).alias("b")).collect() if r["b"]]


def _pairs_of(tokens: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


class _Windows:
    """Licences inside lines and blocks: windows of words that reach the threshold.

    A window grows by a template's own bigrams only, since a foreign one at its edge lowers Dice.
    """

    def __init__(self, templates: list[tuple[str, list[str]]], threshold: float) -> None:
        self.known, self.threshold = {name: frozenset(pairs) for name, pairs in templates}, threshold
        # A match has at least the share threshold / (2 - threshold) of a template's bigrams, so one of these.
        self.anchors = frozenset(p for _, pairs in templates for p in sorted(pairs, key=lambda p: (-len(p), p))[: len(pairs) - self._need(len(pairs)) + 1])
        self.first = frozenset(p.split(" ")[0] for p in self.anchors)

    def _need(self, n: int) -> int:
        return math.ceil(self.threshold / (2 - self.threshold) * n - 1e-9)

    def _dice(self, pairs: set[str], known: frozenset[str]) -> float:
        return 2 * len(pairs & known) / (len(pairs) + len(known))

    def _unit(self, tokens: list[str]) -> tuple[str, float] | None:
        """The licence of a whole line or block and its negated dice."""
        pairs = set(_pairs_of(tokens) or tokens)
        less, name = min(((-self._dice(pairs, known), name) for name, known in self.known.items()), default=(0, "")) if pairs else (0, "")
        return (name, less) if -less >= self.threshold else None

    def find(self, text: str) -> list[tuple[int, str, float]]:
        """First character, licence and dice of each window outside the lines and blocks that match whole."""
        lowered = text.lower()
        if self.first.isdisjoint(_TOKEN.findall(lowered)) or self.anchors.isdisjoint(_pairs_of(_TOKEN.findall(lowered))):
            return []
        text = re.sub("\r\n?", "\n", lowered)
        taken, at = [], 0
        for kind in (r"\n", r"\n[ \t]*\n"):
            cuts = [(m.start(), m.end()) for m in re.finditer(kind, text)]
            for a, b in zip([0, *(c[1] for c in cuts)], [*(c[0] for c in cuts), len(text)]):
                unit = text[a:b]
                if (kind == r"\n" or "\n" in unit) and (found := self._unit(_TOKEN.findall(unit))):
                    words = [(m.group(), m.start() + a, m.end() + a) for m in _TOKEN.finditer(unit)]
                    inner = min(self._hits(words, self.known[found[0]]), default=(0, 0, a, b))
                    taken.append((a, b, *found, *inner[2:]))
        found, block = [], []
        for line in [*text.split("\n"), ""]:
            tokens = [(m.group(), m.start() + at, m.end() + at) for m in _TOKEN.finditer(line)]
            at += len(line) + 1
            if tokens:
                block += tokens
            elif block:  # a line without words, such as a bare comment mark, ends a block
                found += self._in_block(block, taken)
                block = []
        out, used = [], []
        for less, short, name, a, b in sorted(found):
            if all(b <= x or a >= y for x, y in used):
                used.append((a, b))
                out.append((a, name, -less))
        return out

    def _in_block(self, block: list[tuple[str, int, int]], taken: list[tuple]) -> list[tuple[float, int, str, int, int]]:
        """Windows of a block; a whole unit keeps its own licence to itself, and the place of its notice unless a window around it fits better."""
        found = []
        for name, known in self.known.items():
            for less, short, a, b in self._hits(block, known):
                if all((b <= x or a >= y) if other == name else (b <= c or a >= d or (a <= c and d <= b and less < own)) for x, y, other, own, c, d in taken):
                    found.append((less, short, name, a, b))
        return found

    def _hits(self, block: list[tuple[str, int, int]], known: frozenset[str]) -> Iterator[tuple[float, int, int, int]]:
        """Negated dice and size, first and last character of the windows that reach the threshold."""
        pairs = _pairs_of([w for w, _, _ in block])
        at = [i for i, p in enumerate(pairs) if p in known]
        need, most = self._need(len(known)), math.floor((2 - self.threshold) / self.threshold * len(known) + 1e-9)
        for s in range(len(at) - need + 1):
            if at[s + need - 1] - at[s] >= most:
                continue
            seen, last = set(), at[s]
            for k in range(s, len(at)):
                if at[k] - at[s] >= most:
                    break
                seen.update(pairs[last : at[k] + 1])
                last = at[k] + 1
                if (dice := self._dice(seen, known)) >= self.threshold:
                    yield -dice, -len(seen), block[at[s]][1], block[at[k] + 1][2]


def needed_words(templates: list[tuple[str, list[str]]], threshold: float) -> list[str]:
    """Words of which every match of any template holds one: too few bigrams are left without them.

    A match has at least the share threshold / (2 - threshold) of a template's bigrams. Words are
    taken where they touch most bigrams, longer ones first, those of other templates before new ones.
    """
    chosen: list[str] = []
    for _, pairs in sorted(templates, key=lambda t: (len(t[1]), t[0])):
        need = math.ceil(threshold / (2 - threshold) * len(pairs) - 1e-9)
        left = [p.split(" ") for p in pairs if not set(p.split(" ")) & set(chosen)]
        while len(left) >= need:
            words = sorted({w for p in left for w in p}, key=lambda w: (-min(len(w), 7), -sum(w in p for p in left), w))
            chosen.append(words[0])
            left = [p for p in left if words[0] not in p]
    return chosen


def _windows(docs: DataFrame, templates: list[tuple[str, list[str]]], threshold: float) -> DataFrame:
    """row, doc_id, place (negative, apart from lines and blocks), license and dice of windows inside lines and blocks."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(templates, threshold)
        for batch in batches:
            rows = [(i, *w) for i, text in enumerate(common.texts_of(batch)) for w in windows.find(text)]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([-1 - r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.float64())],
                names=["row", "doc_id", "place", "license", "dice"],
            )

    return common.map_arrow(docs.select("row", "doc_id", "text"), common.schema_of(docs, ["row", "doc_id"], "place int, license string, dice double"), found)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice (best match, 6 digits) and n_units, for each licence a document shows.

    Units are lines, paragraphs (runs of lines between empty ones), whole texts of several
    paragraphs, and windows of words inside lines and paragraphs: of another licence than a
    matching unit only where they lie apart from its notice or fit better around it. A unit's licence is its best template at or above
    ``threshold``, ties to the first by name. Null and empty texts,
    and documents without a licence, give no row. Every row's units count, those of rows that share
    a doc_id, or have none, together. Texts without a word that every match needs are left out first.
    """
    spark = docs.sparkSession
    known = _templates(spark, templates or TEMPLATES | MORE_TEMPLATES | WHOLE_TEMPLATES)
    least, most = threshold / (2 - threshold), (2 - threshold) / threshold
    sized = [(n, name, pairs) for name, pairs in known for n in range(math.ceil(least * len(pairs) - 1e-9), math.floor(most * len(pairs) + 1e-9) + 1)]
    by_size = spark.createDataFrame(sized, "n int, license string, known array<string>")  # as many rows as the templates' sizes allow
    held = needed_words(known, threshold)
    needed = F.exists(F.array(F.lower("text")), lambda t: reduce(or_, (t.contains(w) for w in held), F.lit(False)))  # the lambda has the text lowered once
    docs = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))  # tells apart the units of rows with one id
    docs = docs.where(needed)
    text = F.regexp_replace("text", "\r\n?", "\n")
    blocks = F.filter(F.split(text, r"\n[ \t]*\n"), lambda b: F.contains(b, F.lit("\n")))
    parted = docs.withColumn("whole", text.rlike(r"\n[ \t]*\n"))
    whole = F.when(F.col("whole"), F.array(text)).otherwise(F.array().cast("array<string>"))
    units = parted.select("row", "doc_id", "whole", F.posexplode(F.reverse(F.concat(F.split(text, "\n"), blocks, whole))).alias("place", "unit"))
    units = units.withColumn("whole", F.col("whole") & (F.col("place") == 0))  # the whole text stands first; it is compared with whole licences only
    pairs = units.select("row", "doc_id", "place", "whole", bigrams(words(F.col("unit"))).alias("pairs")).select("row", "doc_id", "place", "whole", "pairs", F.coalesce(F.size("pairs"), F.lit(0)).alias("n"))
    dice = 2.0 * F.size(F.array_intersect("pairs", "known")) / (F.col("n") + F.size("known"))
    scored = pairs.join(F.broadcast(by_size), "n").where(~F.col("whole") | F.col("license").isin(*WHOLE_TEMPLATES)).select("row", "doc_id", "place", "license", dice.alias("dice")).where(F.col("dice") >= threshold)
    inner = [t for t in known if t[0] not in WHOLE_TEMPLATES]  # several paragraphs are no window of one
    scored = scored.unionByName(_windows(docs, inner, threshold))
    best = scored.groupBy("row", "doc_id", "place").agg(F.min(F.struct((-F.col("dice")).alias("less"), "license")).alias("b"))
    return best.groupBy("doc_id", F.col("b.license").alias("license")).agg(F.round(F.max(-F.col("b.less")), 6).alias("dice"), F.count("*").alias("n_units"))


def oracle() -> str:
    """The same scan over table ``documents`` as DuckDB SQL."""
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted((TEMPLATES | MORE_TEMPLATES | WHOLE_TEMPLATES).items()))
    pairs = "CASE WHEN len(w) > 1 THEN list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) ELSE w END"
    return rf"""
    WITH t AS (
      SELECT license, {pairs} AS b FROM (
        SELECT license, regexp_extract_all(lower(txt), '{WORD}') AS w FROM (VALUES {values}) v(license, txt))
    ), d AS (
      SELECT doc_id, regexp_replace(text, '\r\n?', chr(10), 'g') AS text FROM documents WHERE text IS NOT NULL
    ), units AS (
      SELECT doc_id, false AS whole, unnest(list_concat(string_split(text, chr(10)),
        list_filter(regexp_split_to_array(text, '\n[ \t]*\n'), lambda b: contains(b, chr(10))))) AS unit FROM d
      UNION ALL SELECT doc_id, true, text FROM d WHERE regexp_matches(text, '\n[ \t]*\n')
    ), u AS (
      SELECT doc_id, whole, row_number() OVER () AS id, {pairs} AS b FROM (
        SELECT doc_id, whole, regexp_extract_all(lower(unit), '{WORD}') AS w FROM units WHERE length(unit) >= 2) WHERE len(w) >= 1
    ), s AS (
      SELECT doc_id, id, license, 2.0 * len(list_intersect(u.b, t.b))::DOUBLE / (len(u.b) + len(t.b)) AS dice
      FROM u JOIN t ON len(u.b) BETWEEN {THRESHOLD / (2 - THRESHOLD)} * len(t.b) - 1e-9 AND {(2 - THRESHOLD) / THRESHOLD} * len(t.b) + 1e-9 AND (NOT u.whole OR license LIKE '%-whole')
    ), best AS (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY dice DESC, license) AS r FROM s WHERE dice >= {THRESHOLD}
    )
    SELECT doc_id, license, round(max(dice), 6) AS dice, count(*) AS n_units FROM best WHERE r = 1 GROUP BY doc_id, license
    """
