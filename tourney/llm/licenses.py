"""Finds licence notices and texts by the Dice coefficient over word bigrams.

A document is compared as a whole, by paragraph, by line and by sentence, and by every run of words
wherever it starts and ends, so that a notice is found in any layout. A part and a template of very
different size cannot reach the threshold, and neither can one that lacks too many bigrams of the
template: a text whose bigrams as a whole do not suffice for a template is not searched for it.
"""

from __future__ import annotations

import re
from collections import Counter, OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
ROUNDING = 1e-6

# The wording of notices and of short licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
        FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
        USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0""",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms
        of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version.""",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    ("proprietary", "All rights reserved."),
)

_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
    EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
    MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
    COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
    EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
    GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
    ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
    OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
    POSSIBILITY OF SUCH DAMAGE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are
    permitted provided that the following conditions are met: 1. Redistributions of source code must
    retain the above copyright notice, this list of conditions and the following disclaimer.
    2. Redistributions in binary form must reproduce the above copyright notice, this list of
    conditions and the following disclaimer in the documentation and/or other materials provided
    with the distribution."""

# Further licences; the SQL states the result for the templates above.
MORE_TEMPLATES = (
    ("BSD-2-Clause", f"{_BSD} {_WARRANTY}"),
    (
        "BSD-3-Clause",
        f"""{_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may
        be used to endorse or promote products derived from this software without specific prior
        written permission. {_WARRANTY}""",
    ),
    ("BSD-2-Clause", "This software is released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "This software is released under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        """Use of this source code is governed by a BSD-style license that can be found in the
        LICENSE file.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    ),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    (
        "GPL-2.0",
        """This program is free software; you can redistribute it and/or modify it under the terms
        of the GNU General Public License as published by the Free Software Foundation; either
        version 2 of the License, or (at your option) any later version.""",
    ),
    (
        "LGPL-2.1",
        """This library is free software; you can redistribute it and/or modify it under the terms
        of the GNU Lesser General Public License as published by the Free Software Foundation;
        either version 2.1 of the License, or (at your option) any later version.""",
    ),
    (
        "LGPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms
        of the GNU Lesser General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version.""",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    (
        "AGPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms
        of the GNU Affero General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version.""",
    ),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to
        copy, modify, publish, use, compile, sell, or distribute this software, either in source
        code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
        means. In jurisdictions that recognize copyright laws, the author or authors of this
        software dedicate any and all copyright interest in the software to the public domain. We
        make this dedication for the benefit of the public at large and to the detriment of our
        heirs and successors. We intend this dedication to be an overt act of relinquishment in
        perpetuity of all present and future rights to this software under copyright law. THE
        SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
        LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
)

_OTHER = r"[^a-z0-9]+"
# Parts end at blank lines, line ends, and white space after the end of a sentence.
_PARAGRAPH = r"\n[ \t]*\n"
_SENTENCE = r"[.!?][ \t]+"


def normalised(text: str) -> list[str]:
    """Words of a text: runs of letters a-z and digits, A-Z in lower case."""
    lower = text.translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})
    return [w for w in re.split(_OTHER, lower) if w]


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


def size_bounds(size: int, threshold: float) -> tuple[float, float]:
    """Sizes that a set may have to reach ``threshold`` with one of ``size``, rounded outwards."""
    factor = threshold / (2 - threshold)
    return size * factor - ROUNDING, size / factor + ROUNDING


def parts(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the whole text and of its paragraphs, lines and sentences, each once."""
    seen = set()

    def cut(start: int, end: int, pattern: str, keep: int) -> Iterator[tuple[int, int]]:
        at = start
        for found in re.compile(pattern).finditer(text, start, end):
            yield at, found.start() + keep
            at = found.end()
        yield at, end

    whole = (0, len(text))
    for paragraph in cut(*whole, _PARAGRAPH, 0):
        for line in cut(*paragraph, r"\n", 0):
            for sentence in cut(*line, _SENTENCE, 1):
                if sentence not in seen:
                    seen.add(sentence)
                    yield sentence
            if line not in seen:
                seen.add(line)
                yield line
        if paragraph not in seen:
            seen.add(paragraph)
            yield paragraph
    if whole not in seen:
        yield whole


class Scanner:
    def __init__(self, templates, threshold: float) -> None:
        self.threshold = threshold
        self.names = [name for name, _ in templates]
        self.sets = sets = [bigrams(normalised(text)) for _, text in templates]
        self.sizes = [len(s) for s in sets]
        self.bounds = [size_bounds(n, threshold) for n in self.sizes]
        self.least = min(low for low, _ in self.bounds)
        self.most = max(high for _, high in self.bounds)
        self.holders: dict[tuple[str, str], list[int]] = {}
        for i, found in enumerate(sets):
            for pair in found:
                self.holders.setdefault(pair, []).append(i)

    def scan(self, text: str | None) -> list[dict]:
        """Parts that reach the threshold, with the best template of each; ties by name.

        After them, the runs of words that no part accounts for: see ``_runs``.
        """
        out = []
        words_of, holders = re.compile(r"[a-z0-9]+").findall, self.holders
        text = text or ""
        lower = text.translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})
        every = words_of(lower)
        held = Counter(
            i for pair in holders.keys() & set(zip(every, every[1:], strict=False))
            for i in holders[pair]
        )
        likely = [i for i, common in held.items() if common >= self.bounds[i][0]]
        if not likely:
            return out
        matched = []
        for start, end in parts(text):
            words = words_of(lower, start, end)
            if len(words) <= self.least:
                continue
            shared: Counter[int] = Counter()
            known = set()
            for pair in zip(words, words[1:], strict=False):
                if pair in holders and pair not in known:
                    known.add(pair)
                    shared.update(holders[pair])
            if not shared:
                continue
            size = len(bigrams(words))
            best = None
            for i, common in shared.items():
                low, high = self.bounds[i]
                if low <= size <= high:
                    score = 2 * common / (size + self.sizes[i])
                    if score >= self.threshold and (
                        best is None or (-score, self.names[i]) < best
                    ):
                        best = (-score, self.names[i])
            if best:
                out.append({"license": best[1], "score": -best[0], "start": start, "end": end})
                matched.append((start, end, -best[0]))
        return out + self._runs(lower, sorted(likely), matched)

    def _runs(self, lower: str, likely: list[int], matched: list[tuple]) -> list[dict]:
        """The best runs of words that reach the threshold and do not overlap each other.

        Left out are runs that a matching part accounts for: they lie within it, or overlap it and
        score no better.
        """
        places = [m.span() for m in re.compile(r"[a-z0-9]+").finditer(lower)]
        words = [lower[start:end] for start, end in places]
        held: dict[tuple[str, str], list[int]] = {}
        for i in likely:
            for pair in self.sets[i]:
                held.setdefault(pair, []).append(i)
        # Distinct bigrams by their last occurrence: the runs that end here differ at these only.
        recent: OrderedDict[tuple[str, str], int] = OrderedDict()
        found = []
        for at, pair in enumerate(zip(words, words[1:], strict=False)):
            recent[pair] = at
            recent.move_to_end(pair)
            for i in held.get(pair, ()):
                best = self._run_to_here(recent, i)
                if best:
                    span = places[best[1]][0], places[at + 1][1]
                    found.append((-best[0], self.names[i], span[1] - span[0], *span))
        out, taken = [], []
        for less, name, _, start, end in sorted(found):
            accounted = any(
                (a <= start and end <= b) or (a < end and start < b and score >= -less)
                for a, b, score in matched
            )
            if not accounted and all(end <= a or b <= start for a, b in taken):
                taken.append((start, end))
                out.append({"license": name, "score": -less, "start": start, "end": end})
        return sorted(out, key=lambda x: x["start"])

    def _run_to_here(self, recent: OrderedDict, i: int) -> tuple[float, int] | None:
        """Score and first word of the best run for a template that ends with the latest bigram."""
        grams, full = self.sets[i], self.sizes[i]
        best, least, common = None, self.threshold, 0
        for size, pair in enumerate(reversed(recent), 1):
            if pair in grams:
                common += 1
                score = 2 * common / (size + full)
                if score >= self.threshold and (best is None or score > best[0]):
                    best, least = (score, recent[pair]), score
            # All that is missing, without a bigram of another kind, would not do better.
            if common == full or 2 * full / (size - common + 2 * full) < least:
                break
        return best


def scan_licenses(
    docs: DataFrame, templates=TEMPLATES + MORE_TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``license``, ``score`` and ``found``.

    ``found`` lists the parts that match (licence, score, start, end in characters), then the runs
    of words that match, lie in no such part and score better than any they overlap; ``license`` is
    the one of the highest score, by name among equals, null where nothing matches (score 0). Whole
    texts are read; null and empty texts match nothing. Rows that share an id stay separate.
    """
    scanner = Scanner(templates, threshold)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct(
                [
                    ("license", pa.string()),
                    ("score", pa.float64()),
                    ("start", pa.int32()),
                    ("end", pa.int32()),
                ]
            )
        )
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                found = [scanner.scan(t) for t in part.column("text").to_pylist()]
                best = [min(((-f["score"], f["license"]) for f in x), default=None) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([b and b[1] for b in best], pa.string()),
                        pa.array([-b[0] if b else 0.0 for b in best], pa.float64()),
                        pa.array(found, kind),
                    ],
                    ["doc_id", "license", "score", "found"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(
        scan,
        "doc_id bigint, license string, score double, "
        "found array<struct<license:string,score:double,start:int,end:int>>",
    )


def license_summary(docs: DataFrame) -> DataFrame:
    """``doc_id``, best ``license``, its ``score`` to six digits, and ``n_found`` matching parts."""
    return scan_licenses(docs).select(
        "doc_id",
        "license",
        F.round("score", 6).alias("score"),
        F.size("found").cast("bigint").alias("n_found"),
    )


def _oracle() -> str:
    def words(text: str) -> str:
        return f"regexp_extract_all(translate({text}, {upper}, {lower}), '[a-z0-9]+')"

    upper, lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
    quoted = ", ".join(
        "({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES)
    )

    def pairs(table: str) -> str:
        return f"list_distinct([{table}.w[i] || ' ' || {table}.w[i + 1] for i in range(1, len({table}.w))])"

    factor = THRESHOLD / (2 - THRESHOLD)
    return f"""
WITH templates AS (
  SELECT id, name, {pairs("t")} AS grams
  FROM (SELECT id, name, {words("body")} AS w FROM (VALUES {quoted}) AS v(id, name, body)) t
),
rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
paragraphs AS (
  SELECT r, unnest(string_split_regex(text, '{_PARAGRAPH}')) AS part FROM rows
),
paragraph_places AS (
  SELECT r, part, row_number() OVER () AS p FROM paragraphs
),
line_places AS (
  SELECT r, p, part, row_number() OVER () AS l
  FROM (SELECT r, p, unnest(string_split(part, chr(10))) AS part FROM paragraph_places)
),
sentences AS (
  SELECT r, p, l, unnest(string_split_regex(part, '{_SENTENCE}')) AS part,
         len(string_split_regex(part, '{_SENTENCE}')) AS siblings
  FROM line_places
),
parts AS (
  SELECT r, part FROM sentences
  UNION ALL
  SELECT r, part FROM line_places
  WHERE l NOT IN (SELECT l FROM sentences WHERE siblings = 1)
  UNION ALL
  SELECT r, part FROM paragraph_places
  WHERE p NOT IN (SELECT p FROM line_places GROUP BY p HAVING count(*) = 1)
  UNION ALL
  SELECT r, text FROM rows
  WHERE r NOT IN (SELECT r FROM paragraph_places GROUP BY r HAVING count(*) = 1)
),
sized AS (
  SELECT r, grams, n FROM (
    SELECT r, grams, row_number() OVER () AS n
    FROM (SELECT r, {pairs("s")} AS grams FROM (SELECT r, {words("part")} AS w FROM parts) s)
  ) WHERE len(grams) > 0
),
scored AS (
  SELECT r, n, name, 2 * len(list_intersect(s.grams, t.grams))
         / CAST(len(s.grams) + len(t.grams) AS DOUBLE) AS score
  FROM sized s JOIN templates t
    ON len(s.grams) BETWEEN len(t.grams) * {factor!r} - {ROUNDING}
       AND len(t.grams) / {factor!r} + {ROUNDING}
),
best AS (
  SELECT r, count(DISTINCT n) AS n_found, max(score) AS score,
         arg_min(name, (-score, name)) AS license
  FROM scored WHERE score >= {THRESHOLD} GROUP BY r
)
SELECT doc_id, license, round(coalesce(score, 0.0), 6) AS score,
       CAST(coalesce(n_found, 0) AS BIGINT) AS n_found
FROM rows LEFT JOIN best USING (r)""".strip()


ORACLE_SQL = _oracle()
