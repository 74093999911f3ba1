"""License scan: lines, whole texts and word windows against licence templates, by the Dice coefficient over word bigrams.

Only Spark's own functions run here.  A unit (each line, and the whole text if it has several) is normalised to
lower-case words of ASCII letters and digits; its set of word bigrams has n members, a template's has b, and
Dice = 2 common / (n + b).  Where the whole text is no licence, its words without the lines that are one are looked through
for licences that are wrapped over lines or stand among other words: from each bigram of a template, the window of
at most the greatest near size that ends with one and has the most of them for its length (2 hits / (length + b)) is a unit
too.  A window within a longer one does not count; of others that overlap, the first does.  Two bounds prune without loss at a least value t:

* sizes: Dice can reach t only for t b / (2 - t) <= n <= (2 - t) b / t; other templates are not compared;
* pivots: Dice >= t needs t / (2 - t) of a template's bigrams, so that a unit without any of the words that more than
  the rest of its bigrams hold cannot reach it.  Texts without a pivot word are not cut into units.

Defined results: null and empty texts, and texts of fewer than two words, have no licence; of several templates
the highest Dice wins, then the first name; repeated rows give repeated results; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import put_back, set_aside

THRESHOLD = 0.8

#: Disclaimers that end the complete texts.
_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.")

#: Public licence texts and notices, by SPDX identifier.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
     "specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
     "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
     "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
     "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
     "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights '
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
     "permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
]
#: The complete texts of the licences that consist of a notice above and a disclaimer.
TEMPLATES += [(name, f"{text} {end}") for name, text in TEMPLATES for known, first, end in (
    ("MIT", "Permission is", _MIT), ("BSD-2-Clause", "Redistribution", _BSD), ("BSD-3-Clause", "Redistribution", _BSD),
    ("ISC", "Permission to", _ISC)) if name == known and text.startswith(first)]


def bigrams(text: str) -> list[str]:
    """The set of word bigrams of a template, sorted."""
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text).lower().split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def sizes(b: int, threshold: float) -> tuple[int, int]:
    """Least and greatest number of bigrams with which a unit can reach the threshold against b; also, the least
    number of bigrams it then shares.  Reckoned as Dice is, so that rounding loses no unit at the threshold."""
    low = next(n for n in range(1, b + 1) if 2 * n / (n + b) >= threshold)
    high = b
    while 2 * b / (high + 1 + b) >= threshold:
        high += 1
    return low, high


def pivots(templates: list[list[str]], threshold: float) -> list[str]:
    """Words one of which a unit must have to be near any template: of each template its longest words, until more of
    its bigrams have one of them than a near unit can lack."""
    chosen: set[str] = set()
    for grams in templates:
        lack = len(grams) - sizes(len(grams), threshold)[0]
        for w in sorted({w for g in grams for w in g.split()}, key=lambda w: (-len(w), w)):
            if sum(1 for g in grams if not chosen.isdisjoint(g.split())) > lack:
                break
            chosen.add(w)
    return sorted(chosen)


#: Columns that a scan makes on its way; columns of the caller with these names are set aside.
STEPS = ("units", "unit_words", "names", "best", "rest", "rest_grams", "windows", "kept", "found", "n_found")


def scan(docs: DataFrame, text_col: str = "text", templates: list[tuple[str, str]] | None = None,
         threshold: float = THRESHOLD, windows: bool = True) -> DataFrame:
    """Add ``license`` (name or null), ``dice`` (of the best unit, null if none) and ``n_units`` with a licence.

    Without ``windows``, only lines and whole texts are units.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    named = [(name, grams) for name, text in sorted(templates or TEMPLATES) if (grams := bigrams(text))]
    docs, aside = set_aside(docs, *STEPS)
    text_col = aside.get(text_col, text_col)
    some = "|".join(pivots([g for _, g in named], threshold))
    text = f"cast(`{text_col}` AS string)"
    lines = rf"split({text}, '\n', -1)"
    units = f"CASE WHEN size({lines}) > 1 THEN concat({lines}, array({text})) ELSE {lines} END"
    units = f"CASE WHEN {text} rlike '(?i)(?<![a-z0-9])(?:{some})(?![a-z0-9])' THEN {units} END"
    words = "transform(units, u -> filter(split(lower(regexp_replace(u, '[^A-Za-z0-9]+', ' ')), ' '), w -> w <> ''))"
    pairs = lambda w: f"CASE WHEN size({w}) > 1 THEN transform(sequence(0, size({w}) - 2), i -> concat({w}[i], ' ', {w}[i + 1])) END"
    bigrams_of = lambda w: f"array_distinct({pairs(w)})"
    # a template is compared only with units of a size that can reach the threshold
    nothing = "cast(array() AS array<struct<first: int, last: int, dice: double, license: string>>)"
    compared, near = [], []
    for name, b in named:
        low, high = sizes(len(b), threshold)
        own = "split('" + ",".join(b) + "', ',')"
        compared.append(f"""CASE WHEN size(g) BETWEEN {low} AND {high} THEN struct(
            cast(2 * size(array_intersect(g, {own})) AS double) / (size(g) + {len(b)}) AS dice, '{name}' AS license) END""")
        end = f"""-array_max(transform(filter(sequence(j + {low - 1}, least(j + {high}, size(p)) - 1), l -> p[l] - p[j] < {high}),
            l -> struct(cast(2 * (l - j + 1) AS double) / (p[l] - p[j] + 1 + {len(b)}) AS near, -p[l] AS last))).last"""
        window = "array_distinct(slice(rest_grams, x.first + 1, x.last - x.first + 1))"
        dice = f"transform(array({window}), g -> cast(2 * size(array_intersect(g, {own})) AS double) / (size(g) + {len(b)}))[0]"
        near.append(f"""CASE WHEN size(array_intersect(rest_grams, {own})) >= {low} THEN flatten(transform(
            array(filter(sequence(0, size(rest_grams) - 1), i -> array_contains({own}, rest_grams[i]))),
            p -> filter(transform(transform(filter(sequence(0, size(p) - {low}), j -> p[j + {low - 1}] - p[j] < {high}),
                j -> struct(p[j] AS first, {end} AS last)),
                x -> struct(x.first AS first, -x.last AS last, {dice} AS dice, '{name}' AS license)), x -> x.dice >= {threshold!r}D)))
            ELSE {nothing} END""")
    best = f"""transform(transform(unit_words, w -> {bigrams_of('w')}),
        g -> array_max(transform(filter(array({', '.join(compared)}), m -> m.dice >= {threshold!r}D),
        m -> struct(m.dice AS dice, -array_position(names, m.license) AS first, m.license AS license))))"""
    # the words of lines that are no licence; a word that no template has stands for each of those that are
    rest = f"""CASE WHEN size(best) > 0 AND get(best, size(best) - 1) IS NULL THEN flatten(transform(slice(unit_words, 1, greatest(size(unit_words) - 1, 1)),
        (w, k) -> CASE WHEN best[k] IS NULL THEN w ELSE array('-') END)) END"""
    names = "array(" + ", ".join(f"'{n}'" for n in sorted({n for n, _ in named})) + ")"
    # a notice within a longer one is part of that; of others that overlap, the first counts
    kept = "filter(windows, x -> NOT exists(windows, y -> y.first <= x.first AND y.last <= x.last AND (y.first < x.first OR y.last < x.last)))"
    apart = """aggregate(array_sort(kept), struct(-1 AS last, 0 AS n), (a, x) -> CASE WHEN x.first > a.last
        THEN struct(-x.last AS last, a.n + 1 AS n) ELSE a END, a -> a.n)"""
    found = """concat(filter(best, m -> m IS NOT NULL), transform(kept,
        x -> struct(x.dice AS dice, -array_position(names, x.license) AS first, x.license AS license)))"""
    staged = docs
    for column, expr in (("units", units), ("unit_words", words), ("names", names), ("best", f"coalesce({best}, array())"),
                         ("rest", rest), ("rest_grams", pairs("rest")), ("windows", f"concat({', '.join(near)})" if windows else nothing), ("kept", kept),
                         ("found", found), ("n_found", f"size(filter(best, m -> m IS NOT NULL)) + {apart}")):
        staged = staged.withColumn(column, F.expr(expr))
    top = F.expr("array_max(found)")
    return put_back(staged.withColumns({"license": top["license"], "dice": top["dice"], "n_units": F.col("n_found").cast("bigint")}).drop(*STEPS), aside)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, license, dice and n_units of every document, by lines and whole texts as in its SQL."""
    return scan(docs.select("doc_id", "text"), windows=False).select("doc_id", "license", "dice", "n_units")


def oracle_sql(templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> str:
    """The report in DuckDB SQL, without any pruning."""
    quoted = ", ".join("({}, {}, {})".format(k, "'" + n + "'", "'" + t.replace("'", "''") + "'")
                       for k, (n, t) in enumerate(sorted(templates or TEMPLATES)))
    grams = "list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])"
    words = r"[x FOR x IN string_split(lower(regexp_replace({0}, '[^A-Za-z0-9]+', ' ', 'g')), ' ') IF x <> '']"
    return f"""
WITH template AS (SELECT k, name, unnest(g) AS gram, len(g) AS b FROM (
        SELECT k, name, {grams} AS g FROM (SELECT k, name, {words.format('text')} AS w FROM (VALUES {quoted}) v(k, name, text)))),
lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
unit AS (SELECT doc_id, row_number() OVER () AS u, {words.format('x')} AS w FROM (
        SELECT doc_id, unnest(CASE WHEN len(l) > 1 THEN list_append(l, text) ELSE l END) AS x FROM lines)),
gram AS (SELECT doc_id, u, unnest(g) AS gram, len(g) AS n FROM (SELECT doc_id, u, {grams} AS g FROM unit WHERE len(w) > 1)),
pair AS (SELECT doc_id, u, k, name, CAST(2 * count(*) AS DOUBLE) / (any_value(n) + any_value(b)) AS dice
        FROM gram JOIN template USING (gram) GROUP BY doc_id, u, k, name),
hit AS (SELECT * FROM pair WHERE dice >= {threshold!r}),
best AS (SELECT doc_id, count(DISTINCT u) AS n_units, max(dice) AS dice FROM hit GROUP BY doc_id),
named AS (SELECT h.doc_id, min(h.name) AS license FROM hit h JOIN best b ON h.doc_id = b.doc_id AND h.dice = b.dice GROUP BY h.doc_id)
SELECT d.doc_id, n.license, b.dice, coalesce(b.n_units, 0) AS n_units
FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id"""
