"""Licence scan: Dice coefficient of word bigrams against licence templates.

Words are runs of a-z and 0-9 of the lower-cased text.  Units are a whole text, each of its lines, and, for templates of at least
``LONG`` words, windows of as many words as the template has, one at every ``STEPS``-th part of it, so that a notice wrapped over several lines of a longer
text is met.  A unit's set of distinct word bigrams B meets a template's set T with Dice 2 |B and T| / (|B| + |T|); windows are compared with
their own template.  Dice of at least ``least`` needs
|B| / |T| between least / (2 - least) and (2 - least) / least, so templates beyond these bounds
are pruned by size alone, which loses no match.  It also needs least / (2 - least) of T's bigrams in the unit, and so in the text.  Therefore a text
is looked into only if it has one of a few words that no such share can do without, and then as many of some template's bigrams.

All of it is one projection of built-in expressions: no shuffle, no Python.  Null and empty
texts and units of one word have no bigram and so no licence.  Of equal coefficients the
template that stands first wins.  Repeated rows give equal rows, an empty table none; columns of the results' names are replaced.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.8
LONG, STEPS = 20, 16

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN
NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""

# Public licence texts and the usual one-line notices, as (licence, text).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License, see the LICENSE file for details."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall
be included in all copies or substantial portions of the Software. """
        + _WARRANTY,
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License.""",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-2-Clause", f"{_BSD} {_BSD_END}"),
    (
        "BSD-3-Clause",
        f"""{_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission. {_BSD_END}""",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
)

# The parts of the Creative Commons licences' names, and the licences.
_CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
_CC = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
TEMPLATES += tuple((f"CC-{kind}-4.0", f"Licensed under CC {kind} 4.0.") for kind in _CC)
TEMPLATES += tuple(
    (f"CC-{kind}-4.0", f"This work is licensed under a Creative Commons {'-'.join(_CC_PARTS[k] for k in kind.split('-'))} 4.0 International License.")
    for kind in _CC
)


def template_words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    """The distinct bigrams of a template, in order."""
    words = template_words(text)
    return list(dict.fromkeys(map(" ".join, zip(words, words[1:]))))


def fewest_common(size: int, least: float) -> int:
    """How many of a template's ``size`` bigrams a unit of Dice ``least`` has at least."""
    return math.ceil(size * least / (2 - least) - 1e-9)


def key_words(templates: tuple[tuple[str, str], ...], least: float) -> list[str]:
    """Words without which no unit reaches ``least``: the longest of each template, until those bigrams that have one are too many to miss."""
    out: set[str] = set()
    for _, text in templates:
        own = [b.split() for b in template_bigrams(text)]
        spare = len(own) - fewest_common(len(own), least)
        for word in sorted({w for b in own for w in b}, key=lambda w: (w not in out, -len(w), w)):
            if sum(bool(out & set(b)) for b in own) > spare:
                break
            out.add(word)
    return sorted(out)


def size_bounds(size: int, least: float) -> tuple[int, int]:
    """The fewest and the most bigrams of a unit that can reach ``least`` against ``size`` of them."""
    fits = [n for n in range(1, int(size * (2 - least) / least) + 2) if 2 * min(n, size) >= least * (n + size)]
    return fits[0], fits[-1]


def words_of(unit: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(unit), "[^a-z0-9]+", " ")), " ")


def bigrams_of(words: Column) -> Column:
    """The distinct bigrams of an array of words."""
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def literal(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def dice_hit(bigrams: Column, rank: int, name: str, own: list[str], least: float) -> Column:
    """struct(dice, -template, licence), null where sizes forbid ``least``."""
    lo, hi = size_bounds(len(own), least)
    dice = F.size(F.array_intersect(bigrams, literal(own))) * F.lit(2.0) / (F.size(bigrams) + F.lit(len(own)))
    return F.when(F.size(bigrams).between(lo, hi), F.struct(dice.alias("dice"), F.lit(-rank).alias("rank"), F.lit(name).alias("license")))


def best_template(bigrams: Column, templates: tuple[tuple[str, str], ...], least: float) -> Column:
    """struct(dice, -template, licence) of the best template, null where none reaches ``least``."""
    best = F.array_max(F.array(*(dice_hit(bigrams, i, name, template_bigrams(text), least) for i, (name, text) in enumerate(templates))))
    return F.when(best.dice >= least, best)


def window_hits(words: Column, bigrams: Column, templates: tuple[tuple[str, str], ...], least: float) -> Column:
    """The hits of all windows, template by template; a template is tried where the text has enough of its bigrams."""
    none, found = F.array().cast(HITS), []
    for i, (name, text) in enumerate(templates):
        own, size = template_bigrams(text), len(template_words(text))
        if size < LONG:
            continue
        starts = F.sequence(F.lit(1), F.size(words), F.lit(max(1, size // STEPS)))
        tried = F.transform(F.transform(starts, lambda at: bigrams_of(F.slice(words, at, size))), lambda b: dice_hit(b, i, name, own, least))  # noqa: B023
        hits = F.filter(tried, lambda hit: hit.dice >= least)
        found.append(F.when(F.size(F.array_intersect(bigrams, literal(own))) >= fewest_common(len(own), least), hits).otherwise(none))
    return F.concat(*found) if found else none


HITS = "array<struct<dice:double,rank:int,license:string>>"


def scan_licenses(df: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``df`` with license (the best unit's, else null), license_dice and license_units, the number of units that match (windows overlap)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    worded = df.withColumn("__words", words_of(whole))
    possible = F.arrays_overlap("__words", literal(key_words(templates, least)))
    paired = worded.withColumn("__bigrams", F.when(possible, bigrams_of(F.col("__words"))))
    each = [template_bigrams(t) for _, t in templates]
    enough = F.lit(False)
    for own in each:
        enough = enough | (F.size(F.array_intersect("__bigrams", literal(own))) >= fewest_common(len(own), least))
    own_hit = best_template(F.col("__bigrams"), templates, least)
    lines = F.transform(F.transform(F.split(whole, "\n"), lambda line: bigrams_of(words_of(line))), lambda b: best_template(b, templates, least))
    lines = F.when(F.instr(whole, "\n") > 0, lines).otherwise(F.array().cast(HITS))
    units = F.concat(F.array(own_hit), lines, window_hits(F.col("__words"), F.col("__bigrams"), templates, least))
    hits = F.when(F.coalesce(enough, F.lit(False)), F.filter(units, lambda hit: hit.isNotNull())).otherwise(F.array().cast(HITS))
    found = paired.withColumn("__hits", hits)
    best = F.array_max(F.col("__hits"))
    return found.withColumns(
        {"license": best.license, "license_dice": best.dice, "license_units": F.size("__hits").cast("long")}
    ).drop("__hits", "__words", "__bigrams")


def oracle(templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST, source: str = "documents") -> str:
    """The same scan for DuckDB, without the keyword test."""
    rows = ",".join(
        f"({i}, '{name}', {len(template_words(text))}, [{','.join(repr(b) for b in template_bigrams(text))}])" for i, (name, text) in enumerate(templates)
    )
    bigrams = lambda w: f"list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
    return f"""
WITH t(rank, license, size, own) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM {source}),
u AS (SELECT r, unnest(CASE WHEN contains(text, chr(10)) THEN list_concat([text], string_split(text, chr(10))) ELSE [text] END) AS unit FROM d),
w AS (SELECT row_number() OVER () AS k, r, string_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ') AS words FROM u),
b AS (SELECT k, r, {bigrams('words')} AS own FROM w WHERE len(words) > 1),
dw AS (SELECT r, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS words FROM d),
dt AS (SELECT r, words, t.* FROM (SELECT r, words, {bigrams('words')} AS every FROM dw) JOIN t ON size >= {LONG} AND len(list_intersect(every, t.own)) * {2 - least} >= len(t.own) * {least} - 1e-6),
win AS (SELECT r, rank, license, own, list_slice(words, pos, pos + size - 1) AS words FROM (SELECT *, unnest(range(1, len(words) + 1, greatest(1, size // {STEPS}))) AS pos FROM dt)),
s AS (SELECT b.r, t.rank, t.license, len(list_intersect(b.own, t.own)) * 2.0::DOUBLE / (len(b.own) + len(t.own)) AS dice, b.k
      FROM b JOIN t ON 2 * least(len(b.own), len(t.own)) >= {least} * (len(b.own) + len(t.own))
      UNION ALL SELECT r, rank, license, len(list_intersect(have, own)) * 2.0::DOUBLE / (len(have) + len(own)), -row_number() OVER ()
      FROM (SELECT *, {bigrams('words')} AS have FROM win WHERE len(words) > 1)),
h AS (SELECT * FROM s WHERE dice >= {least}),
best AS (SELECT r, arg_max(license, (dice, -rank)) AS license, max(dice) AS license_dice, count(DISTINCT k) AS license_units FROM h GROUP BY r)
SELECT d.doc_id, best.license, best.license_dice, coalesce(best.license_units, 0) AS license_units FROM d LEFT JOIN best USING (r)
"""


def license_report(df: DataFrame) -> DataFrame:
    """doc_id and its licence columns."""
    return scan_licenses(df.select("doc_id", "text")).drop("text")
