"""Licence scans: Dice coefficient over word bigrams of normalised text.

A document's units are its lines, its paragraphs (lines between blank lines), the
whole text and all runs of consecutive lines, blank ones among them.  Unit and
template are normalised (lower case, words of letters, digits and inner dots; a
copyright notice that begins a line dropped with its years and names, up to the end
of its sentence or a word that begins a licence) and compared as multisets of word bigrams: ``2 * shared / (bigrams of the unit +
bigrams of the template)``.  A template can reach ``SIMILARITY`` only if the
smaller of the two has at least ``SIMILARITY / (2 - SIMILARITY)`` of the larger
one's bigrams: units outside the bounds of all templates are not even split, and
for each unit only the templates within its bounds that share a bigram are
compared.  Templates are given, few and small, so they go to every task;
documents are scanned where they are, without a shuffle.

Runs of lines: with ``h`` of a unit's ``n`` bigrams in a template of ``T``, the
coefficient reaches ``SIMILARITY`` only if ``h - n * SIMILARITY / 2`` is at least
``T * SIMILARITY / 2``.  Running sums of that difference give, in one pass over the
lines with such bigrams, the lines where a run can begin at all; only from those on
are the runs within the size bounds compared, line by line.

Defined cases: null text and texts without a unit in bounds give no rows; a unit
of one word has no bigram and matches nothing; ties between templates go to the
larger one, then by name; for each document and template the best unit counts
(then line before paragraph before whole text before run, then the earliest); repeated rows
are scanned each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import small_batches

SIMILARITY = 0.8

# Public licence notices and texts.
TEMPLATES = {
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "MIT-short": "Released under the MIT License.",
    "MIT-reference": "This software is licensed under the terms of the MIT license.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        "\"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "GPL-2.0-short": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/."),
    "LGPL-3.0-short": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "BSD-style-reference": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
}
UNITS = ("line", "paragraph", "text", "run")

_COPYRIGHT = re.compile(r"(?i)\W*(?:copyright\b(?!\s+(?:and|holders?|laws?|licen[cs]es?|notices?|or|owners?|statements?)\b)|\(c\)|©)")
# Where a copyright notice ends: a sentence's end (not after an initial or Inc.), or before a word that begins a licence.
_CLAUSE_END = re.compile(
    r"(?i)(?<!\W\w)(?<!\binc)(?<!\bltd)(?<!\bco)(?<!\bcorp)(?<!\bjr)(?<!\bsr)(?<!\bet al)[.;](?=\s+\S)"
    r"|(?=\b(?:licen[cs]ed|released|distributed|redistributions?|permission|this|use of|to the extent)\s)")
_RESERVED = re.compile(r"(?i)\W*(?:all|some|no) rights reserved\b")
_TOKEN = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")


def line_words(line: str) -> list[str]:
    """The normalised words of one line."""
    while notice := _COPYRIGHT.match(line):
        stop = _CLAUSE_END.search(line, notice.end())
        line = line[stop.end():] if stop else ""
        if reserved := _RESERVED.match(line):
            line = line[reserved.end():]
    return _TOKEN.findall(line.lower())


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:]))


class Matcher:
    """Templates by bigram, with the bounds that prune them."""

    def __init__(self, templates: dict[str, str], similarity: float):
        self.similarity = similarity
        self.grams = {name: bigrams([w for line in t.split("\n") for w in line_words(line)]) for name, t in templates.items()}
        self.size = {name: sum(g.values()) for name, g in self.grams.items()}
        self.having = defaultdict(list)
        for name, g in self.grams.items():
            for x in g:
                self.having[x].append(name)
        ratio = similarity / (2 - similarity)
        self.low = {n: s * ratio - 1e-9 for n, s in self.size.items()}
        self.high = {n: s / ratio + 1e-9 for n, s in self.size.items()}
        self.least, self.most = min(self.low.values(), default=0), max(self.high.values(), default=-1)

    def best(self, words: list[str]) -> dict[str, float]:
        """Dice coefficient of each template that reaches the similarity."""
        n = len(words) - 1
        if not self.least <= n <= self.most or n < 1:
            return {}
        grams = bigrams(words)
        shared: Counter = Counter()
        for x, c in grams.items():
            for name in self.having.get(x, ()):
                if self.low[name] <= n <= self.high[name]:
                    shared[name] += min(c, self.grams[name][x])
        dice = {name: 2 * s / (n + self.size[name]) for name, s in shared.items()}
        return {name: d for name, d in dice.items() if d >= self.similarity}

    def runs(self, lines: list[list[str]]) -> Iterator[tuple[str, float, int]]:
        """(template, dice, first line) of the best run of two or more lines for
        each template that one reaches."""
        words = list(chain.from_iterable(lines))
        having, places = self.having, defaultdict(list)
        for i, x in enumerate(zip(words, words[1:])):
            if x in having:
                for name in having[x]:
                    places[name].append(i)
        half = self.similarity / 2
        line_of = first = None
        for name, hits in places.items():
            size = self.size[name]
            if len(hits) < half * (size + self.low[name]) - 1e-9:
                continue
            if line_of is None:
                line_of = list(chain.from_iterable([k] * len(x) for k, x in enumerate(lines)))
                first = list(accumulate((len(x) for x in lines), initial=0))
            # A best run begins in a line with a hit's first word and ends in one with a hit's second word.
            starts, stops, ends = [], [], []     # (line, hits before); hits up to; word after
            for k, i in enumerate(hits):
                if not starts or starts[-1][0] != line_of[i]:
                    starts.append((line_of[i], k))
                stop = first[line_of[i + 1] + 1]
                if ends and ends[-1] == stop:
                    stops[-1] = k + 1
                else:
                    ends.append(stop)
                    stops.append(k + 1)
            gain = [h - half * (e - 1) for h, e in zip(stops, ends, strict=True)]
            ahead = list(accumulate(reversed(gain), max))[::-1]
            best, grams = None, self.grams[name]
            for line, before in starts:
                begin = first[line]
                j = bisect_right(ends, begin)
                if j == len(ends) or ahead[j] - (before - half * begin) < half * size - 1e-9:
                    continue
                count: Counter = Counter()
                shared, k = 0, before
                while j < len(ends) and (n := ends[j] - 1 - begin) <= self.high[name]:
                    while k < stops[j]:
                        x = words[hits[k]], words[hits[k] + 1]
                        count[x] += 1
                        shared += count[x] <= grams[x]
                        k += 1
                    d = 2 * shared / (n + size)
                    if d >= self.similarity and line_of[ends[j] - 1] > line and (best is None or d > best[0]):
                        best = (d, line)
                    j += 1
            if best:
                yield name, *best

    def scan(self, text: str) -> list[tuple[str, float, str, int]]:
        """(template, dice, unit, first line) of the best unit for each template."""
        lines, found = [line_words(line) for line in text.split("\n")], {}
        blank = [not line.strip() for line in text.split("\n")]

        def look(kind: int, at: int, words: list[str]):
            for name, d in self.best(words).items():
                key = (-d, kind, at)
                if name not in found or key < found[name]:
                    found[name] = key

        start = 0
        for i, empty in enumerate([*blank, True]):
            if not empty:
                look(0, i, lines[i])
                continue
            if i - start > 1:
                look(1, start, list(chain.from_iterable(lines[start:i])))
            start = i + 1
        if len(lines) > 1:
            look(2, 0, list(chain.from_iterable(lines)))
            for name, d, at in self.runs(lines):
                if name not in found or (-d, 3, at) < found[name]:
                    found[name] = (-d, 3, at)
        return [(name, -d, UNITS[kind], at) for name, (d, kind, at) in found.items()]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, license, dice, unit, line, best) for every template that a row's
    text reaches; ``best`` marks the row's closest one."""
    small_batches(docs.sparkSession)
    given = TEMPLATES if templates is None else templates

    def run(batches):
        match = Matcher(given, similarity)
        for b in batches:
            out = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = sorted(match.scan(text or ""), key=lambda r: (-r[1], -match.size[r[0]], r[0]))
                out += [{"doc_id": i, "license": n, "dice": d, "unit": u, "line": at, "best": k == 0} for k, (n, d, u, at) in enumerate(rows)]
            yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, license string, dice double, unit string, line int, best boolean"))


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("dice", pa.float64()), ("unit", pa.string()),
                     ("line", pa.int32()), ("best", pa.bool_())])
