"""License scans by patience alignment.

Text and template are compared word by word (letters and digits, lower case). Anchors are words
that occur once in both; of the anchors in template order, the longest increasing run in the
text is kept (patience sorting), and the gaps between anchors are aligned in the same way, after
equal words at their ends. Coverage is the share of the template's words that are aligned.

A text can hold a template several times or among much else, so windows are aligned, not the
whole: around every place of the template words that are rarest in the text, as far as the template
reaches. A window can only reach the wanted coverage if it holds enough of the template's
words, so the others are passed over. What the windows leave is then aligned once more, from
each place of those words as far as the word's next places, for copies with long insertions.

Templates are short notices and headers (``TEMPLATES``) and the whole texts of the files in ``licenses``. A text
that has too few words, or too few of a template's words, for the coverage is passed over for that template. Texts of
two versions of a license may share more than the coverage; then both are found.

Null and empty texts have no findings; null ids and repeated rows are scanned like any other, each by itself, whatever
its length: a text's words and their places are held at once. Ties of equally rare words go by the word. An empty table gives
no rows. Only the two named columns are read, so others cannot clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspan.llm.arrow import texts

WORD = re.compile(r"[^\W_]+(?:\.\d+)*")

# Usual notices of public licenses.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd-3-clause-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
}


def whole_texts() -> dict[str, str]:
    """Whole license texts by name: ``Apache-2.0`` and so on."""
    return {path.stem: path.read_text() for path in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing run of ``values``, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    below: list[int] = []
    for i, value in enumerate(values):
        at = bisect_left(tops, value)
        below.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(value)
            piles.append(i)
        else:
            tops[at], piles[at] = value, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = below[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned (text, template) positions, ascending in both."""
    out: list[tuple[int, int]] = []
    stack = [(0, len(text), 0, len(template))]
    while stack:
        a, b, c, d = stack.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        once = Counter(text[a:b])
        places = {w: i for i, w in enumerate(text[a:b], a) if once[w] == 1}
        twice = Counter(template[c:d])
        anchors = [(places[w], j) for j, w in enumerate(template[c:d], c) if twice[w] == 1 and w in places]
        kept = [anchors[i] for i in increasing([i for i, _ in anchors])]
        if not kept:
            continue
        out += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        stack += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(out)


class Template:
    """A template's words, their counts and places, and how many a copy must have."""

    def __init__(self, text: str, coverage: float):
        self.words = words_of(text)
        self.counts = Counter(self.words)
        self.kinds = frozenset(self.counts)
        self.wanted = coverage * len(self.words)
        self.places: dict[str, list[int]] = {}
        for j, w in enumerate(self.words):
            self.places.setdefault(w, []).append(j)

    def common(self, window: list[str]) -> int:
        """Words of a window that are words of the template, each no oftener than in either."""
        return sum((Counter(window) & self.counts).values()) if len(window) >= self.wanted else len(window)


class Windows:
    """Which windows of a text have enough of a template's words, and their alignments.

    A window has no more of the words than one beside it that lacked some, and the words that it has beyond that one: so next to
    such a window most need no count. An alignment falls short of a copy's by what the window lacks of it; one that adds less than half
    of what the last one fell short by isn't made.
    """

    def __init__(self, words: list[str], template: Template):
        self.words, self.template, self.few, self.short = words, template, (0, 0, 0.0), (0, 0, template.wanted)

    def pairs(self, low: int, high: int) -> list[tuple[int, int]]:
        """Aligned positions (within the window) if they cover enough, else none."""
        for (a, b, most), weight in ((self.few, 1), (self.short, 2)):
            if most + weight * (max(0, min(a, high) - low) + max(0, high - max(b, low))) < self.template.wanted:
                return []
        window = self.words[low:high]
        if (n := self.template.common(window)) < self.template.wanted:
            self.few = (low, high, n)
            return []
        found = align(window, self.template.words)
        if len(found) >= self.template.wanted:
            return found
        self.short = (low, high, len(found))
        return []


class Taken:
    """Spans that don't overlap, in order."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, a: int, b: int) -> None:
        k = bisect_left(self.starts, a)
        self.starts.insert(k, a)
        self.ends.insert(k, b)

    def around(self, i: int, low: int, high: int) -> tuple[int, int] | None:
        """The part of low to high around i that is free, or None where i isn't."""
        k = bisect_right(self.starts, i)
        if k and self.ends[k - 1] > i:
            return None
        return max(low, self.ends[k - 1] if k else 0), min(high, self.starts[k] if k < len(self.starts) else high)


def findings(text: str, templates: dict[str, Template]) -> list[tuple[str, float, int, int]]:
    """(name, coverage, first word, word after the last) of the templates that ``text`` holds."""
    words = words_of(text)
    present = set(words)
    out = []
    places: dict[str, list[int]] | None = None
    for name, template in templates.items():
        if len(words) < template.wanted:
            continue
        own, size = template.counts, len(template.words)
        shared = template.kinds & present
        if sum(own[w] for w in shared) < template.wanted:
            continue
        if places is None:
            places = {}
            for i, w in enumerate(words):
                places.setdefault(w, []).append(i)
        # A copy may lack any one word, so windows stand around the rarest words that a copy cannot all lack.
        spare = size - template.wanted
        centres: list[tuple[int, int]] = []
        rarest: list[str] = []
        for w in sorted(shared, key=lambda w: (len(places[w]), w)):
            centres += [(i, j) for i in places[w] for j in template.places[w]]
            rarest.append(w)
            spare -= own[w]
            if spare < 0:
                break
        done, taken, found = 0, Taken(), []
        windows = [Windows(words, template) for _ in range(3)]
        for centre, at in sorted(centres):
            if centre < done:
                continue
            # First as if the copy were exact, then with room for insertions on either side.
            for seen, room in zip(windows, (0, size // 4 + 1)):
                low, high = max(done, centre - at - room), min(len(words), centre - at + size + room)
                if pairs := seen.pairs(low, high):
                    done = low + pairs[-1][0] + 1
                    found.append((name, len(pairs) / size, low + pairs[0][0], done))
                    taken.add(low + pairs[0][0], done)
                    break
        for w in rarest:
            at, n = places[w], own[w]
            for k, i in enumerate(at):
                span = taken.around(i, at[k - n] + 1 if k >= n else 0, at[k + n] if k + n < len(at) else len(words))
                if span and (pairs := windows[2].pairs(*span)):
                    found.append((name, len(pairs) / size, span[0] + pairs[0][0], span[0] + pairs[-1][0] + 1))
                    taken.add(*found[-1][2:])
        out += sorted(found, key=lambda f: f[2])
    return out


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per finding: ``doc_id, license, coverage, start_word, end_word``."""
    prepared = {k: Template(v, coverage) for k, v in (templates or TEMPLATES | whole_texts()).items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *f) for i, t in zip(batch.column(0).to_pylist(), texts(batch.column(1))) for f in findings(t, prepared)]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "license", "coverage", "start_word", "end_word"])

    wanted = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return wanted.mapInArrow(work, "doc_id long, license string, coverage double, start_word int, end_word int")
