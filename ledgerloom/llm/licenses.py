"""License scans: Dice coefficient of word bigrams against licence templates.

A text's units are its lines, its paragraphs of several lines, itself, and its
windows: runs of words that start and end with a bigram of a template.
Units and templates are normalised to lower-case words; a unit matches the
template of the largest Dice coefficient 2 |A & B| / (|A| + |B|) of their sets
of bigrams if that is at least ``DICE``. As the coefficient is at most
2 min / (|A| + |B|), only templates within the size bounds
DICE / (2 - DICE) <= |A| / |B| <= (2 - DICE) / DICE can match a unit, and a
unit that shares no bigram with any template matches none. Windows are compared
with a template only where the text has DICE / (2 - DICE) of its bigrams, as a
match must; then the best end of every start is found. Templates are notices,
file headers and the complete texts in ``license_texts``.

Results for odd input: null, empty and one-word texts have no bigrams and match
nothing; of equal coefficients the first template in alphabetical order wins;
repeated rows give a row each; an empty table gives no rows. Whole texts are
read, of any length.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship

DICE = 0.8
WORDS = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")

# Licence notices as they stand in files, in order of identifier.
TEMPLATES: dict[str, list[str]] = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": [
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain."],
}

DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TWO = TEMPLATES["BSD-2-Clause"][1]
#: Complete texts and headers that stand before the notices.
COMPLETE: dict[str, list[str]] = {
    "BSD-2-Clause": [f"{TWO} {DISCLAIMER}"],
    "BSD-3-Clause": [f"{TWO} 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                     f"endorse or promote products derived from this software without specific prior written permission. "
                     f"{DISCLAIMER}"],
    "ISC": [TEMPLATES["ISC"][1] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
            "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
            "THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
            "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
            "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "LGPL-2.1": [TEMPLATES["GPL-2.0"][1].replace("version 2 ", "version 2.1 ").replace("General", "Lesser General")
                 .replace("This program", "This library")],
    "LGPL-3.0": [TEMPLATES["GPL-3.0"][1].replace("General", "Lesser General")],
    "MIT": [TEMPLATES["MIT"][2] + " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
            "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
            "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
            "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
            "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
}
# Read where the package is a folder, on the driver; executors get the templates from there.
for _file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
    COMPLETE.setdefault(_file.stem, []).append(" ".join(_file.read_text(encoding="utf-8").split()))
for _name, _texts in COMPLETE.items():
    TEMPLATES[_name] = _texts + TEMPLATES.get(_name, [])


def bigrams(text: str) -> set[tuple[str, str]]:
    words = WORDS.findall(text.lower())
    return set(zip(words, words[1:], strict=False))


class Templates:
    """Template bigrams by size."""

    def __init__(self, texts: dict[str, list[str]] = TEMPLATES, dice: float = DICE):
        rows = sorted((len(g), name, g) for name, all_ in texts.items() for g in map(bigrams, all_) if g)
        self.sizes = [n for n, _, _ in rows]
        self.rows = [(name, g) for _, name, g in rows]
        self.any = set().union(*(g for _, g in self.rows)) if rows else set()
        self.dice = dice
        self.having: dict[tuple[str, str], list[int]] = {}
        for i, (_, g) in enumerate(self.rows):
            for x in g:
                self.having.setdefault(x, []).append(i)

    def windows(self, text: str) -> Iterator[tuple[float, str, int, int, int]]:
        """``dice, license, size of the template, start, end`` of each start's best window."""
        words = [(m[0], m.start(), m.end()) for m in WORDS.finditer(text.lower() if len(text.lower()) == len(text)
                                                                    else "".join(low(c) for c in text))]
        grams = [(a[0], b[0]) for a, b in zip(words, words[1:], strict=False)]
        if self.any.isdisjoint(grams):
            return
        have = Counter(i for x in set(grams) & self.any for i in self.having[x])
        d = self.dice
        wanted = [i for i, n in have.items() if n >= d / (2 - d) * self.sizes[i] - 1e-9]
        if not wanted:
            return
        last: dict[tuple[str, str], int] = {}
        before = np.empty(len(grams), np.int64)
        for x, g in enumerate(grams):
            before[x] = last.get(g, -1)
            last[g] = x
        for i in wanted:
            name, g = self.rows[i]
            n, most = len(g), len(g) * (2 - d) / d + 1e-9
            inside = np.fromiter((x in g for x in grams), bool, len(grams))
            # How many of the template's bigrams a window from each word on can gain at most.
            final = np.zeros(len(grams), np.int64)
            final[[last[x] for x in g if x in last]] = 1
            left = np.cumsum(final[::-1])[::-1]
            for s in np.flatnonzero(inside).tolist():
                reach = int(most) + 2
                while True:
                    fresh = before[s:s + reach] < s
                    size, hits = np.cumsum(fresh), np.cumsum(fresh & inside[s:s + reach])
                    if size[-1] > most or hits[-1] == left[s] or s + reach >= len(grams):
                        break  # from here on the coefficient only falls
                    reach *= 2
                dice = 2 * hits / (size + n)
                at = int(np.argmax(dice))
                if dice[at] >= d:
                    yield float(dice[at]), name, n, words[s][1], words[s + at + 1][2]

    def best(self, grams: set) -> tuple[float, str] | None:
        if self.any.isdisjoint(grams):
            return None
        n, d = len(grams), self.dice
        lo = bisect_left(self.sizes, n * d / (2 - d) - 1e-9)
        hi = bisect_right(self.sizes, n * (2 - d) / d + 1e-9)
        found = [(-2 * len(grams & g) / (n + len(g)), name) for name, g in self.rows[lo:hi]]
        score, name = min(found, default=(0.0, ""))
        return (-score, name) if -score >= d else None


def low(c: str) -> str:
    """A character in lower case where that is one character, so that places stay."""
    return x if len(x := c.lower()) == 1 else c


def units(text: str) -> Iterator[tuple[int, int]]:
    """Spans of a text's lines, paragraphs of several lines, and itself."""
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, at + len(line)))
        at += len(line) + 1
    full = [(a, b) for a, b in lines if text[a:b].strip()]
    yield from full
    start = None
    paragraphs = []
    for a, b in [*lines, (len(text), len(text))]:
        blank = not text[a:b].strip()
        if start is None and not blank:
            start, first, end = a, b, b
        elif start is not None and blank:
            if end != first:
                paragraphs.append((start, end))
            start = None
        elif not blank:
            end = b
    if start is not None and end != first:
        paragraphs.append((start, end))
    yield from paragraphs
    whole = (full[0][0], full[-1][1]) if full else (0, 0)
    if len(full) > 1 and [whole] != paragraphs:
        yield whole


def matches(text: str, templates: Templates) -> list[tuple[str, float, int, int]]:
    """``license, dice, start, end`` of the units that match, by position.

    Of overlapping units the one of the larger coefficient counts; of equal ones
    a line, paragraph or whole text before a window, the window of the larger
    template, and the shorter.
    """
    found = [(-got[0], 0, b - a, got[1], a, b) for a, b in units(text)
             if (got := templates.best(bigrams(text[a:b]))) is not None]
    found += [(-score, 1 / n, b - a, name, a, b) for score, name, n, a, b in templates.windows(text)]
    taken: list[tuple[int, int]] = []
    out = []
    for score, _, _, name, a, b in sorted(found):
        i = bisect_left(taken, (a, a))
        if (i == 0 or taken[i - 1][1] <= a) and (i == len(taken) or taken[i][0] >= b):
            taken.insert(i, (a, b))
            out.append((name, round(-score, 6), a, b))
    return sorted(out, key=lambda x: x[2])


def scan(docs: DataFrame, texts: dict[str, list[str]] = TEMPLATES, dice: float = DICE) -> DataFrame:
    """One row per document: ``doc_id, n_matches, best_license, best_dice, spans``.

    ``spans`` lists ``license, dice, start, end`` (code points, end exclusive).
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()),
                               ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(texts, dice)
        for b in batches:
            got = [matches(t.as_py() or "", templates) for t in b.column(1)]
            best = [min(((-d, x) for x, d, _, _ in g), default=(None, None)) for g in got]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(map(len, got), pa.int64()), pa.array([x for _, x in best], pa.string()),
                 pa.array([None if d is None else -d for d, _ in best], pa.float64()),
                 pa.array([[dict(zip(("license", "dice", "start", "end"), x, strict=True)) for x in g]
                           for g in got], span)],
                ["doc_id", "n_matches", "best_license", "best_dice", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_matches long, best_license string, best_dice double, "
             f"spans array<struct<license: string, dice: double, start: int, end: int>>")
