"""Licence scans: passages of documents against licence templates by Dice coefficient over word bigrams.

Text is normalised to lower-case words of letters and digits. Every line, every paragraph (lines up to a blank one) and
the whole text is a passage, and so is every run of words, wherever it starts and ends, with no more bigrams, repeated
ones included, than the bounds below allow a set. With A and B the sets of bigrams, the coefficient 2|A and B| / (|A| + |B|) cannot reach t
unless |A| lies between t / (2 - t) and (2 - t) / t times |B|, so templates are kept in order of size and only those
within the bounds are compared; a passage that shares no bigram with any template is done at once. Templates of a single
word, and passages of one, are compared by that word. Of the runs only those need a look that begin and end with a bigram
of the template, as dropping others from the ends never lowers the coefficient, and that hold t / (2 - t) times |B| such
bigrams.

Scale: map-only; the templates are a fixed list, a document is read once whatever its length.

Defined results: a document has a row for each template that one of its passages reaches (the best passage, ties to the
earlier first line, then to fewer lines); null, blank and wordless texts have none; repeated rows give repeated results,
null ids are ordinary, an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping
from math import ceil, floor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersync.llm.common import table

# Short notices and texts by which licences are declared.
TEMPLATES = {
    "AGPL-3.0/notice": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    "See the License for the specific language governing permissions and limitations under the License.",
    "BSD-3-Clause/notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0/short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0/notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-4.0/short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0/notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0/short": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0/notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "BSD-2-Clause/text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.",
    "BSD-3-Clause/text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission.",
    "GPL-2.0/header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0/notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0/notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC/text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies.",
    "MIT/notice": "Released under the MIT License.",
    "MIT/text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT/warranty": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE.",
    "MPL-2.0/header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
    "You can obtain one at http://mozilla.org/MPL/2.0/.",
}

_WORDS = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def bigrams(w: list[str]) -> frozenset[tuple[str, ...]]:
    return frozenset(zip(w, w[1:], strict=False)) if len(w) > 1 else frozenset([tuple(w)] if w else [])


class Scanner:
    """Templates in order of their number of bigrams."""

    def __init__(self, templates: Mapping[str, str], least: float) -> None:
        sets = sorted((len(b), name, b) for name, text in templates.items() if (b := bigrams(words(text))))
        self.least = least
        self.sizes = [n for n, _, _ in sets]
        self.templates = [(name, b) for _, name, b in sets]
        self.every = frozenset().union(*(b for _, _, b in sets)) if sets else frozenset()
        self.low, self.high = least / (2 - least), (2 - least) / least
        self.holders: dict[tuple[str, ...], list[int]] = {}
        for k, (_, b) in enumerate(self.templates):
            for pair in b:
                self.holders.setdefault(pair, []).append(k)

    def compare(self, w: list[str]) -> Iterator[tuple[str, float]]:
        """(template, coefficient) of the templates that the passage reaches."""
        if not self.sizes or len(w) - 1 < self.low * self.sizes[0] - 1:
            return
        found = bigrams(w)
        if self.every.isdisjoint(found):
            return
        n = len(found)
        for name, b in self.templates[bisect_left(self.sizes, self.low * n - 1e-9) : bisect_right(self.sizes, self.high * n + 1e-9)]:
            dice = 2 * len(found & b) / (n + len(b))
            if dice >= self.least:
                yield name, dice

    def runs(self, w: list[str], line: list[int]) -> Iterator[tuple[str, float, int, int]]:
        """(template, coefficient, first line, lines) of runs of words that a template reaches, the best among them."""
        pairs = list(zip(w, w[1:], strict=False))
        at: dict[int, list[int]] = {}
        for k, pair in enumerate(pairs):
            for i in self.holders.get(pair, ()):
                at.setdefault(i, []).append(k)
        for i, places in at.items():
            name, b = self.templates[i]
            needed, longest = max(1, ceil(self.low * len(b) - 1e-9)), floor(self.high * len(b) + 1e-9)
            best = (0.0, 0, 0)  # coefficient, first line, lines
            for s in range(len(places) - needed + 1):
                first = places[s]
                if best[0] == 1.0 and (best[2] == 1 or line[first] > best[1]):
                    break
                if places[s + needed - 1] - first >= longest:
                    continue
                found, shared, until = set(), set(), first
                for last in places[s:]:
                    if last - first >= longest or len(shared) == len(b):
                        break
                    found.update(pairs[until : last + 1])
                    shared.add(pairs[last])
                    until = last + 1
                    dice = 2 * len(shared) / (len(found) + len(b))
                    if dice >= self.least:
                        new = (dice, line[first], line[last + 1] - line[first] + 1)
                        if (-new[0], *new[1:]) < (-best[0], *best[1:]):
                            best = new
            if best[0]:
                yield name, *best

    def scan(self, text: str) -> dict[str, tuple[float, int, int]]:
        """{template: (coefficient, first line, lines)} of the best passages; lines count from 1."""
        best: dict[str, tuple[float, int, int]] = {}

        def look(w: list[str], first: int, lines: int) -> None:
            for name, dice in self.compare(w):
                old = best.get(name)
                if old is None or (-dice, first, lines) < (-old[0], old[1], old[2]):
                    best[name] = (dice, first, lines)

        lines = text.split("\n")
        split = [words(x) for x in lines]
        start = 0
        for k, w in enumerate([*split, []]):
            if w:
                look(w, k + 1, 1)
            if k == len(lines) or not lines[k].strip():
                if k - start > 1:
                    look([x for part in split[start:k] for x in part], start + 1, k - start)
                start = k + 1
        whole = [x for part in split for x in part]
        if len(lines) > 1:
            look(whole, 1, len(lines))
        for name, dice, first, n in self.runs(whole, [k for k, part in enumerate(split, 1) for _ in part]):
            old = best.get(name)
            if old is None or (-dice, first, n) < (-old[0], old[1], old[2]):
                best[name] = (dice, first, n)
        return best


def scan_licences(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """(doc_id, licence, template, dice, first_line, n_lines) for ``docs`` (doc_id, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for batch in batches:
            at, rows = [], []
            for k, text in enumerate(batch.column("text")):
                found = scanner.scan(text.as_py()) if text.is_valid else {}
                at += [k] * len(found)
                rows += [(name.split("/")[0], name, *best) for name, best in sorted(found.items())]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            made = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), *made], ["doc_id", "licence", "template", "dice", "first_line", "n_lines"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, licence string, template string, dice double, first_line long, n_lines long")


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


QUERIES = {"op7_licence_scan": op7_licence_scan}
SQL: dict[str, str] = {}
