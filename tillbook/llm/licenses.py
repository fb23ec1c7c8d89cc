"""License scan by conditional compression.

Method: a line that holds a trigger word is a candidate block, together with the
next such line if at most ``GAP`` lines lie between and the sentence runs on; a
trigger may be broken over two lines.  A block grows over the lines around it,
blank ones too, to the whole of a wrapped notice, if a template is confirmed
there that reaches out of the block: up to ``1 + CHANGED`` times the longest
template's words are looked at on both sides.  Blocks inside a grown one go
unless they are confirmed for another license whose template is no part of the
grown one's.  Each block is compressed with zstandard alone and with every
template as raw dictionary; templates are ranked by how much smaller the block
becomes.  The ``RANKED`` first ones are compared word by word
with the best fitting stretch of the block.

A template is confirmed if at most ``CHANGED`` of its words differ, no word with
a digit (a version) is missing, no word that tells licenses apart or turns a
notice round (``TELLING``, ``NEGATIONS``) is missing or added, none of the
``BEFORE`` words before the stretch in its sentence is a negation, and none of the
``AFTER`` words behind it in its sentence goes on to other terms (``WIDENING``).
Of confirmed templates the one with the most words less twice its changes
wins, of others the one with the smallest share of changed words.

Words are runs of letters, digits and dots between them, lower-cased; white
space and other signs don't count.  Template texts are short standard notices.

Defined cases: null or empty texts and texts without a trigger give no rows;
equal blocks give equal rows; a block that no template makes smaller has a null
license; ties go to the earlier template; repeated rows repeat; a null doc_id is carried;
blocks of any length are compared whole; further columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import id_and_text, read_table

GAP = 2
RANKED = 8
CHANGED = 0.2
LEVEL = 9
REMEMBERED = 100_000
BEFORE, AFTER = 3, 12

# Words that open a look at a block.
TRIGGERS = ["licen[sc]e", "licen[sc]ed", "licen[sc]es", "copyright", "all rights reserved", "permission is hereby granted", "permission to use", "redistribution", "public domain", "creative commons", "without warranty", "cc by", "cc0", "spdx"]

# Words that turn a notice round.
NEGATIONS = ["not", "no", "never", "neither", "nor", "cannot", "without", "unless", "except", "isn", "aren", "wasn", "weren", "doesn", "didn"]

# Words that tell licenses of one family apart, and words behind a notice that change its terms.
TELLING = ["lesser", "library", "affero", "sharealike", "noncommercial", "noderivatives", "noderivs", "sa", "nc", "nd", "endorse", "advertising", "later", "newer"]
WIDENING = ["later", "newer", "provided"]

# Disclaimers and conditions that several licenses share.
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_CONDITIONS = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
_MIT_REST = 'The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_GNU = "under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."

# Standard notices and texts of public licenses.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", _MIT_GRANT),
    ("MIT", f"{_MIT_GRANT} {_MIT_REST}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-or-later", "This work is licensed under the GNU General Public License, version 2 or later."),
    ("GPL-3.0-or-later", "This work is licensed under the GNU General Public License, version 3 or later."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it " + _GNU.format("General Public License", 2)),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it " + _GNU.format("General Public License", 3)),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it " + _GNU.format("Lesser General Public License", 2.1)),
    ("LGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it " + _GNU.format("Lesser General Public License", 3)),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it " + _GNU.format("Affero General Public License", 3)),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD", _BSD_HEAD),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_CONDITIONS} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_END}"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights. Released under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", _CC.format("Attribution")),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike")),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial")),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", _CC.format("Attribution-NoDerivatives")),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", _CC.format("Attribution-NonCommercial-ShareAlike")),
    ("All-Rights-Reserved", "All rights reserved."),
]

_NEGATED, _TELLING, _WIDENING = frozenset(NEGATIONS), frozenset(NEGATIONS + TELLING), frozenset(WIDENING)
_TRIGGER = re.compile(r"\b(?:" + "|".join(TRIGGERS) + r")\b", re.IGNORECASE)
_BREAK = r"(?: |[ \t\r]*\n[^\w\n]*)"  # a space, or a line's end and the signs that open the next one
_BROKEN = re.compile(r"\b(?:" + "|".join(t.replace(" ", _BREAK) for t in TRIGGERS if " " in t) + r")\b", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")


_STOP = re.compile(r"[.!?:;][^\w\s]*\s")
_STOPS = frozenset(".!?:;")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def blocks(text: str) -> list[tuple[int, int]]:
    """First and last line of each candidate block."""
    lines = text.split("\n")
    broken: set[int] = set()
    counted, first = 0, 0
    for found in _BROKEN.finditer(text):
        if "\n" in found.group():
            first, counted = first + text.count("\n", counted, found.start()), found.start()
            broken.update(range(first, first + found.group().count("\n") + 1))
    out: list[list[int]] = []
    for n, line in enumerate(lines):
        if n in broken or _TRIGGER.search(line):
            if out and n - out[-1][1] <= GAP + 1 and _runs_on(lines[out[-1][1] : n]):
                out[-1][1] = n
            else:
                out.append([n, n])
    return [(a, b) for a, b in out]


def _runs_on(lines: list[str]) -> bool:
    """Whether a sentence goes on after each of these lines: none is blank or ends one."""
    return all(line.strip() and not line.rstrip().endswith((".", "!", "?", ":")) for line in lines)


class Passage(NamedTuple):
    """Words, and the line and the sentence of each."""

    words: list[str]
    lines: list[int]
    sentences: list[int]

    def cut(self, begin: int, end: int) -> Passage:
        return Passage(*(part[begin:end] for part in self))


def passage(lines: list[str], numbers: range) -> Passage:
    """The words of these lines; a blank line ends a sentence too."""
    out, sentence = Passage([], [], []), 0
    for n in numbers:
        line, last = lines[n], 0
        for found in _WORD.finditer(line):
            sentence += _STOP.search(line, last, found.start()) is not None
            last = found.end()
            out.words.append(found.group().lower())
            out.lines.append(n)
            out.sentences.append(sentence)
        sentence += last == 0 or not _STOPS.isdisjoint(line[last:])
    return out


def _reached(lines: list[str], numbers: range, reach: int) -> int:
    """How many of the lines, taken in this order, hold ``reach`` words (all, if fewer)."""
    for taken, n in enumerate(numbers):
        if reach <= 0:
            return taken
        reach -= sum(1 for _ in _WORD.finditer(lines[n]))
    return len(numbers)


def around(lines: list[str], a: int, b: int, before: int, after: int) -> tuple[Passage, int, int]:
    """Lines a to b with so many words before and after them, and where their own words begin and end."""
    first = a - _reached(lines, range(a - 1, -1, -1), before)
    last = b + _reached(lines, range(b + 1, len(lines)), after)
    every = passage(lines, range(first, last + 1))
    begin, end = bisect_left(every.lines, a), bisect_right(every.lines, b)
    least = max(0, begin - before)
    return every.cut(least, end + after), begin - least, end - least


class Templates:
    """Compressors and words of the templates."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.names = [n for n, _ in templates]
        self.words = [words(t) for _, t in templates]
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.with_template = [self._primed(t) for _, t in templates]
        self.with_words = [self._primed(" ".join(w)) for w in self.words]
        spaced = [f" {' '.join(w)} " for w in self.words]
        self.parts = [{k for k, part in enumerate(spaced) if part in whole} for whole in spaced]
        self.known: dict[tuple, dict] = {}
        self.reach = math.ceil((1 + CHANGED) * max(map(len, self.words), default=0))

    @staticmethod
    def _primed(text: str) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False)

    def reductions(self, block: str) -> list[float]:
        return self._smaller(block, self.with_template)

    def _smaller(self, block: str, compressors: list[zstandard.ZstdCompressor]) -> list[float]:
        raw = block.encode()
        alone = len(self.plain.compress(raw))
        return [1 - len(c.compress(raw)) / alone for c in compressors]

    def look(self, block: str) -> dict:
        """The winner for a block that stands alone, its changes, and the verdict."""
        lines = block.split("\n")
        return self.look_at(lines, 0, len(lines) - 1)

    def look_at(self, lines: list[str], a: int, b: int) -> dict:
        """The same for the block of lines a to b of a text, whose sentences may begin before it and go on behind it."""
        block = "\n".join(lines[a : b + 1])
        own, begin, end = around(lines, a, b, BEFORE, AFTER)
        key = (block, tuple(own.words[:begin]), tuple(own.words[end:]), tuple(own.sentences))
        if key not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known = {}
            self.known[key] = self._look(block, own, begin, end)
        return self.known[key]

    def _look(self, block: str, own: Passage, begin: int, end: int) -> dict:
        gain = self.reductions(block)
        ranked = sorted((k for k in range(len(gain)) if gain[k] > 0), key=lambda k: (-gain[k], k))[:RANKED]
        if not ranked:
            return {"license": None, "reduction": 0.0, "missing": [], "added": [], "n_changes": None, "exact": False, "confirmed": False, "template": None}
        inner = own.words[begin:end]
        said = []
        for k in ranked:
            changes, first, last = fit(self.words[k], inner)
            said.append(self._said(k, gain[k], own, (changes, begin + first, begin + last)))
        return min(said, key=self._worse)

    def _worse(self, said: dict) -> tuple:
        """Sorts the better verdict first."""
        k = said["template"]
        size, changes = len(self.words[k]), said["n_changes"]
        return not said["confirmed"], 2 * changes - size if said["confirmed"] else changes / size, -said["reduction"], k

    def _said(self, k: int, gain: float, own: Passage, fitted: tuple[int, int, int]) -> dict:
        changes, begin, end = fitted
        missing, added = differences(self.words[k], own.words[begin:end])
        confirmed = begin < end and changes <= CHANGED * len(self.words[k]) and not any(c.isdigit() for w in missing for c in w) and _TELLING.isdisjoint(missing + added)
        if confirmed:
            before = {own.words[i] for i in range(max(0, begin - BEFORE), begin) if own.sentences[i] == own.sentences[begin]}
            after = {own.words[i] for i in range(end, min(end + AFTER, len(own.words))) if own.sentences[i] == own.sentences[end - 1]}
            confirmed = _NEGATED.isdisjoint(before) and _WIDENING.isdisjoint(after)
        return {"license": self.names[k], "reduction": gain, "missing": missing, "added": added, "n_changes": changes, "exact": changes == 0, "confirmed": confirmed, "template": k}

    def grown(self, lines: list[str], a: int, b: int) -> tuple[int, int, dict] | None:
        """The block of lines a to b grown to a whole notice, and what is said of it; none if no template reaches out of the block."""
        own, _, _ = around(lines, a, b, self.reach + BEFORE, self.reach + AFTER)
        here, found = set(own.words), []
        # each word that is not there is a change
        possible = [k for k, template in enumerate(self.words) if sum(w not in here for w in template) <= CHANGED * len(template)]
        if not possible:
            return None
        gain = dict(zip(possible, self._smaller(" ".join(own.words), [self.with_words[k] for k in possible]), strict=True))
        for k in sorted(possible, key=lambda k: (-gain[k], k))[:RANKED]:
            changes, begin, end = fit(self.words[k], own.words)
            if begin < end and changes <= CHANGED * len(self.words[k]):
                first, last = own.lines[begin], own.lines[end - 1]
                if first <= b and last >= a and (first < a or last > b):
                    said = self._said(k, gain[k], own, (changes, begin, end))
                    if said["confirmed"]:
                        found.append((min(a, first), max(b, last), said))
        if not found:
            return None
        first, last, said = min(found, key=lambda x: self._worse(x[2]))
        return first, last, said | {"reduction": self.reductions("\n".join(lines[first : last + 1]))[said["template"]]}

    def scan(self, text: str) -> list[tuple[int, int, dict]]:
        """First and last line of each block of a text, and what is said of it."""
        lines = text.split("\n")
        core = [(a, b, self.look_at(lines, a, b)) for a, b in blocks(text)]
        whole = {(a, b, said["license"]): (a, b, said) for a, b, said in filter(None, (self.grown(lines, a, b) for a, b, _ in core))}
        # by first line, the longest first: of what began before, the furthest line that a license or template covers is enough
        every = sorted([(a, -b, 0, said) for a, b, said in whole.values()] + [(a, -b, 1, said) for a, b, said in core], key=lambda x: x[:3])
        out, furthest = [], -1
        licenses: dict[str, int] = {}
        covered: dict[int, int] = {}
        for a, b, is_core, said in ((a, -b, c, said) for a, b, c, said in every):
            if b <= licenses.get(said["license"], -1) or (is_core and b <= (covered.get(said["template"], -1) if said["confirmed"] else furthest)):
                continue
            out.append((a, b, said))
            if not is_core:
                furthest, licenses[said["license"]] = max(furthest, b), b
                for part in self.parts[said["template"]]:
                    covered[part] = max(covered.get(part, -1), b)
        return out


def _sweep(template: list[str], text: list[str]) -> np.ndarray:
    """Fewest word edits between the template and a stretch of the text that ends before each place."""
    codes = {w: i for i, w in enumerate(dict.fromkeys(template))}
    own = np.array([codes.get(w, -1) for w in text], np.int64)
    places = np.arange(len(own) + 1)
    row = np.zeros(len(own) + 1, np.int64)
    for w in template:
        best = row + 1
        best[1:] = np.minimum(best[1:], row[:-1] + (own != codes[w]))
        row = np.minimum.accumulate(best - places) + places
    return row


def fit(template: list[str], text: list[str]) -> tuple[int, int, int]:
    """Edits of the best fitting stretch of the text, and the stretch (the earliest end, the longest of those)."""
    forward = _sweep(template, text)
    end = int(np.argmin(forward))
    backward = _sweep(template[::-1], text[:end][::-1])
    length = int(np.flatnonzero(backward == forward[end])[-1]) if (backward == forward[end]).any() else end
    return int(forward[end]), end - length, end


def differences(template: list[str], stretch: list[str]) -> tuple[list[str], list[str]]:
    """Words of the template that the stretch lacks, and words it has instead or in addition."""
    missing, added = [], []
    for kind, a, b, c, d in SequenceMatcher(None, template, stretch, autojunk=False).get_opcodes():
        if kind != "equal":
            missing += template[a:b]
            added += stretch[c:d]
    return missing, added


@lru_cache(maxsize=1)
def _loaded(templates: tuple[tuple[str, str], ...]) -> Templates:
    return Templates(list(templates))


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("block", pa.int32()),
        ("first_line", pa.int32()),
        ("n_lines", pa.int32()),
        ("license", pa.string()),
        ("reduction", pa.float64()),
        ("n_changes", pa.int32()),
        ("missing", pa.list_(pa.string())),
        ("added", pa.list_(pa.string())),
        ("exact", pa.bool_()),
        ("confirmed", pa.bool_()),
    ]
)
FOUND = "doc_id long, block int, first_line int, n_lines int, license string, reduction double, n_changes int, missing array<string>, added array<string>, exact boolean, confirmed boolean"


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """A row for each candidate block: its place, the winning license and how its wording differs."""
    given = tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = _loaded(given)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for n, (a, b, said) in enumerate(loaded.scan(text)):
                    rows.append({"doc_id": doc_id, "block": n, "first_line": a, "n_lines": b - a + 1, **said})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    triggered = id_and_text(docs).where(F.col("text").rlike("(?i)(" + "|".join(t.replace(" ", _BREAK) for t in TRIGGERS) + ")"))
    return triggered.mapInArrow(run, FOUND)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))
