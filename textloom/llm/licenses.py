"""License scans by conditional compression against templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.ship import ship

#: The wording of notices that are in common use.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("BSD", "Released under the BSD License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)
#: What names a license, in the lower-case words of a run: a run without it is no notice of a template that has it.
#: Apache's version may be another; ``differences`` tells.
NAMES = {
    "Apache-2.0": r"(?<!\S)apache(?:-\S+)?(?!\S)",
    "MIT": r"(?<!\S)mit(?:[-+.]\S+)?(?!\S)",
    "BSD": r"(?<!\S)bsd(?:-\S+)?(?!\S)",
    "GPL-3.0": r"(?<!affero )(?<!lesser )(?<!library )general public license(?: \S+)*? v?3(?:\.0)?(?!\S)",
    "GPL-2.0": r"(?<!affero )(?<!lesser )(?<!library )general public license(?: \S+)*? v?2(?:\.0)?(?!\S)",
    "AGPL-3.0": r"affero general public license(?: \S+)*? v?3(?:\.0)?(?!\S)",
    "LGPL-3.0": r"lesser general public license(?: \S+)*? v?3(?:\.0)?(?!\S)",
    "MPL-2.0": r"mozilla public license (?:version |v )?(?:v\.?)?2\.0(?!\S)",
    "CC-BY-4.0": r"(?<!\S)(?:by|attribution) (?:version |v)?4\.0(?!\S)",
    "CC-BY-SA-4.0": r"(?:by-sa|attribution-sharealike) (?:version |v)?4\.0(?!\S)",
    "CC-BY-NC-4.0": r"by-nc (?:version |v)?4\.0(?!\S)",
    "CC-BY-ND-4.0": r"by-nd (?:version |v)?4\.0(?!\S)",
    "CC-BY-NC-SA-4.0": r"by-nc-sa (?:version |v)?4\.0(?!\S)",
}
#: What a block of interest holds, with anything but letters and digits between two words.
_CUE = re.compile(
    r"licen[cs]|copyright|rights[\W_]+reserved|permission|redistribut|creative[\W_]+commons|public[\W_]+domain|free[\W_]+software", re.I
)
#: A text without any of these has no cue; they are searched faster than the pattern.
_CUES = ("licen", "copyright", "rights", "permission", "redistribut", "creative", "public", "free")
_WORD = re.compile(r"[^\W_]+(?:[.+-][^\W_]+)*")
#: The share of a template's words that confirms a notice.
SIMILARITY = 0.8
LEVEL = 12


def words_of(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


class Scanner:
    """Templates as raw dictionaries, and as patterns of words."""

    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.templates = [(name, [w for w, _, _ in words_of(text)]) for name, text in templates]
        how = {"level": LEVEL, "write_content_size": False}
        self.plain = zstandard.ZstdCompressor(**how)
        self.under = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(
                    " ".join(words).encode("utf-8"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
                ),
                **how,
            )
            for _, words in self.templates
        ]
        self.reach = max((len(w) for _, w in self.templates), default=0) * 5 // 4 + 8
        self.numbers: dict[str, int] = {}
        for _, words in self.templates:
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)
        self.allowed = [max(k for k in range(len(w) + 1) if len(w) - k >= SIMILARITY * len(w)) for _, w in self.templates]
        naming = [re.compile(NAMES.get(name, "")) for name, _ in self.templates]
        self.naming = [p if p.search(" ".join(w)) else re.compile("") for p, (_, w) in zip(naming, self.templates, strict=True)]
        self.has = np.zeros((len(self.templates), len(self.numbers) + 1), bool)
        self.places: list[dict[int, int]] = []
        for t, (_, words) in enumerate(self.templates):
            places: dict[int, int] = {}
            for i, w in enumerate(words):
                places[self.numbers[w]] = places.get(self.numbers[w], 0) | 1 << i
            self.places.append(places)
            self.has[t, list(places)] = True

    def reduction(self, i: int, words: list[str]) -> int:
        """Bytes that a template saves of a run of words."""
        block = " ".join(words).encode("utf-8")
        return len(self.plain.compress(block)) - len(self.under[i].compress(block))

    def ranking(self, plain: list[str]) -> list[int]:
        """The templates by the bytes that each saves of a stretch of words, most first.

        A stretch is compressed in windows that overlap by ``reach`` words, so a notice is whole in one of them.
        """
        saved = [0] * len(self.templates)
        for at in range(0, max(len(plain) - self.reach, 1), self.reach):
            window = " ".join(plain[at : at + 2 * self.reach]).encode("utf-8")
            alone = len(self.plain.compress(window))
            saved = [max(s, alone - len(under.compress(window))) for s, under in zip(saved, self.under, strict=True)]
        return sorted(range(len(saved)), key=lambda i: (-saved[i], i))

    def find(self, text: str | None) -> list[tuple]:
        """``license, start, end, reduction, differences, words`` of the notices, in order and not overlapping."""
        if not text or not any(c in text.lower() for c in _CUES):
            return []
        return [n for block in self.blocks(text) for n in self.notices(block)]

    def blocks(self, text: str) -> Iterator[list[tuple[str, int, int]]]:
        """The words within ``reach`` words of a cue; blocks that meet are one."""
        cues = _CUE.finditer(text)
        cue = next(cues, None)
        before: deque = deque(maxlen=self.reach)
        block, since = [], 0  # words since the last cue
        for m in _WORD.finditer(text) if cue else ():
            word = m[0].lower(), m.start(), m.end()
            hit = False
            while cue and cue.start() < m.end():
                hit, cue = True, next(cues, None)
            if hit:
                block = block or list(before)
                since = 0
            elif block:
                since += 1
                if since > 2 * self.reach:
                    yield block[: len(block) - self.reach]
                    block = []
            if hit or block:
                block.append(word)
            before.append(word)
            if not block and not cue:
                return
        if block:
            yield block[: len(block) - max(0, since - self.reach)]

    def notices(self, block: list[tuple[str, int, int]]) -> list[tuple]:
        """The notices of a block: those whose template saves most first, then what lies between them."""
        plain = [w for w, _, _ in block]
        numbers = np.array([self.numbers.get(w, 0) for w in plain], np.int64)
        found, todo = [], [(0, len(plain))]
        while todo:
            low, high = todo.pop()
            own = self._best(plain, numbers, low, high)
            if own:
                edges = [low, *(x for i, s, e, _ in own for x in (s, e)), high]
                todo += [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if b > a]
            found += own
        return [
            (self.templates[i][0], block[s][1], block[e - 1][2], self.reduction(i, plain[s:e]), changes, e - s)
            for i, s, e, changes in sorted(found, key=lambda f: f[1])
        ]

    def _best(self, plain: list[str], numbers: np.ndarray, low: int, high: int) -> list[tuple[int, int, int, int]]:
        """``template, start, end, changes`` of notices that do not overlap, by words, in order.

        Every template is confirmed, down to the last of the ranking, and of runs that overlap the one that its
        template saves most of is taken; the ranking of the whole stretch decides between equal savings.
        """
        ends = []
        for rank, i in enumerate(self.ranking(plain[low:high])):
            n = len(self.templates[i][1])
            for cost, end in self._ends(i, numbers[low:high]):
                saved = self.reduction(i, plain[max(low, low + end - n) : low + end])
                ends.append((-saved, cost / n, rank, i, -(low + end), cost))
        starts: list[int] = []  # of the taken ones, in order
        taken: list[tuple[int, int, int, int]] = []
        for _, _, _, i, end, cost in sorted(ends):
            words, end = self.templates[i][1], -end
            # A run of so many words at least ends here.
            if self._taken(taken, starts, end - len(words) + cost, end):
                continue
            first = max(low, end - len(words) - cost)
            if not self.naming[i].search(" ".join(plain[first:end])):
                continue
            start = first + _last_row(words, plain[first:end])[-1][1]
            named = self.naming[i].search(" ".join(plain[start:end]))
            if named and start < end and not self._taken(taken, starts, start, end):
                at = bisect_left(starts, start)
                starts.insert(at, start)
                taken.insert(at, (i, start, end, cost))
        return taken

    @staticmethod
    def _taken(taken: list[tuple[int, int, int, int]], starts: list[int], start: int, end: int) -> bool:
        at = bisect_left(starts, end)
        return at > 0 and taken[at - 1][2] > start

    def _ends(self, i: int, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """``changes, end`` of all runs of words that have at most the allowed changes of a template.

        Such a run has the words of the template but for those changes, and no
        more others; only stretches with so many are compared, by bit vectors.
        """
        n, allowed, places = len(self.templates[i][1]), self.allowed[i], self.places[i]
        width = n + allowed
        sums = np.concatenate(([0], np.cumsum(self.has[i][numbers])))
        at = np.arange(1, len(numbers) + 1)
        full = np.flatnonzero(sums[at] - sums[np.maximum(at - width, 0)] >= n - allowed) if n else at[:0]
        cuts = np.flatnonzero(np.diff(full) > 1) + 1
        mask, top, done = (1 << n) - 1, 1 << max(n - 1, 0), 0
        for run in np.split(full, cuts) if len(full) else ():
            begin, until = max(int(run[0]) + 1 - width, 0), int(run[-1]) + 1
            more, less, score = mask, 0, n
            for end, word in enumerate(numbers[begin:until].tolist(), begin + 1):
                same = places.get(word, 0)
                x = same | less
                h = (((same & more) + more) ^ more) | same
                up, down = less | (~(h | more) & mask), more & h
                if up & top:
                    score += 1
                elif down & top:
                    score -= 1
                up, down = (up << 1) & mask, (down << 1) & mask
                more, less = down | (~(x | up) & mask), up & x
                if score <= allowed and end > done:
                    done = end
                    yield score, end


def differences(template: list[str], words: list[str]) -> tuple[int, int, int]:
    """Fewest words to change, add or leave out between the template and a run of the words; the run's ends."""
    row = _last_row(template, words)
    cost, high = min((c, -at) for at, (c, _) in enumerate(row))
    high = -high
    low = row[high][1]
    return (cost, low, high) if high > low else (len(template), 0, min(1, len(words)))


def _last_row(template: list[str], words: list[str]) -> list[tuple[int, int]]:
    """Fewest changes, and the beginning, of a run that ends after so many words."""
    row = [(0, at) for at in range(len(words) + 1)]
    for i, want in enumerate(template, 1):
        last, row = row, [(i, 0)]
        for at, have in enumerate(words, 1):
            change = last[at - 1][0] + (want != have), last[at - 1][1]
            row.append(min(change, (last[at][0] + 1, last[at][1]), (row[at - 1][0] + 1, row[at - 1][1])))
    return row


@lru_cache(4)
def scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(templates)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """One row per notice: ``id_col, license, start, end, reduction, differences, n_words int``.

    A block is what lies within the length of the longest template, and a quarter
    more, before and after a word that notices have, across lines; blocks that
    meet are one. It is compressed with each template as a dictionary, and down
    this ranking, to its last, templates are confirmed word by word: runs with at
    most a fifth of the words changed. Of runs that overlap, the one that its
    template saves most bytes of is the notice. The words that name the license are
    not among those that may be changed. ``reduction`` is what the template saves of
    the compressed words of the notice. ``start`` and ``end`` are code points of the
    whole text, end exclusive.

    Null and empty texts have no notice. Repeated ids and rows are scanned one
    by one; a null id is reported like any other. Other columns are not looked
    at.
    """
    ship(docs.sparkSession)
    fields = ["license", "start", "end", "reduction", "differences", "n_words"]
    kinds = [pa.string(), *[pa.int32()] * 5]
    kind = pa.list_(pa.struct(list(zip(fields, kinds, strict=True))))

    @F.arrow_udf(
        "array<struct<license:string,start:int,end:int,reduction:int,differences:int,n_words:int>>"
    )
    def of(texts: pa.Array) -> pa.Array:
        found = [scanner(templates).find(t.as_py()) for t in texts]
        return pa.array([[dict(zip(fields, f, strict=True)) for f in own] for own in found], kind)

    found = docs.select(F.col(id_col), F.explode_outer(of(F.col(text_col))).alias("found"))
    return found.where("found IS NOT NULL").select(id_col, "found.*")
