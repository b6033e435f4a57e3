"""License texts in documents: MinHash bands over windows, then exact containment.

Templates of about one length are looked for with windows a little longer than they are,
a quarter of a template apart, so that some window holds the whole of an occurrence. One
MinHash value is a band: a window with the Jaccard similarity J to a template shares one
of ``BANDS`` with probability 1 - (1 - J) ** BANDS. Even at the least containment and the
worst place J is 0.3 or more, so the chance to miss is below 0.35 percent, and an unchanged
text (J of 0.4 or more) is missed once in 3,500 times at most.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from tidemark.llm.frames import map_texts, slices

WORDS = 5  # of a shingle
BANDS = 16
LEAST = 0.8  # of a template's shingles
#: Shingles of all templates, at most: they go along with every task.
MOST_SHINGLES = 1_000_000
SLICE = 1_000_000  # characters at a time

# Notices by which works are licensed.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0 work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0 work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BLANKS = bytes(32 if chr(b) in _MARKS else b for b in range(256))
_WORD = re.compile(rf"[^\s{re.escape(_MARKS)}]+", re.A)
_NONE = np.iinfo(np.uint64).max
_RANDOM = np.random.default_rng(31)
_PLACES = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES = _RANDOM.integers(1, 1 << 63, (BANDS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(1, 1 << 63, (BANDS, 1), dtype=np.uint64)


def words_of(text: str) -> list[bytes]:
    """Lower-cased words; ASCII marks and white space stand between them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_BLANKS).split()


def shingles(words: list[bytes], sizes: list[int]) -> np.ndarray:
    """A hash for each word and the four after it; ``_NONE`` where a text of ``sizes`` ends."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    made = np.full(len(words), _NONE, np.uint64)
    n = len(words) - WORDS + 1
    if n > 0:
        total = np.zeros(n, np.uint64)
        for place in range(WORDS):
            total += hashes[place : place + n] * _PLACES[place]
        total = (total ^ (total >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        made[:n] = np.minimum(total ^ (total >> np.uint64(27)), _NONE - np.uint64(1))
        ends = np.cumsum(sizes)
        for back in range(1, WORDS):
            made[np.maximum(ends - back, 0)[np.array(sizes) >= back]] = _NONE
    return made


class Template(NamedTuple):
    name: str
    shingles: frozenset[int]
    length: int  # shingles, repeated ones too


class Index:
    """Bands of the templates by the size of their windows."""

    def __init__(self, templates: Mapping[str, str]):
        self.templates: list[Template] = []
        self.bands: dict[int, dict[tuple[int, int], list[int]]] = {}
        for name, text in templates.items():
            words = words_of(text)
            if len(words) < WORDS:
                raise ValueError(f"{name}: a template needs {WORDS} words")
            own = shingles(words, [len(words)])[: len(words) - WORDS + 1]
            size = 1 << (len(own) - 1).bit_length()
            number = len(self.templates)
            self.templates.append(Template(name, frozenset(own.tolist()), len(own)))
            for band, value in enumerate((own * _TIMES + _PLUS).min(1).tolist()):
                self.bands.setdefault(size, {}).setdefault((band, value), []).append(number)
        if sum(t.length for t in self.templates) > MOST_SHINGLES:
            raise ValueError(f"templates of more than {MOST_SHINGLES} shingles: scan for parts of them in turn")
        self.filters = {}
        for size, bands in self.bands.items():
            known = np.zeros(1 << 16, bool)
            known[[value & 0xFFFF for _, value in bands]] = True
            self.filters[size] = known

    def candidates(self, made: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Template to the windows (first and last word) that share a band with it."""
        found: dict[int, list[tuple[int, int]]] = {}
        if not self.bands or not len(made):
            return found
        largest = max(self.bands)
        width = -(-len(made) // largest) * largest + 2 * largest
        values = np.full((BANDS, width), _NONE, np.uint64)
        values[:, : len(made)] = np.where(made == _NONE, _NONE, made * _TIMES + _PLUS)
        step = 1  # shingles of one column of ``values``
        for size in sorted(self.bands):
            while step < max(1, size // 4):
                values = np.minimum(values[:, ::2], values[:, 1::2])
                step *= 2
            columns = size // step + (size > 1)
            windows = values[:, : values.shape[1] - columns + 1].copy()
            for n in range(1, columns):
                np.minimum(windows, values[:, n : values.shape[1] - columns + 1 + n], out=windows)
            bands = self.bands[size]
            likely = self.filters[size][(windows & np.uint64(0xFFFF)).astype(np.intp)]
            for band, at in zip(*(x.tolist() for x in np.nonzero(likely)), strict=True):
                for number in bands.get((band, int(windows[band, at])), ()):
                    found.setdefault(number, []).append((at * step, (at + columns) * step))
        return found

    def matches(self, made: np.ndarray, begins: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(text, template, first word, end, containment), the best of overlapping places each."""
        result = []
        for number, windows in self.candidates(made).items():
            template = self.templates[number]
            reach = math.ceil(template.length / LEAST)  # shingles an occurrence may stretch over
            regions: list[list[int]] = []
            for begin, end in sorted(set(windows)):
                begin, end = max(0, begin - reach), min(len(made), end + reach)
                if regions and begin <= regions[-1][1]:
                    regions[-1][1] = max(end, regions[-1][1])
                else:
                    regions.append([begin, end])
            for begin, end in regions:
                part = made[begin:end].tolist()
                hits = [begin + i for i, x in enumerate(part) if x in template.shingles]
                result += self._placed(number, template, reach, hits, made, begins)
        return result

    def _placed(self, number, template, reach, hits, made, begins) -> list[tuple[int, int, int, int, float]]:
        least = math.ceil(LEAST * len(template.shingles) - 1e-9)
        places = []
        counts: dict[int, int] = {}
        left = 0
        texts = (np.searchsorted(begins, hits, "right") - 1).tolist()
        values = made[hits].tolist() if hits else []
        for right, (hit, text) in enumerate(zip(hits, texts, strict=True)):
            counts[values[right]] = counts.get(values[right], 0) + 1
            while hits[left] <= hit - reach or texts[left] != text:
                counts[values[left]] -= 1
                if not counts[values[left]]:
                    del counts[values[left]]
                left += 1
            if len(counts) >= least:
                places.append((len(counts), hits[left] - hit, hits[left], hit, text))
        found: list[tuple[int, int, int, int, float]] = []
        taken: list[tuple[int, int]] = []
        for size, _, begin, last, text in sorted(places, key=lambda p: (-p[0], -p[1], p[2])):
            if all(last < b or begin > e for b, e in taken):
                taken.append((begin, last))
                first = int(begins[text])
                found.append((text, number, begin - first, last - first + WORDS, size / len(template.shingles)))
        return found


def scan(texts: list[str], index: Index) -> list[list[tuple[str, int, int, int, int, float]]]:
    """For each text (template, start, end in code points, first word, end word, containment)."""
    found: list[list] = [[] for _ in texts]
    for begin, end in slices(texts, SLICE):
        words = [words_of(t) for t in texts[begin:end]]
        sizes = [len(w) for w in words]
        made = shingles([w for own in words for w in own], sizes)
        begins = np.cumsum([0, *sizes[:-1]])
        # texts without words share their place with the next one, which the search finds
        for text, number, first, last, share in index.matches(made, begins):
            found[begin + text].append((index.templates[number].name, first, last, share))
    result = []
    for text, own in zip(texts, found, strict=True):
        spots = [m.span() for m in _WORD.finditer(text)] if own else []
        rows = [(name, spots[first][0], spots[last - 1][1], first, last, share) for name, first, last, share in own]
        result.append(sorted(rows, key=lambda r: (r[1], r[2], r[0])))
    return result


def find_licenses(
    df: DataFrame, templates: Mapping[str, str] = TEMPLATES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row for each place of a template: ``key``, ``template``, ``start``, ``end`` (code points),
    ``first_word``, ``end_word``, ``containment``.

    Places of one template do not overlap; the fullest, then the shortest, then the first of
    overlapping ones is taken. Null, empty or short texts have none, repeated rows have theirs
    each; other columns are not read.
    """
    names = ("template", "start", "end", "first_word", "end_word", "containment")

    def make():
        index = Index(templates)

        def work(keys: list, texts: list[str]) -> dict[str, list]:
            rows = [(k, *row) for k, own in zip(keys, scan(texts, index), strict=True) for row in own]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            return {name: list(c) for name, c in zip((key, *names), columns, strict=True)}

        return work

    kinds = "template string, start int, end int, first_word int, end_word int, containment double"
    return map_texts(df, key, text, kinds, make)
