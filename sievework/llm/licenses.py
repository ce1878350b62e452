"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Texts and templates are lower-cased and cut into words of letters and digits, and words into shingles
of SHINGLE words (all of a shorter template's words). A match has CONTAINMENT of the template's distinct
shingles or more, however far apart they lie.

Retrieval. A template of n distinct shingles meets windows of w shingles of the text, w being the least power of two
that isn't under n (two at least), each overlapping the next by half. Each of BANDS bands is the least value of one
permutation; a window retrieves a template for its texts if they agree in a band. What the guarantee rests on: a band's least
shingle of the template is in a matching text with probability CONTAINMENT or more; nothing of the template goes below
it, so of the window that holds it only foreign shingles can, and there are at most w - 1 < 2 n. A band thus agrees with
probability of CONTAINMENT * n / (n + w - 1) > 0.26, wherever and however far apart the copy's pieces lie, and all bands fail
with probability below 4e-7 (``miss_bound``). A text that shares no shingle with a template meets it only if 32-bit values clash.

Verification. Retrieved pairs of text and template are compared shingle by shingle, as words. A place is the shortest
run of template shingles that holds enough of them, and the missing ones that follow
or precede it. Runs without a gap over the template's length come first; then what is left over is joined
across any gap, so words inserted into a copy don't hide it.

Templates are the short texts and notices of TEMPLATES and the whole texts in ``license_texts``; ``build`` makes them of any
texts by name. They are broadcast: a few megabytes, whatever the corpus.

Defined cases: null and empty texts match nothing; a template found several times counts once a place;
repeated rows get equal results; texts that share most of their words (the notices of one family) can each be
found in one place; windows run on over the texts of a slice, and one that touches several texts retrieves for each;
other columns pass through, but for one with the name of the new column, which is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from importlib.resources import files
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm import textbatch as tb

SHINGLE, CONTAINMENT, BANDS = 5, 0.8, 48
RESULT = "struct<n_matches: bigint, licenses: string, best: double, spans: string>"
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

# Short public license texts and notices by identifier.
_AS_IS = (
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)
_BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. " + _AS_IS
    ),
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may "
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
        "or implied."
    ),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE."
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE."
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. " + _BSD_AS_IS
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _BSD_AS_IS
    ),
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."
    ),
    "Zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions"
    ),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the "
        "public domain worldwide. This software is distributed without any warranty."
    ),
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
}


def shingles(words: list[bytes], size: int) -> list[bytes]:
    return [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)]


def permuted(hashes: np.ndarray, band: int) -> np.ndarray:
    """The values of one permutation of 64-bit hashes, as 32 bits: an odd multiplier and an addend of the band's own."""
    low, high = np.array([2 * band + 1, 2 * band + 2], np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        factor, addend = tb.mixed(low * tb.PRIME)
        return ((hashes * (factor | high) + addend) >> np.uint64(32)).astype(np.uint32)


def window_of(n: int) -> int:
    """Shingles of the windows that a template of ``n`` distinct shingles meets."""
    return max(2, 1 << (n - 1).bit_length())


def miss_bound(n: int) -> float:
    """At most this part of the matches of a template of ``n`` distinct shingles agrees in no band."""
    return (1 - CONTAINMENT * n / (n + window_of(n) - 1)) ** BANDS


@dataclass(frozen=True)
class Template:
    name: str
    size: int  # words of a shingle
    n: int  # shingles
    words: frozenset
    often: Counter  # how often the template has each shingle
    hashes: np.ndarray  # distinct, in order
    bands: np.ndarray  # the least value of each band

    @property
    def window(self) -> int:
        return window_of(len(self.hashes))

    @property
    def least(self) -> int:
        """The fewest distinct shingles of a match."""
        return next(k for k in range(1, len(self.words) + 1) if k / len(self.words) >= CONTAINMENT)


def build(templates: dict[str, str]) -> list[Template]:
    out = []
    for name, text in templates.items():
        data = text.lower().encode()
        words = _WORD.findall(data)
        if not words:
            continue
        size = min(SHINGLE, len(words))
        view = np.frombuffer(data, np.uint8)
        _, hashes = tb.Words(view, np.array([0, len(view)]), tb.ALNUM).windows(*range(size))
        own = shingles(words, size)
        hashes = np.unique(hashes)
        bands = np.array([permuted(hashes, band).min() for band in range(BANDS)], np.uint32)
        out.append(Template(name, size, len(own), frozenset(own), Counter(own), hashes, bands))
    return out


def whole_texts() -> dict[str, str]:
    """The whole licence texts that come with the package, by identifier."""
    folder = files("sievework.llm") / "license_texts"
    return {f"{x.name.removesuffix('.txt')}-text": x.read_text("utf-8") for x in sorted(folder.iterdir(), key=lambda x: x.name) if x.name.endswith(".txt")}


@lru_cache(maxsize=1)
def default_templates() -> list[Template]:
    return build(TEMPLATES | whole_texts())


def retrieve(hashes: np.ndarray, texts: np.ndarray, n_texts: int, templates: list[Template]) -> np.ndarray:
    """(text, template) booleans: which templates agree in a band with a window that touches the text.

    ``hashes`` are a slice's shingles and ``texts`` their texts, in order. A band's least values of blocks of 1, 2, 4, ...
    shingles are made from those of half the length; two neighbours are a window.
    """
    out = np.zeros((n_texts, len(templates)), dtype=bool)
    n = len(hashes)
    if not n:
        return out
    by_window: dict[int, list[int]] = {}
    for i, t in enumerate(templates):
        by_window.setdefault(t.window, []).append(i)
    for band in range(BANDS):
        block, size = permuted(hashes, band), 1
        while size <= max(by_window) // 2:
            ids = by_window.get(2 * size, ())
            window = np.minimum(block[:-1], block[1:]) if ids and len(block) > 1 else block
            for i in ids:
                for k in np.flatnonzero(window == templates[i].bands[band]).tolist():
                    first, last = texts[k * size], texts[min((k + 2) * size, n) - 1]
                    out[first : last + 1, i] = True
            if len(block) % 2:
                block = np.append(block, block[-1])
            block, size = np.minimum(block[::2], block[1::2]), 2 * size
    return out


def _taken(ids: list, s: int, e: int, low: int, high: int, often: Counter) -> tuple[int, int]:
    """The run [s, e) with the shingles after and before it that it still lacks."""
    have = Counter(ids[s:e])
    while e < high and have[ids[e]] < often[ids[e]]:
        have[ids[e]] += 1
        e += 1
    while s > low and have[ids[s - 1]] < often[ids[s - 1]]:
        s -= 1
        have[ids[s]] += 1
    return s, e


def _runs(ids: list, low: int, high: int, t: Template) -> Iterator[tuple[int, int]]:
    """Runs within [low, high) that hold enough distinct shingles, from left to right."""
    have: Counter = Counter()
    s = e = low
    while e < high:
        have[ids[e]] += 1
        e += 1
        if len(have) < t.least:
            continue
        while have[ids[s]] > 1:
            have[ids[s]] -= 1
            s += 1
        s, e = _taken(ids, s, e, low, high, t.often)
        yield s, e
        low = s = e
        have = Counter()


def places(at: list[int], ids: list, t: Template) -> list[tuple[int, int]]:
    """[first, end) of the runs of a text's template shingles ``ids`` at ``at`` that are matches."""
    cuts = [0, *(k for k in range(1, len(at)) if at[k] - at[k - 1] > t.n), len(at)]
    dense = [run for low, high in zip(cuts, cuts[1:]) for run in _runs(ids, low, high, t)]
    out, low = [], 0
    for k, (s, e) in enumerate(dense):
        s, e = _taken(ids, s, e, low, dense[k + 1][0] if k + 1 < len(dense) else len(at), t.often)
        out += [*_runs(ids, low, s, t), (s, e)]
        low = e
    return out + [*_runs(ids, low, len(at), t)]


def scan_slice(data: np.ndarray, offsets: np.ndarray, templates: list[Template]) -> list[list[tuple[str, float, int, int]]]:
    """(template, containment, first byte, end byte) of each match of each text of a lower-cased slice."""
    found: list[list[tuple[str, float, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    words = tb.Words(data, offsets, tb.ALNUM)
    for size in sorted({t.size for t in templates}):
        first_word, hashes = words.windows(*range(size))
        texts = words.texts[first_word]
        group = [t for t in templates if t.size == size]
        for text, k in zip(*(x.tolist() for x in np.nonzero(retrieve(hashes, texts, len(found), group))), strict=True):
            t = group[k]
            a, b = np.searchsorted(texts, [text, text + 1])
            hits = a + np.flatnonzero(np.isin(hashes[a:b], t.hashes))
            if len(hits) < t.least:
                continue
            at, ids = [], []
            for i in first_word[hits].tolist():
                s = b" ".join(data[words.starts[i + j] : words.ends[i + j]].tobytes() for j in range(size))
                if s in t.words:
                    at.append(i)
                    ids.append(s)
            for s, e in places(at, ids, t):
                start, stop = words.starts[at[s]] - offsets[text], words.ends[at[e - 1] + size - 1] - offsets[text]
                found[text].append((t.name, len(set(ids[s:e])) / len(t.words), int(start), int(stop)))
    return [sorted(x, key=lambda m: (m[2], m[0])) for x in found]


def scan(docs: DataFrame, templates: list[Template] | None = None, text: str = "text", into: str = "licenses") -> DataFrame:
    """``docs`` with a struct of matches in the new column ``into``: their number, the distinct templates in
    order, the highest containment, and template:first:end of each (bytes of the lower-cased text)."""
    held = docs.sparkSession.sparkContext.broadcast(templates or default_templates())

    @F.arrow_udf(RESULT)
    def licenses(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            data, offsets = tb.utf8(pc.utf8_lower(column.cast(pa.large_string())))
            rows = []
            for _, part, marks in tb.slices(data, offsets):
                rows += scan_slice(part, marks, held.value)
            yield pa.StructArray.from_arrays(
                [
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([",".join(sorted({x[0] for x in r})) for r in rows], pa.string()),
                    pa.array([max((x[1] for x in r), default=0.0) for r in rows], pa.float64()),
                    pa.array([",".join(f"{x[0]}:{x[2]}:{x[3]}" for x in r) for r in rows], pa.string()),
                ],
                ["n_matches", "licenses", "best", "spans"],
            )

    return docs.withColumn(into, licenses(F.col(text).cast("string")))
