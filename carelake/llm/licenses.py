"""License scans: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies.

A template of s shingles is looked for in windows of twice the least power of two that holds s, every half
window, so an occurrence always lies inside one. Such a window has a Jaccard similarity of at least 0.19 with a
template of which it holds 80 %. There are `BANDS` bands of one row; the chance that none of them agrees is
0.81 ** 48, less than 1 in 20,000. Retrieved templates are checked exactly: the share of the template's
shingles that the window holds must be `CONTAINED` or more.

Shingles are of five words; templates with less than five words, of three. Overlapping finds of a template are
one; copies that follow each other, told by the order of the template's shingles, are looked at one by one. Where
templates share most of the words they match, the one that accounts for the most shingles, less those that it
lacks, stays, so that no close sibling and no notice inside a longer text is reported in its place. The templates are common
notices and headers (`TEMPLATES`) and whole license texts (`TEXTS`). Defined results: NULL, empty and wordless texts have no finds; equal texts have equal finds. Positions
are code points, ends exclusive.
"""

from __future__ import annotations

import pkgutil
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import common

BANDS, CONTAINED, WORDS, SHORT_WORDS = 48, 0.8, 5, 3


def _gnu(name: str, work: str, version: str, free: str = "free software:") -> str:
    """The header of the GNU licenses."""
    return (
        f"This {work} is {free} you can redistribute it and/or modify it under the terms of the {name} as published by the"
        f" Free Software Foundation, {version}. This {work} is distributed in the hope that it will be useful, but WITHOUT"
        " ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
        f" {name} for more details."
    )


_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,"
    " this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the"
    " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or"
    " other materials provided with the distribution."
)
_BSD_3 = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission."
)

# Notices by which works state their license, by identifier.
TEMPLATES = {
    "agpl-3.0-header": _gnu("GNU Affero General Public License", "program", "either version 3 of the License, or (at your option) any later version"),
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
        " Unless required by applicable law or agreed to in writing, software distributed under the License is"
        ' distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
        " See the License for the specific language governing permissions and limitations under the License."
    ),
    "bsd-2-clause": _BSD_2,
    "bsd-3-clause": _BSD_2 + _BSD_3,
    "bsd-disclaimer": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,'
        " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
        " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
        " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
        " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
        " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE"
        " USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to"
        " this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "gpl-2.0-header": _gnu("GNU General Public License", "program", "either version 2 of the License, or (at your option) any later version", "free software;"),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": _gnu("GNU General Public License", "program", "either version 3 of the License, or (at your option) any later version"),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "lgpl-2.1-header": _gnu("GNU Lesser General Public License", "library", "either version 2.1 of the License, or (at your option) any later version", "free software;"),
    "lgpl-3.0-header": _gnu("GNU Lesser General Public License", "program", "either version 3 of the License, or (at your option) any later version"),
    "mit": "Released under the MIT License.",
    "mit-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
        " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
        " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without'
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

#: The whole texts beside this file, reported as NAME-text.
TEXTS = ("apache-2.0", "cc0-1.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "mpl-2.0")

_rng = np.random.Generator(np.random.PCG64(6))
_FACTORS = _rng.integers(0, 2**64, BANDS, np.uint64) | np.uint64(1)
_TERMS = _rng.integers(0, 2**64, BANDS, np.uint64)


def _values(hashes: np.ndarray, band: int) -> np.ndarray:
    return ((hashes * _FACTORS[band] + _TERMS[band]) >> np.uint64(32)).astype(np.uint32)


@dataclass(frozen=True)
class Template:
    name: str
    half: int
    shingles: np.ndarray
    least: np.ndarray
    order: np.ndarray

    def copies(self, places: np.ndarray, own: np.ndarray) -> list[tuple[np.ndarray, float]]:
        """The copies of the template among its shingles at these places, with their shares."""
        order = self.order[np.searchsorted(self.shingles, own)]
        told = np.flatnonzero(order >= 0)
        back = told[1:][np.diff(order[told]) < -max(1, len(self.shingles) // 2)]
        found = []
        for part in np.split(np.arange(len(own)), back):
            share = len(np.unique(own[part])) / len(self.shingles)
            if share >= CONTAINED:
                found.append((places[part], share))
        share = len(np.unique(own)) / len(self.shingles)
        return found or ([(places, share)] if share >= CONTAINED else [])


@cache
def templates() -> dict[int, list[Template]]:
    """The templates by their number of words to a shingle."""
    out: dict[int, list[Template]] = {}
    texts = {f"{name}-text": pkgutil.get_data("carelake.llm", f"license_texts/{name}.txt").decode() for name in TEXTS}
    for name, text in (TEMPLATES | texts).items():
        hashes, firsts = common.word_hashes(pa.array([text]))
        k = WORDS if len(hashes) >= WORDS else SHORT_WORDS
        own, first, times = np.unique(common.shingles(hashes, firsts, k)[0], return_index=True, return_counts=True)
        half = 1 << (len(own) - 1).bit_length()
        least = np.array([_values(own, b).min() for b in range(BANDS)])
        out.setdefault(k, []).append(Template(name, half, own, least, np.where(times == 1, first, -1)))
    return out


def _levels(at: np.ndarray, halves: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each half window: where its blocks begin among those of the level before, the next block of the same
    document or the block itself, and the blocks' first shingle and the document's end."""
    out, before = {}, (1, at)
    for half in halves:
        size, offsets = before
        counts = -(-np.diff(at) // half)
        own = np.concatenate(([0], np.cumsum(counts)))
        doc = np.repeat(np.arange(len(counts)), counts)
        j = np.arange(len(doc)) - own[:-1][doc]
        place = np.arange(len(doc))
        following = np.where(place + 1 < own[1:][doc], place + 1, place)
        out[half] = offsets[:-1][doc] + j * (half // size), following, at[:-1][doc] + j * half, at[1:][doc]
        before = half, own
    return out


def retrieved(hashes: np.ndarray, at: np.ndarray, wanted: list[Template]) -> list[tuple[Template, int, int]]:
    """Templates and the shingles [low, high) of the windows that agree with them in a band."""
    if not len(hashes):
        return []
    halves = sorted({t.half for t in wanted})
    levels = _levels(at, halves)
    hits = {t.name: np.zeros(len(levels[t.half][0]), bool) for t in wanted}
    for band in range(BANDS):
        now = _values(hashes, band)
        for half in halves:
            begins, following, _, _ = levels[half]
            now = np.minimum.reduceat(now, begins)
            window = np.minimum(now, now[following])
            for t in wanted:
                if t.half == half:
                    hits[t.name] |= window == t.least[band]
    out = []
    for t in wanted:
        _, _, low, end = levels[t.half]
        for i in np.flatnonzero(hits[t.name]):
            out.append((t, int(low[i]), int(min(low[i] + 2 * t.half, end[i]))))
    return out


def _best(spans: list) -> list:
    """Without the finds of which others, that account for more shingles less those lacking, match half the words."""
    low = min(int(f[4][0]) for f in spans)
    taken, kept = np.zeros(max(int(f[4][-1]) + f[1] for f in spans) - low, bool), []
    for span in sorted(spans, key=lambda f: (-f[2] * (2 * f[3] - 1), f[0], f[4][0])):
        own = np.unique(span[4][:, None] + np.arange(span[1])) - low
        if 2 * taken[own].sum() < len(own):
            taken[own] = True
            kept.append(span)
    return kept


def finds(column: pa.Array) -> list[list[tuple[str, float, int, int]]]:
    """For each text the licenses found: name, share of the template, start and end, by start and name."""
    data, starts, ends, firsts = common.word_spans(column)
    hashes = common.span_hashes(common.prefix_hashes(data), starts, ends)
    out: list[list[tuple[str, float, int, int]]] = [[] for _ in range(len(column))]
    texts = common.utf8(common.pc.utf8_lower(column))[1]
    # for each document: the template's name, its shingles, the share and the first words of the shingles matched
    found: dict[int, list[tuple[str, int, int, float, np.ndarray]]] = {}
    for k, wanted in templates().items():
        shingles, at = common.shingles(hashes, firsts, k)
        best: dict[tuple[int, str], list[tuple[str, int, int, float, np.ndarray]]] = {}
        for t, low, high in retrieved(shingles, at, wanted):
            inside = np.flatnonzero(np.isin(shingles[low:high], t.shingles))
            if len(inside) < CONTAINED * len(t.shingles):
                continue
            doc = int(np.searchsorted(at, low, "right")) - 1
            for places, share in t.copies(firsts[doc] + low + inside - at[doc], shingles[low + inside]):
                spans = best.setdefault((doc, t.name), [])
                i = len(spans)  # those of the window before may come again
                while i and spans[i - 1][4][0] > places[-1]:
                    i -= 1
                j = i
                while i and spans[i - 1][4][-1] >= places[0]:
                    i -= 1
                    places, share = np.union1d(spans[i][4], places), max(share, spans[i][3])
                spans[i:j] = [(t.name, k, len(t.shingles), share, places)]
        for (doc, _), spans in best.items():
            found.setdefault(doc, []).extend(spans)
    for doc, spans in found.items():
        raw = data[texts[doc] : texts[doc + 1]]
        for name, k, _, share, places in _best(spans):
            a, b = starts[places[0]], ends[min(int(places[-1]) + k, int(firsts[doc + 1])) - 1]
            low, high = (int(((raw[: x - texts[doc]] & 0xC0) != 0x80).sum()) for x in (a, b))
            out[doc].append((name, share, low, high))
    return [sorted(own, key=lambda f: (f[2], f[0])) for own in out]


def scanned(docs: DataFrame) -> DataFrame:
    """The documents with `licenses`: an array of license, share, start and end."""
    kind = pa.list_(pa.struct([("license", pa.string()), ("share", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf("array<struct<license: string, share: double, start: long, end: long>>")
    def of(text: pa.Array) -> pa.Array:
        out = []
        for part in common.slices([pa.RecordBatch.from_arrays([text], ["text"])]):
            out += [[dict(zip(("license", "share", "start", "end"), f, strict=True)) for f in own] for own in finds(part.column(0))]
        return pa.array(out, kind)

    return docs.withColumn("licenses", of(F.col("text").cast("string")))
