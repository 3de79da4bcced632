"""License scans: MinHash over text windows finds candidates, exact containment decides.

Texts and templates are lower-cased words and five-word shingles. A template of m different
shingles occurs where ``span(m)`` = m + ceil(m / 4) consecutive shingles of a text hold at
least ``CONTAINED`` of them.

Templates are grouped by w, the power of two that covers their span. A text is read in
windows of 1.5 w shingles, one every w / 2, so each occurrence lies whole in one of them.
The Jaccard similarity of such a window and the template is at least 0.8 m / (1.5 w + 0.2 m),
which is over 0.2 as w is under 2.5 m (one half more for the shortest). Of ``BANDS``
bands with one MinHash each, at least one agrees with probability 1 - 0.8^48, or 0.99998.
Windows with an agreeing band are then searched exactly, on the words themselves.

The templates are a fixed, small table, which every task holds: notices of one sentence or a
few, and whole bodies of the short licenses. Their minima are looked up in one sorted table
for each band and scale, so the cost of a text hardly grows with their number. Where wordings
share text (a notice and the body it opens, GPL and LGPL) each that is contained is reported.

Odd input: null and empty texts, and texts under five words, hold no license; any length
works; rows repeated with one doc_id give their rows each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from surgemark.llm.common import text_or_empty

SHINGLE = 5
CONTAINED = 0.8
BANDS = 48
WORD = re.compile(r"\w+")

# Wordings of license notices and bodies.
WARRANTY_MIT = """The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
GRANT_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
ENDORSE_BSD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
WARRANTY_BSD = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
GRANT_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:"""
PUBLISHED = "as published by the Free Software Foundation"
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                      "and associated documentation files, to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    # Bodies and notices, from the licenses themselves.
    "mit-body": f"{GRANT_MIT} {WARRANTY_MIT}",
    "mit-0-body": f"{GRANT_MIT.split(', subject')[0]}. {WARRANTY_MIT.split('Software. ', 1)[1]}",
    "bsd-2-clause-body": f"{GRANT_BSD} {WARRANTY_BSD}",
    "bsd-3-clause-body": f"{GRANT_BSD} {ENDORSE_BSD} {WARRANTY_BSD}",
    "bsd-3-clause-endorsement": ENDORSE_BSD[3:],
    "isc-body": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
                "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
                "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
                "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
                "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
                "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
    "zlib-body": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
                 "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
                 "use this software for any purpose, including commercial applications, and to alter it and redistribute it "
                 "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
                 "you must not claim that you wrote the original software. If you use this software in a product, an "
                 "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
                 "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
                 "3. This notice may not be removed or altered from any source distribution.",
    "bsl-1.0-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                     "software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, "
                     "display, distribute, execute, and transmit the Software, and to prepare derivative works of the "
                     "Software, and to permit third-parties to whom the Software is furnished to do so",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "unlicense-body": "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                      "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
                      "compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "wtfpl": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing "
             "it is allowed as long as the name is changed.",
    "apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License "
                           "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
                           "or implied. See the License for the specific language governing permissions and limitations under "
                           "the License.",
    "gpl-2.0-or-later": f"under the terms of the GNU General Public License {PUBLISHED}; either version 2 of the License, or "
                        "(at your option) any later version.",
    "gpl-2.0-only": f"under the terms of the GNU General Public License version 2 {PUBLISHED}.",
    "gpl-3.0-or-later": f"under the terms of the GNU General Public License {PUBLISHED}, either version 3 of the License, or "
                        "(at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                    "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
                    "License for more details.",
    "lgpl-2.1-or-later": f"under the terms of the GNU Lesser General Public License {PUBLISHED}; either version 2.1 of the "
                         "License, or (at your option) any later version.",
    "lgpl-3.0-or-later": f"under the terms of the GNU Lesser General Public License {PUBLISHED}, either version 3 of the "
                         "License, or (at your option) any later version.",
    "agpl-3.0-or-later": f"under the terms of the GNU Affero General Public License {PUBLISHED}, either version 3 of the "
                         "License, or (at your option) any later version.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                      "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
               "2.0 which is available at",
    "epl-1.0": "All rights reserved. This program and the accompanying materials are made available under the terms of the "
               "Eclipse Public License v1.0 which accompanies this distribution",
    "cddl-1.0": "The contents of this file are subject to the terms of the Common Development and Distribution License (the "
                "\"License\"). You may not use this file except in compliance with the License.",
    "artistic-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the Artistic "
                    "License 2.0.",
    "ofl-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
               "this work",
    "odbl-1.0": "is made available under the Open Database License: http://opendatacommons.org/licenses/odbl/1.0/.",
}

# The other Creative Commons sentences; those of BY and BY-SA are above.
for _code, _name in {"by-nc": "NonCommercial", "by-nd": "NoDerivatives", "by-nc-sa": "NonCommercial-ShareAlike",
                     "by-nc-nd": "NonCommercial-NoDerivatives"}.items():
    TEMPLATES[f"cc-{_code}-4.0-international"] = (
        f"This work is licensed under a Creative Commons Attribution-{_name} 4.0 International License.")
for _code in ("by", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd"):
    TEMPLATES[f"cc-{_code}-4.0-short"] = f"Licensed under CC {_code.upper()} 4.0."


def span(m: int) -> int:
    """Shingles of a text in which an occurrence of a template with m shingles must lie."""
    return m + -(-m // 4)


def shingles(words: list[str]) -> list[tuple[str, ...]]:
    return list(zip(*(words[i:] for i in range(SHINGLE))))


def word_hashes(words: list[str]) -> np.ndarray:
    """32-bit hashes of all shingles, from hashes of their words."""
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(h) - SHINGLE + 1
    out = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        out = (out ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return (out >> np.uint64(32)).astype(np.uint32)


def found_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of the values that are in ``table``, which is sorted and not empty."""
    if len(table) < 4:
        return np.flatnonzero(np.logical_or.reduce([values == t for t in table]))
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return np.flatnonzero(table[at] == values)


class Scanner:
    """Finds templates in texts; one for each task."""

    def __init__(self, templates: dict[str, str]):
        rng = np.random.default_rng(7)
        self.factor = rng.integers(0, 2**31, BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shift = rng.integers(0, 2**32, BANDS, dtype=np.uint32)
        self.sets: dict[str, set] = {}
        self.scales: dict[int, list[str]] = {}
        for name, text in templates.items():
            found = set(shingles(WORD.findall(text.lower())))
            self.sets[name] = found
            self.scales.setdefault(max(2, 1 << (span(len(found)) - 1).bit_length()), []).append(name)
        self.scale = {name: w for w, names in self.scales.items() for name in names}
        hashes = {name: word_hashes(WORD.findall(text.lower())) for name, text in templates.items()}
        # For each band and scale the templates' MinHash values, sorted, and who has them.
        self.minima: list[dict[int, tuple[np.ndarray, dict[int, list[str]]]]] = []
        for f, s in zip(self.factor, self.shift):
            tables = {}
            for w, names in self.scales.items():
                holders: dict[int, list[str]] = {}
                for n in names:
                    holders.setdefault(int((hashes[n] * f + s).min()), []).append(n)
                tables[w] = np.array(sorted(holders), np.uint32), holders
            self.minima.append(tables)
        self.block = max(self.scales) // 2

    def cell(self, n: int) -> int:
        """The size of blocks up to which a text of n shingles shares none with other texts.

        A text that can hold a template of scale w has at least 0.32 w shingles, so blocks of
        w / 2 are its own.
        """
        return min(self.block, 1 << max(0, n - 1).bit_length())

    def candidates(self, texts: list[np.ndarray]) -> list[dict[str, set[int]]]:
        """For each text and template the numbers of the windows (of its scale) that may hold it.

        The texts are laid in one row, those of the largest cells first, each in whole cells.
        """
        out: list[dict[str, set[int]]] = [{} for _ in texts]
        order = sorted(range(len(texts)), key=lambda i: -self.cell(len(texts[i])))
        starts, ends, at = [], [], 0
        for i in order:
            starts.append(at)
            at += -(-len(texts[i]) // self.cell(len(texts[i]))) * self.cell(len(texts[i]))
            ends.append(at)
        at = -(-at // self.block) * self.block
        row, blank = np.zeros(at, np.uint32), np.ones(at, bool)
        for start, i in zip(starts, order):
            row[start:start + len(texts[i])] = texts[i]
            blank[start:start + len(texts[i])] = False
        top = np.uint32(2**32 - 1)
        for factor, shift, tables in zip(self.factor, self.shift, self.minima):
            lowest, size = row * factor + shift, 1      # minima of blocks of ``size`` shingles
            lowest[blank] = top
            for w in sorted(self.scales):
                while size < w // 2:
                    lowest = np.minimum(lowest[::2], lowest[1::2])
                    size *= 2
                values, holders = tables[w]
                for block in found_in(lowest, values).tolist():
                    place = bisect_right(starts, block * size) - 1
                    text = order[place]
                    if self.cell(len(texts[text])) < size:
                        continue                        # too short for this scale
                    origin, end = starts[place] // size, ends[place] // size
                    for first in range(max(block - 2, origin), block + 1):
                        # It agrees if nothing lower is in the window.
                        if lowest[first:min(first + 3, end)].min() == lowest[block]:
                            for name in holders[int(lowest[block])]:
                                out[text].setdefault(name, set()).add(first - origin)
        return out

    def verify(self, words: list[str], name: str, w: int, windows: set[int]) -> tuple[int, float, int]:
        """Occurrences that do not overlap, the best containment, and the first one's word."""
        wanted = self.sets[name]
        size = span(len(wanted))
        spans: list[list[int]] = []
        for k in sorted(windows):
            lo, hi = k * (w // 2), k * (w // 2) + 3 * (w // 2)
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = hi
            else:
                spans.append([lo, hi])
        hits, best, where, free = 0, 0.0, -1, 0
        for lo, hi in spans:
            part = shingles(words[lo:hi + SHINGLE - 1])
            inside = [s if s in wanted else None for s in part]
            for i in range(len(part)):
                if inside[i] is None:
                    continue
                share = len(set(inside[i:i + size]) - {None}) / len(wanted)
                if share >= CONTAINED:
                    best = max(best, share)
                    if lo + i >= free:
                        hits += 1
                        where = lo + i if where < 0 else where
                        free = lo + i + len(wanted)
        return hits, best, where

    def scan(self, texts: list[str]) -> Iterator[list[tuple[str, int, float, int]]]:
        """For each text: name, occurrences, best containment, first word of each template."""
        for i in range(0, len(texts), 100):
            words = [WORD.findall(t.lower()) for t in texts[i:i + 100]]
            long = [w for w in words if len(w) >= SHINGLE]
            found = iter(self.candidates([word_hashes(w) for w in long]))
            for w in words:
                out = []
                for name, windows in (next(found) if len(w) >= SHINGLE else {}).items():
                    hits, best, where = self.verify(w, name, self.scale[name], windows)
                    if hits:
                        out.append((name, hits, best, where))
                yield sorted(out)


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, license, occurrences, containment, first_word for each license in a row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            found = scanner.scan(batch.column(1).to_pylist())
            rows = [(doc_id, *hit) for doc_id, hits in zip(batch.column(0).to_pylist(), found) for hit in hits]
            if rows:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64()]
                names = ["doc_id", "license", "occurrences", "containment", "first_word"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, license string, occurrences long, containment double, first_word long")
