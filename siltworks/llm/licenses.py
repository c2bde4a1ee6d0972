"""License scans: Dice coefficient over word bigrams between parts of a text and licence templates.

Parts are the lines, the paragraphs (between blank lines) and the whole text.  Normalised words are runs of ASCII
letters and digits and of bytes from 0x80, in lower case.  A template can only reach the threshold in a part whose
number of bigrams lies within a factor (2 - t) / t of its own, and only if the two share at least t / (2 - t) of the
template's bigrams; parts that no template passes on both counts are dropped before any set is built.

Where no part reaches the threshold, windows of consecutive words are compared, over the edges of lines and paragraphs:
those that begin at a bigram of a template and have enough of its bigrams within the largest size that can reach the
threshold.  From each such place the size with the largest coefficient counts; of overlapping windows the best one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import released
from .textops import buffers, grams, spans, word_hashes

CHUNK_BYTES = 1 << 21

_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_3 = (
    _BSD_2 + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_NO_WARRANTY = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_0BSD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
_ISC = _0BSD[:-1] + ", provided that the above copyright notice and this permission notice appear in all copies."


def _gnu(kind: str, version: str, program: str = "This program") -> tuple[str, str]:
    return (
        f"This work is licensed under the GNU {kind} General Public License, version {version}.",
        f"{program} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} General Public License as published by "
        f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
    )


#: Notices and short licence texts, by SPDX name (public texts, without names and years).
TEMPLATES: dict[str, tuple[str, ...]] = {
    "0BSD": (_0BSD, _0BSD + _NO_WARRANTY),
    "AGPL-3.0": _gnu("Affero", "3"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        _BSD_2 + " " + _BSD,
        "Licensed under the BSD 2-Clause License.",
    ),
    "BSD-3-Clause": (_BSD_3, _BSD_3 + " " + _BSD, "Licensed under the BSD 3-Clause License."),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": (
        "This work is dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain "
        "worldwide. This software is distributed without any warranty.",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", _gnu("", "2")[1]),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
        _ISC + _NO_WARRANTY,
        "Licensed under the ISC License.",
    ),
    "LGPL-2.1": _gnu("Lesser", "2.1", "This library"),
    "LGPL-3.0": (*_gnu("Lesser", "3"), _gnu("Lesser", "3", "This library")[1]),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        _MIT,
        "Licensed under the MIT License.",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not "
        "required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may "
        "not be removed or altered from any source distribution.",
    ),
}

_FOLD = np.full(256, 32, np.uint8)
_FOLD[10] = 10
_FOLD[48:58] = np.arange(48, 58)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def bigrams(text: str) -> set[tuple[bytes, bytes]]:
    words = _FOLD[np.frombuffer(text.encode(), np.uint8)].tobytes().split()
    return set(zip(words, words[1:], strict=False))


def dice(a: set, b: set) -> float:
    """2 |a and b| / (|a| + |b|); 0 if both are empty."""
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


class Matcher:
    def __init__(self, templates: dict[str, tuple[str, ...]], threshold: float):
        self.threshold = threshold
        self.known = sorted((name, bigrams(t)) for name, texts in templates.items() for t in texts)
        self.known = [(n, b) for n, b in self.known if b]
        sizes = [len(b) for _, b in self.known]
        self.fewest = threshold * min(sizes, default=1) / (2 - threshold)
        self.most = max(sizes, default=0) * (2 - threshold) / threshold
        hashed = [(name, np.unique(_hashes(t))) for name, texts in sorted(templates.items()) for t in texts]
        self.hashed = [(name, h) for name, h in hashed if len(h)]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for _, h in self.hashed)]))
        self.has = [np.isin(self.vocabulary, h) for _, h in self.hashed]

    def best(self, words: list[bytes]) -> tuple[float, str] | None:
        """The largest coefficient of a template with these words and the first name that has it, if it counts."""
        own = set(zip(words, words[1:], strict=False))
        found = [(dice(own, b), n) for n, b in self.known if self.threshold / (2 - self.threshold) * len(b) <= len(own) <= len(b) * (2 - self.threshold) / self.threshold]
        found = [x for x in found if x[0] >= self.threshold]
        return min(found, key=lambda x: (-x[0], x[1])) if found else None


    def windows(self, pair: np.ndarray, hits: np.ndarray, blocked: np.ndarray) -> list[tuple[float, str, int]]:
        """(coefficient, name, place of the first bigram) of windows without blocked places.  hits are the places in
        pair of the vocabulary's bigrams that are not blocked."""
        word = np.searchsorted(self.vocabulary, pair[hits])
        walls = np.append(np.flatnonzero(blocked), len(pair))
        stop = walls[np.searchsorted(walls, hits)]
        found = []
        for (name, h), has in zip(self.hashed, self.has, strict=True):
            at = np.flatnonzero(has[word])
            own, n = hits[at], len(h)
            ends = np.minimum(own + int(n * (2 - self.threshold) / self.threshold + 1e-9), stop[at])
            enough = np.searchsorted(own, ends) - np.arange(len(own)) >= self.threshold * n / (2 - self.threshold) - 1e-9
            for k in np.flatnonzero(enough):
                lo, hi = own[k], ends[k]
                first = np.zeros(hi - lo, np.int64)
                first[np.unique(pair[lo:hi], return_index=True)[1]] = 1
                shared = np.zeros(hi - lo, np.int64)
                shared[own[k : np.searchsorted(own, hi)] - lo] = 1
                score = 2 * np.cumsum(first * shared) / (np.cumsum(first) + n)
                end = int(score.argmax())
                if score[end] >= self.threshold:
                    found.append((-float(score[end]), name, int(lo), int(lo) + end))
        taken, out = [], []
        for d, name, lo, hi in sorted(found):
            if all(hi < a or lo > b for a, b in taken):
                taken.append((lo, hi))
                out.append((-d, name, lo))
        return out


def _hashes(text: str) -> np.ndarray:
    data = _FOLD[np.frombuffer(text.encode(), np.uint8)]
    return grams(word_hashes(data, *spans(data, np.array([0, len(data)]))), 2)


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Byte ranges of the lines, the paragraphs and the whole texts.  data is folded."""
    inner = offsets[1:-1]
    breaks = np.flatnonzero(data == 10)
    lines = np.unique(np.concatenate([[0], inner, breaks + 1, [len(data)]]))
    yield lines[:-1], lines[1:]
    filled = np.concatenate([[0], np.cumsum(data > 32)])
    blank = filled[lines[1:]] == filled[lines[:-1]]
    para = np.unique(np.concatenate([[0], inner, lines[:-1][blank], lines[1:][blank], [len(data)]]))
    yield para[:-1], para[1:]
    yield offsets[:-1], offsets[1:]


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, threshold: float = 0.8) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, license_id, dice, n_parts, licenses.

    license_id has the largest coefficient of any part or window of the text (of equal ones the first name), n_parts
    counts the lines that reach the threshold and licenses has the names found in any part or window, sorted.  Nothing found, null and
    empty texts: null, null, 0, empty.  A template or part of fewer than two words matches nothing.  The whole text
    is read, however long.  An empty table gives an empty result.
    """
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(templates, threshold)
        for batch in batches:
            data, at = buffers(batch.column("text"))
            i, n = 0, batch.num_rows
            while i < n:
                j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK_BYTES, "right")) - 1)
                own, offsets = _FOLD[data[at[i] : at[j]]], at[i : j + 1] - at[i]
                best: list[tuple[float, str] | None] = [None] * (j - i)
                count, names = np.zeros(j - i, np.int64), [set() for _ in range(j - i)]
                starts, ends = spans(own, offsets)
                pair = grams(word_hashes(own, starts, ends), 2)
                known = np.isin(pair, m.vocabulary)
                hit = np.concatenate([[0], np.cumsum(known), [0]])
                hit[-1] = hit[-2]
                first = np.searchsorted(starts, offsets)
                blocked = np.zeros(len(pair), bool)  # bigrams over the edge of a document and those of parts found
                edge = first[1:-1] - 1
                blocked[edge[(edge >= 0) & (edge < len(pair))]] = True
                for level, (lo, hi) in enumerate(_parts(own, offsets)):
                    a, b = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
                    two = b - a >= 2
                    shared = hit[np.minimum(np.where(two, b - 1, a), len(hit) - 1)] - hit[np.minimum(a, len(hit) - 1)]
                    for k in np.flatnonzero(two & (shared >= m.fewest)):
                        found = m.best(own[lo[k] : hi[k]].tobytes().split())
                        if found:
                            d = int(np.searchsorted(offsets, lo[k], "right")) - 1
                            count[d] += level == 0
                            names[d].add(found[1])
                            best[d] = found if best[d] is None else min(best[d], found, key=lambda x: (-x[0], x[1]))
                            blocked[a[k] : b[k] - 1] = True
                for score, name, lo in m.windows(pair, np.flatnonzero(known & ~blocked), blocked):
                    d = int(np.searchsorted(first, lo, "right")) - 1
                    names[d].add(name)
                    best[d] = (score, name) if best[d] is None else min(best[d], (score, name), key=lambda x: (-x[0], x[1]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array([x and x[1] for x in best], pa.string()), pa.array([x and x[0] for x in best], pa.float64()), pa.array(count), pa.array([sorted(x) for x in names], pa.list_(pa.string()))],
                    names=["doc_id", "license_id", "dice", "n_parts", "licenses"],
                )
                i = j

    return docs.select("doc_id", "text").mapInArrow(released(run), "doc_id long, license_id string, dice double, n_parts long, licenses array<string>")
