"""License scan: winnowed fingerprints of templates, an inverted index, banded alignment.

The templates are a parameter of bounded size; their winnowed three-word fingerprints form
an inverted index that every worker holds. A document's three-word grams are looked up
together. The hits of a template are chained by ascending position, a chain being one place
where the template may stand, with words left out or put in between its fragments; a banded
alignment around the chain's diagonals reports how much of the template is there and where.
Documents never move.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import bounded_batches, held, list_array, to_bytes
from spendlens.llm.decontaminate import word_spans, words_of

GRAM, WINNOW = 3, 2
#: A template has at most this many words, so that an alignment's fields fit one integer.
MAX_WORDS = 1000
MATCH = "array<struct<template:string,coverage:double,matched:int,first_word:int,last_word:int,first_byte:int,last_byte:int>>"

_GNU = ("This {what} is free software{sep} you can redistribute it and/or modify it under the terms of the GNU {name} "
        "as published by the Free Software Foundation{sep2} either version {version} of the License, or (at your "
        "option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU {name} for more details.")
_BSD_START = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
              "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
              "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
              "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
              "documentation and/or other materials provided with the distribution. ")
_BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
            "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
            "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
            "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
            "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
            "POSSIBILITY OF SUCH DAMAGE.")


def _gnu(name: str, version: str, what: str, old: bool) -> str:
    return _GNU.format(name=name, version=version, what=what, sep=";" if old else ":", sep2=";" if old else ",")


#: Statements and notices as their licenses prescribe them, whole but for the Unlicense (first paragraph).
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
    "either express or implied. See the License for the specific language governing permissions and limitations under "
    "the License.",
    "mit-line": "Released under the MIT License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
    "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
    "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.",
    "bsd-2-clause-notice": _BSD_START + _BSD_END,
    "bsd-3-clause-notice": _BSD_START + _BSD_THIRD + _BSD_END,
    "zlib-notice": "This software is provided 'as-is', without any express or implied warranty. In no event will the "
    "authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
    "use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
    "subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not "
    "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
    "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked "
    "as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
    "altered from any source distribution.",
    "unlicense-notice": "This is free and unencumbered software released into the public domain. Anyone is free to "
    "copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
    "compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0-notice": _gnu("General Public License", "2", "program", True),
    "gpl-3.0-notice": _gnu("General Public License", "3", "program", False),
    "lgpl-2.1-notice": _gnu("Lesser General Public License", "2.1", "library", True),
    "lgpl-3.0-notice": _gnu("Lesser General Public License", "3", "program", False),
    "agpl-3.0-notice": _gnu("Affero General Public License", "3", "program", False),
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
    "of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "epl-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse "
    "Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
    "cc0-1.0-line": "Dedicated to the public domain under CC0 1.0.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0-line": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0-line": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0-line": "Licensed under CC BY-NC-ND 4.0.",
    "all-rights-reserved": "All rights reserved.",
}
#: Words that tell a license from its relatives. Each phrase must stand in the match as it is.
REQUIRED = {
    "apache-2.0-line": ["version 2 0"], "apache-2.0-notice": ["version 2 0"], "mit-line": ["mit license"],
    "bsd-3-clause-notice": ["neither the name"],
    "gpl-2.0-line": ["gnu general public", "version 2"], "gpl-3.0-line": ["gnu general public", "version 3"],
    "gpl-2.0-notice": ["gnu general public", "version 2"], "gpl-3.0-notice": ["gnu general public", "version 3"],
    "lgpl-2.1-notice": ["gnu lesser general public", "version 2 1"],
    "lgpl-3.0-notice": ["gnu lesser general public", "version 3"],
    "agpl-3.0-notice": ["gnu affero general public", "version 3"],
    "mpl-2.0-notice": ["v 2 0"], "epl-2.0-notice": ["license 2 0"], "cc0-1.0-line": ["cc0 1 0"],
    "cc-by-4.0-line": ["cc by 4 0"], "cc-by-sa-4.0-line": ["cc by sa 4 0"], "cc-by-nd-4.0-line": ["cc by nd 4 0"],
    "cc-by-nc-4.0-line": ["cc by nc 4 0"], "cc-by-nc-sa-4.0-line": ["cc by nc sa 4 0"],
    "cc-by-nc-nd-4.0-line": ["cc by nc nd 4 0"],
}


def winnow(hashes: list) -> set:
    """Positions of the winnowed hashes: the rightmost smallest of every WINNOW in a row."""
    if len(hashes) <= WINNOW:
        return {min(range(len(hashes)), key=lambda i: (hashes[i], -i))} if hashes else set()
    return {min(range(i, i + WINNOW), key=lambda j: (hashes[j], -j)) for i in range(len(hashes) - WINNOW + 1)}


_SCORE, _MATCHED, _FIRST, _FIELD = 1 << 44, 1 << 32, 1 << 16, 0xFFFF


def align(template: np.ndarray, codes: np.ndarray, low: int, high: int) -> tuple[int, int, int, int]:
    """(score, matched template words, first, last word of the document part) of the best alignment of
    the whole template whose path stays on the diagonals ``low`` to ``high`` (a diagonal is the
    word index where the template would start). Match 2, mismatch and gap -1; the document's
    ends are free. A cell is one integer: score, then matched words, then the first and the
    last matched word, so that of equal scores more matched words, then the earlier start win.
    """
    n, width = len(template), high - low + 1
    window = np.zeros(n + width, np.int64)  # words low .. high + n; nothing outside the document
    a, b = max(low, 0), min(high + n, len(codes))
    window[a - low:b - low] = codes[a:b]
    steps = np.arange(width, dtype=np.int64) * _SCORE
    row = np.zeros(width, np.int64)
    for i in range(n):
        at = np.arange(i, i + width)
        first = np.where((row & (_MATCHED - 1) & ~np.int64(_FIELD)) == 0, (_FIELD - at) * _FIRST, 0)
        hit = (row & ~np.int64(_FIELD)) + 2 * _SCORE + _MATCHED + first + at
        new = np.where(window[i:i + width] == template[i], hit, row - _SCORE)
        new[:-1] = np.maximum(new[:-1], row[1:] - _SCORE)          # template word left out
        row = np.maximum.accumulate(new + steps) - steps            # document words left out
    best = int(row.max())
    matched = (best >> 32) & 0xFFF
    if not matched:
        return best >> 44, 0, -1, -1
    return best >> 44, matched, low + _FIELD - ((best >> 16) & _FIELD), low + (best & _FIELD)


class Index:
    """Inverted index from winnowed gram to (template, position)."""

    def __init__(self, templates: dict[str, str], min_coverage: float, band: int, gap: int,
                 required: dict[str, list]):
        self.band, self.min_coverage = band, min_coverage
        words = {n: words_of(t.encode()) for n, t in sorted(templates.items())}
        self.number: dict[bytes, int] = {}
        for w in (w for ws in words.values() for w in ws):
            self.number.setdefault(w, len(self.number) + 1)
        self.size = len(self.number) + 1
        self.codes = {n: np.array([self.number[w] for w in ws], np.int64) for n, ws in words.items()}
        self.counts = {n: np.bincount(c, minlength=self.size) for n, c in self.codes.items()}
        self.needed = {n: [np.array([self.number.get(w, 0) for w in words_of(p.encode())], np.int64)
                           for p in required.get(n, [])] for n in words}
        self.drift = {n: max(band, min(gap, len(ws) // 2)) for n, ws in words.items()}
        self.at: dict[int, list] = {}
        for name, ws in words.items():
            if len(ws) > MAX_WORDS:
                raise ValueError(f"template {name} has over {MAX_WORDS} words")
            grams = [ws[i:i + GRAM] for i in range(max(0, len(ws) - GRAM + 1))]
            hashes = [xxhash.xxh3_64_intdigest(b" ".join(g)) for g in grams]
            for i in sorted(winnow(hashes)):
                code = 0
                for w in grams[i]:
                    code = code * self.size + self.number[w]
                self.at.setdefault(code, []).append((name, i))
        self.grams = np.array(sorted(self.at), np.int64)

    def hits(self, codes: np.ndarray) -> dict[str, list]:
        """Per template the (document position, template position) of the winnowed grams, ascending."""
        n = len(codes) - GRAM + 1
        out: dict[str, list] = {}
        if n <= 0 or not len(self.grams):
            return out
        part = [codes[k:k + n] for k in range(GRAM)]
        maybe = np.flatnonzero((part[0] > 0) & (part[1] > 0) & (part[2] > 0))
        grams = (part[0][maybe] * self.size + part[1][maybe]) * self.size + part[2][maybe]
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        hit = self.grams[at] == grams
        for pos, gram in zip(maybe[hit].tolist(), grams[hit].tolist(), strict=True):
            for name, i in self.at[gram]:
                out.setdefault(name, []).append((pos, i))
        return out

    def chains(self, name: str, hits: list) -> list[tuple[int, int]]:
        """(lowest, highest diagonal) of every place. A hit joins the open chain it drifts least
        from, behind its last hit in the document and in the template; a hit that fits none, or
        whose chain began with another place of the same gram, opens its own."""
        drift, reach = self.drift[name], len(self.codes[name]) + self.drift[name]
        done, live = [], []  # chain: [last position, last template position, lowest, highest diagonal]
        for pos, i in hits:
            done += [c for c in live if pos - c[0] > reach]
            live = [c for c in live if pos - c[0] <= reach]
            fits = [c for c in live if c[0] < pos and c[1] < i and abs(pos - i - c[0] + c[1]) <= drift]
            if fits:
                c = min(fits, key=lambda c: abs(pos - i - c[0] + c[1]))
                c[:] = pos, i, min(c[2], pos - i), max(c[3], pos - i)
            else:
                live.append([pos, i, pos - i, pos - i])
        return sorted({(c[2], c[3]) for c in done + live})

    def find(self, words: list) -> list[tuple]:
        """(template, coverage, matched, first, last word): per template the places in the order of
        the document. A place that is found is taken out, so the next alignment goes to another."""
        codes = np.fromiter((self.number.get(w, 0) for w in words), np.int64, len(words))
        out = []
        for name, hits in sorted(self.hits(codes).items()):
            template, left, taken = self.codes[name], codes.copy(), []
            least = self.min_coverage * len(template)
            for low, high in self.chains(name, hits):
                low, high = low - self.band, high + self.band
                while True:
                    near = np.bincount(left[max(low, 0):high + len(template)], minlength=self.size)
                    if np.minimum(near, self.counts[name])[1:].sum() < least:
                        break  # too few of the template's words are near, in whatever order
                    _, matched, first, last = align(template, left, low, high)
                    if not matched or matched < least or any(first <= b and last >= a for _, a, b in taken):
                        break
                    if self._has(name, left[first:last + 1]):
                        taken.append((matched, first, last))
                    left[first:last + 1] = 0
            out += [(name, m / len(template), m, a, b) for m, a, b in sorted(taken, key=lambda x: x[1])]
        return out

    def _has(self, name: str, codes: np.ndarray) -> bool:
        for phrase in self.needed[name]:
            n = len(codes) - len(phrase) + 1
            if n <= 0 or not np.logical_and.reduce([codes[k:k + n] == w for k, w in enumerate(phrase)]).any():
                return False
        return True


def scan_udf(*settings):
    key = hashlib.sha256(repr(("licenses", settings)).encode()).hexdigest()

    @F.arrow_udf(MATCH)
    def scan(texts: pa.Array) -> pa.Array:
        index = held(key, lambda: Index(*settings))
        rows, counts = [], []
        for raw in to_bytes(texts):
            found = index.find(words_of(raw))
            counts.append(len(found))
            if found:
                at = word_spans(raw)
                rows.extend((*f, at[f[3]][0], at[f[4]][1]) for f in found)
        kinds = (pa.string(), pa.float64(), *[pa.int32()] * 5)
        cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        return list_array(pa.StructArray.from_arrays(cols, [
            "template", "coverage", "matched", "first_word", "last_word", "first_byte", "last_byte"]), counts)
    return scan


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str] | None = None, min_coverage: float = 0.8,
                  band: int = 6, gap: int = 24, required: dict[str, list] | None = None) -> DataFrame:
    """One row per match: id, template, coverage (share of the template's words that align),
    matched, first_word, last_word (document words, last included), first_byte, last_byte
    (UTF-8, last excluded).

    Words are runs of ASCII letters and digits and of other characters, A-Z lower-cased.
    Fragments of a template belong to one place where at most ``gap`` words (at most half the
    template's, at least ``band``) are put in or left out between two of them; inside a fragment the alignment
    may leave its diagonal by ``band`` words. A match must hold each of the template's ``required``
    phrases unbroken (``REQUIRED`` for the default templates). Null, empty and clean texts
    give no row; a repeated row gives its matches again; a text that repeats a license gives
    one row for each place, and a statement inside a notice is a place of its own template. A
    place is found if one winnowed three-word gram of the template stands there unchanged;
    templates of fewer than three words are never found, those of over ``MAX_WORDS`` are an
    error. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    if templates is None:
        templates, required = TEMPLATES, REQUIRED if required is None else required
    found = scan_udf(templates, min_coverage, band, gap, required or {})(docs[text_col])
    return docs.select(docs[id_col].alias(id_col), F.explode(found).alias("m")).select(id_col, "m.*")
