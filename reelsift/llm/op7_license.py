"""Licence scans with a generalised suffix automaton.

Texts of licences and the base phrases, as tokens, go into one automaton.  A
file's tokens stream through it: after each token the state and length tell the
longest suffix of the file so far that occurs in some template (the matching
statistics).  Matches that can't be extended and are long enough are chained per
template, in order and with bounded gaps, and their covered template spans decide
on labels: a chain's score is the number of template tokens that it covers, and the
best chains that don't share words of the file are taken in turn.  Base phrases are
read off the same walk: a phrase ends wherever its state is the current one or a
suffix-link ancestor of it.

Edge cases: null text has no words; a row without a place has null first and last
words, empty labels and score 0; very long texts are streamed whole; of chains tied
in score the earlier one is taken; repeated and null ids give one row each; an empty
table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from reelsift.llm.common import read_table, tune

#: Fixed phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Public licence texts, and the notices by which works are put under a licence.
TEMPLATES = (
    ("mit-text", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("apache-2-notice", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("bsd-text", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("gpl-notice", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."""),
    ("gpl-3-line", """This work is licensed under the GNU General Public License, version 3."""),
    ("isc-text", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("mpl-notice", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("zlib-text", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("cc-by-nc-notice", """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"""),
    ("cc-by-notice", """This work is licensed under a Creative Commons Attribution 4.0 International License"""),
    ("cc-by-sa-notice", """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"""),
    ("cc0-notice", """To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work"""),
)
#: Shortest match that may join a chain, largest gap inside one, and the covered share that gives a label.
MIN_MATCH, MAX_GAP, MIN_COVER = 4, 12, 0.6
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words of digits, letters a-z and anything beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


class Automaton:
    """Generalised suffix automaton of integer sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.where: list[list[tuple[int, int]]] = [[]]  # (sequence, end) of prefixes that end here
        for s, seq in enumerate(sequences):
            last = 0
            for i, c in enumerate(seq):
                last = self._extend(last, c)
                self.where[last].append((s, i + 1))
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)
        for v in order:  # occurrences of a state are those of its suffix-tree children
            if self.link[v] > 0:
                self.where[self.link[v]] += self.where[v]
        self.where = [sorted(set(w)) for w in self.where]

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(nxt)
        self.link.append(link)
        self.where.append([])
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if (q := self.next[last].get(c)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def walk(self, seq: list[int]) -> Iterator[tuple[int, int]]:
        """State and match length after each symbol."""
        v = n = 0
        for c in seq:
            while v and c not in self.next[v]:
                v = self.link[v]
                n = self.length[v]
            if (to := self.next[v].get(c)) is not None:
                v, n = to, n + 1
            else:
                v = n = 0
            yield v, n


class Scanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases = [(tokens(p), label) for p, label in phrases]
        self.templates = [(tokens(t), label) for label, t in templates]
        self.ids = _Ids()
        seqs = []
        for words, _ in [*self.templates, *self.phrases]:
            for w in words:
                if w not in self.ids:
                    self.ids[w] = len(self.ids)
            seqs.append([self.ids[w] for w in words])
        self.sizes = [len(s) for s in seqs]
        self.auto = Automaton(seqs)
        self.shortest = min([*(len(p) for p, _ in self.phrases), MIN_MATCH])
        ends: dict[int, list[int]] = {}
        for k, (words, _) in enumerate(self.phrases):
            *_, (v, n) = self.auto.walk([self.ids[w] for w in words])
            assert n == len(words)
            ends.setdefault(v, []).append(k)
        self.ends: list[tuple[int, ...]] = [()] * len(self.auto.length)
        for v in sorted(range(1, len(self.auto.length)), key=self.auto.length.__getitem__):
            self.ends[v] = self.ends[self.auto.link[v]] + tuple(ends.get(v, ()))

    def scan(self, text: str | None) -> dict:
        """n_words, places [(start, label)], spans [(template, from, to, share)] of a text."""
        words = tokens(text)
        ids = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        known = np.flatnonzero(ids >= 0)
        places: list[tuple[int, str]] = []
        matches: list[tuple[int, int, int]] = []  # first word, end, state
        if len(known) >= self.shortest:
            breaks = np.flatnonzero(np.diff(known) > 1)
            first = np.concatenate([[0], breaks + 1])
            last = np.append(breaks, len(known) - 1)
            for a, b in zip(known[first].tolist(), known[last].tolist()):
                if b - a + 1 < self.shortest:
                    continue
                v0 = n0 = 0
                for i, (v, n) in enumerate(self.auto.walk(ids[a : b + 1].tolist()), start=a + 1):
                    for k in self.ends[v]:
                        if n >= self.sizes[len(self.templates) + k]:
                            places.append((i - self.sizes[len(self.templates) + k], self.phrases[k][1]))
                    if n <= n0 and n0 >= MIN_MATCH:
                        matches.append((i - 1 - n0, i - 1, v0))
                    v0, n0 = v, n
                if n0 >= MIN_MATCH:
                    matches.append((b + 1 - n0, b + 1, v0))
        return {"n_words": len(words), "places": sorted(places), "spans": self.chained(matches)}

    def chained(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """The best colinear chains by template: (label, first word, end, covered share of the template).

        ``matches`` are (first word, end, state) by growing end.  In a chain the
        ends grow in the file and in the template, gaps of the file are bounded,
        and each match counts the template tokens that it adds.
        """
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for a, b, v in matches:
            for s, e in self.auto.where[v]:
                if s < len(self.templates):
                    by_template.setdefault(s, []).append((a, b, e))
        out = []
        for s, items in by_template.items():
            best: list[tuple[int, int, int]] = []  # score, first word, the match before
            low = 0
            for j, (a, b, e) in enumerate(items):
                now = (b - a, a, -1)
                while a - items[low][1] > MAX_GAP:  # neither starts nor ends ever shrink: what is too far stays so
                    low += 1
                for i in range(low, j):
                    a0, b0, e0 = items[i]
                    if a0 < a and b0 < b and e0 < e and a - b0 <= MAX_GAP:
                        got = best[i][0] + min(b - max(a, b0), e - max(e - (b - a), e0))
                        if got > now[0]:
                            now = (got, best[i][1], i)
                best.append(now)
            taken: list[tuple[int, int]] = []
            for j in sorted(range(len(items)), key=lambda j: (-best[j][0], items[j][1])):
                score, first, _ = best[j]
                if score / self.sizes[s] < MIN_COVER:
                    break
                if all(items[j][1] <= x or first >= y for x, y in taken):
                    taken.append((first, items[j][1]))
                    out.append((self.templates[s][1], first, items[j][1], score / self.sizes[s]))
        return sorted(out, key=lambda x: (x[1], x[0]))


def scanned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row a document with its places, labels and score."""
    tune(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                got = scanner.scan(text)
                starts = [s for s, _ in got["places"]]
                base = sorted({x for _, x in got["places"]})
                every = sorted({*base, *(x[0] for x in got["spans"])})
                score = 1.0 if base else min(1.0, max((x[3] for x in got["spans"]), default=0.0))
                rows.append((got["n_words"], len(starts), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(every), score))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op7_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(spark, read_table(spark, sf_dir, "documents"))
