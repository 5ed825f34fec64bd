"""License scans: template markup compiled into token automata.

A template is a line of words. ``[...]`` is optional wording and ``<n>`` a
replaceable region of up to n words (a holder, a year, a title). All other
wording is mandatory and must match exactly, word by word, where words are runs
of letters (A to Z in lower case), digits and bytes beyond ASCII; everything
else, such as line breaks and comment signs, only separates words.

A template becomes an automaton over words: a state per place in it, edges for
its words, skips over optional wording, and counted wildcards. It is started only
where its first two words stand, found on all words of a batch at once by hash,
and accepts at its end. So the cost of a text without a license is that of
finding its words.

Base labels come from fixed phrases. Labels are those of the phrases and of the
accepted templates. The score is 1 when a template is accepted, else the largest
share of a template's mandatory words that an automaton got through.

Null and empty texts have no words, no labels and score 0. Repeated rows are
scanned each. Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattspan.functions.columns import qcol
from wattspan.llm.batches import Prefix, bounds, lowered, runs
from wattspan.llm.frames import by_slice, texts

# Phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Templates and their labels; each begins with two mandatory words.
TEMPLATES = [
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "[and associated documentation files] <4> to deal in the software without restriction", "mit-grant"),
    ("licensed under the apache license version 2 0 [the license]", "apache-2.0"),
    ("this work is licensed under the [gnu] general public license version 3 [or any later version]", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "[lesser] general public license", "gpl-notice"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under [a] creative commons <6> license", "creative-commons"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("all rights reserved [by <6>]", "reserved"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "[and associated documentation files] <4> to deal in <2> software without restriction including without limitation "
     "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and "
     "this permission notice [including the next paragraph] shall be included in all copies or substantial portions of the "
     "software the software is provided as is without warranty of any kind express or implied including but not limited to "
     "the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <8> be liable "
     "for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in "
     "connection with the software or the use or other dealings in the software", "mit-text"),
    ("permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies the software is provided as "
     "is and <8> disclaims all warranties with regard to this software including all implied warranties of merchantability "
     "and fitness in no event shall <8> be liable for any special direct indirect or consequential damages or any damages "
     "whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious "
     "action arising out of or in connection with the use or performance of this software", "isc-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met [1] redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer [2] redistributions in binary form must reproduce the above copyright notice "
     "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
     "distribution [[3] neither the name of <12> nor the names of <3> contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission] this software is provided by <12> as is and any "
     "express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a "
     "particular purpose are disclaimed in no event shall <12> be liable for any direct indirect incidental special exemplary "
     "or consequential damages including but not limited to procurement of substitute goods or services loss of use data or "
     "profits or business interruption however caused and on any theory of liability whether in contract strict liability or "
     "tort including negligence or otherwise arising in any way out of the use of this software even if advised of the "
     "possibility of such damage", "bsd-text"),
    ("this software is provided as is without any express or implied warranty in no event will <8> be held liable for any "
     "damages arising from the use of this software permission is granted to anyone to use this software for any purpose "
     "including commercial applications and to alter it and redistribute it freely subject to the following restrictions [1] "
     "the origin of this software must not be misrepresented you must not claim that you wrote the original software if you "
     "use this software in a product an acknowledgment in the product documentation would be appreciated but is not required "
     "[2] altered source versions must be plainly marked as such and must not be misrepresented as being the original "
     "software [3] this notice may not be removed or altered from any source distribution", "zlib-text"),
    ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
     "compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial "
     "or non commercial and by any means", "unlicense-text"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
     "license you may obtain a copy of the license at <1> www apache org licenses license 2 0 unless required by applicable "
     "law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties "
     "or conditions of any kind either express or implied see the license for the specific language governing permissions "
     "and limitations under the license", "apache-2.0-text"),
]

_WORD_BYTES = np.ones(256, bool)
for _lo, _hi in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    _WORD_BYTES[_lo:_hi + 1] = False


def word_hashes(words: list[str]) -> list[int]:
    raw = " ".join(words).encode()
    off = np.array([0, len(raw)])
    data = np.frombuffer(raw, np.uint8)
    starts, ends = runs(data != 32, off)
    return Prefix(data).of(starts, ends).tolist()


class Automaton:
    """States 0 to n; ``step[q]`` lists (word or None for any, target), ``skips[q]`` targets without a word.

    ``through[q]`` is the number of mandatory words on the way to q.
    """

    def __init__(self, markup: str, label: str):
        self.label = label
        self.step: list[list[tuple[str | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        self.through = [0]
        opened: list[int] = []
        for sign, count, word in re.findall(r"([\[\]])|<(\d+)>|([^\s\[\]<>]+)", markup):
            if sign == "[":
                opened.append(len(self.step) - 1)
            elif sign == "]":
                self.skips[opened.pop()].append(len(self.step) - 1)
            elif count:
                # Each of the region's words may be left out.
                here = len(self.step) - 1
                for _ in range(int(count)):
                    self._add(None, True)
                for q in range(here, len(self.step) - 1):
                    self.skips[q].append(len(self.step) - 1)
            else:
                self._add(word, bool(opened))
        self.final = len(self.step) - 1
        self.mandatory = self.through[-1]
        first = markup.split()[:2]
        if len(first) < 2 or not all(re.fullmatch(r"[a-z0-9]+", w) for w in first):
            raise ValueError("a template begins with two mandatory words")
        self.first = first

    def _add(self, word: str | None, optional: bool) -> None:
        self.step[-1].append((word, len(self.step)))
        self.step.append([])
        self.skips.append([])
        self.through.append(self.through[-1] + (not optional))

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for q in self.skips[todo.pop()]:
                if q not in states:
                    states.add(q)
                    todo.append(q)
        return states

    def run(self, words) -> tuple[bool, int]:
        """Whether the words from here on begin with the template, and the most mandatory words got through."""
        states, most = self._closed({0}), 0
        for w in words:
            if self.final in states:
                break
            states = self._closed({to for q in states for want, to in self.step[q] if want is None or want == w})
            if not states:
                break
            most = max(most, max(self.through[q] for q in states))
        return self.final in states, most


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=None, templates=None) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and
    ``score``."""
    known = [(tuple(p.split()), word_hashes(p.split()), label) for p, label in (PHRASES if phrases is None else phrases)]
    machines = [Automaton(m, label) for m, label in (TEMPLATES if templates is None else templates)]
    heads = [(m, word_hashes(m.first)) for m in machines]

    def scan(batch, lo, hi, data, off):
        low = lowered(data)
        starts, ends = runs(_WORD_BYTES[low], off)
        h = Prefix(low).of(starts, ends)
        first = bounds(starts, off)
        n = np.diff(first)
        raw = low.tobytes()
        word = lambda i: raw[starts[i]:ends[i]].decode("utf-8", "replace")

        def places(hashes):
            """First words of the places where these words stand one after another in one text, and the texts."""
            k = len(hashes)
            at = np.flatnonzero(h[:len(h) - k + 1] == np.uint64(hashes[0])) if len(h) >= k else np.zeros(0, np.int64)
            for j in range(1, k):
                at = at[h[at + j] == np.uint64(hashes[j])]
            doc = np.searchsorted(first, at, side="right") - 1
            inside = at + k <= first[doc + 1]
            return at[inside], doc[inside]

        rows = hi - lo
        n_base = np.zeros(rows, np.int64)
        least, most = np.full(rows, np.iinfo(np.int64).max), np.full(rows, -1)
        base, more, score = {}, {}, np.zeros(rows)
        for words, hashes, label in known:
            for i, d in zip(*(x.tolist() for x in places(hashes))):
                if all(word(i + j) == w for j, w in enumerate(words)):
                    n_base[d] += 1
                    least[d], most[d] = min(least[d], i - first[d]), max(most[d], i - first[d])
                    base.setdefault(d, set()).add(label)
        for machine, hashes in heads:
            for i, d in zip(*(x.tolist() for x in places(hashes))):
                accepted, got = machine.run(word(j) for j in range(i, first[d + 1]))
                score[d] = max(score[d], 1.0 if accepted else got / machine.mandatory)
                if accepted:
                    more.setdefault(d, set()).add(machine.label)
        named = lambda *sets: [",".join(sorted(set().union(*(s.get(d, ()) for s in sets)))) for d in range(rows)]
        none = n_base == 0
        return {
            "_id": batch.column("_id").slice(lo, rows), "n_words": n, "n_base": n_base,
            "first_word": pa.array(least, pa.int64(), mask=none), "last_word": pa.array(most, pa.int64(), mask=none),
            "base_labels": named(base), "labels": named(base, more), "score": score,
        }

    out = by_slice(texts(docs, id_col, text_col), scan, (
        "_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double"))
    return out.select(qcol("_id").alias(id_col), *[c for c in out.columns if c != "_id"])
