"""License scans by template-markup matching.

A license text is described by a template: mandatory words, ``[[optional words]]`` and
``{{name:low-high}}`` regions that stand for ``low`` to ``high`` words.  Regions named
``version`` take version numbers only, ``year`` years, ``number`` numbers; any other name (a
holder's) takes any words.  A template is compiled into a token automaton: states are
positions in the template, optional regions and replaceable regions are epsilon and
word-class moves.  A text is accepted where the automaton reaches its end; mandatory words
must match exactly.

The catalogue holds the complete texts of short licenses, the notices by which the long ones
are applied, and short statements.  *The most specific template wins*: of accepted places
that overlap, the one with the most mandatory words gives the label, and those it overlaps
give none (so a text under BY-NC is not also called BY).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, found for a whole
batch at once by byte class and compared by 64-bit hash, then byte for byte.  An automaton
is only started where the first two mandatory words of the template stand together
(templates begin with mandatory words), so work follows the hits, not templates times text.

Base phrases are plain consecutive words; every place counts.  Labels: base labels plus
those of accepted templates.  ``score``: 1 for an accepted template, else 0.5 for a base
phrase, else half of the largest share of mandatory words that some started automaton
matched before it died (0 if none started).

Defined cases: NULL and empty texts have no words, no labels and score 0; very long texts are
scanned whole; of overlapping places with equally many mandatory words the earlier one wins,
then the longer, then the first label by name; repeated rows are judged alike; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from offerlake.llm.common import map_batches, pick, prepare
from offerlake.llm.textnp import Words, alnum_or_high, byte_values, words

BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Wording of public licenses and of the notices that apply them.
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
          "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
          "{{holders:1-8}} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
          "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE")
_BSD_HEAD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met: [[{{number:1-1}}]] Redistributions of source code must retain the above copyright "
             "notice, this list of conditions and the following disclaimer. [[{{number:1-1}}]] Redistributions in binary form "
             "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
             "documentation and/or other materials provided with the distribution. ")
_BSD_NAME = ("[[{{number:1-1}}]] Neither the name of {{holder:1-12}} nor the names of its contributors may be used to endorse "
             "or promote products derived from this software without specific prior written permission. ")
_BSD_TAIL = ("THIS SOFTWARE IS PROVIDED BY {{holders:1-12}} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
             "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
             "EVENT SHALL {{holders:1-12}} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
             "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
             "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
             "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
             "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE")
_FREE_HEAD = "free software: you can redistribute it and/or modify it under the terms of the GNU "
_FREE_TAIL = " as published by the Free Software Foundation, either version {{version:1-2}} of the License, or (at your option) any later version"
_ONLY_TAIL = " as published by the Free Software Foundation, [[either]] version {{version:1-2}} of the License"
_CC = "licensed under [[a]] [[the]] [[creative commons]] cc by"
_CC_LONG = "licensed under a creative commons attribution"

#: (label, template); labels beyond the base ones name the kind of statement found.
TEMPLATES = (
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                 "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                 "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
                 "conditions: The above copyright notice and this permission notice [[(including the next paragraph)]] shall be "
                 "included in all copies or substantial portions of the Software. " + _AS_IS),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd-2-text", _BSD_HEAD + _BSD_TAIL),
    ("bsd-3-text", _BSD_HEAD + _BSD_NAME + _BSD_TAIL),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                          "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/"
                          "LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the "
                          "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
                          "express or implied"),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                       "was not distributed with this file, You can obtain one at [[http://]] [[https://]] mozilla.org/MPL/2.0"),
    ("gpl-or-later", _FREE_HEAD + "General Public License" + _FREE_TAIL),
    ("gpl-only", _FREE_HEAD + "General Public License" + _ONLY_TAIL),
    ("lgpl-or-later", _FREE_HEAD + "Library General Public License" + _FREE_TAIL),
    ("lgpl", _FREE_HEAD + "Lesser General Public License" + _ONLY_TAIL),
    ("lgpl-or-later", _FREE_HEAD + "Lesser General Public License" + _FREE_TAIL),
    ("agpl-or-later", _FREE_HEAD + "Affero General Public License" + _FREE_TAIL),
    ("agpl", _FREE_HEAD + "Affero General Public License" + _ONLY_TAIL),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
                  "liable for any damages arising from the use of this software"),
    ("apache-2.0", "licensed under the apache license [[version]] 2.0"),
    ("apache-2.0", "released under the apache license [[version]] 2.0"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("mpl-2.0", "licensed under the mozilla public license [[version]] [[v]] 2.0"),
    ("bsd", "licensed under the bsd license"),
    ("bsd-2", "licensed under the bsd 2 clause license"),
    ("bsd-3", "licensed under the bsd 3 clause license"),
    ("cc0", "licensed under cc0 [[{{version:1-2}}]]"),
    ("cc-by", _CC + " {{version:1-2}}"),
    ("cc-by-sa", _CC + " sa {{version:1-2}}"),
    ("cc-by-nc", _CC + " nc {{version:1-2}}"),
    ("cc-by-nd", _CC + " nd {{version:1-2}}"),
    ("cc-by-nc-sa", _CC + " nc sa {{version:1-2}}"),
    ("cc-by-nc-nd", _CC + " nc nd {{version:1-2}}"),
    ("cc-by", _CC_LONG + " [[{{version:1-2}}]] [[international]] [[unported]] license"),
    ("cc-by-sa", _CC_LONG + " sharealike [[{{version:1-2}}]] [[international]] [[unported]] license"),
    ("cc-by-nc", _CC_LONG + " noncommercial [[{{version:1-2}}]] [[international]] [[unported]] license"),
    ("cc-by-nd", _CC_LONG + " noderivatives [[{{version:1-2}}]] [[international]] [[unported]] license"),
    ("cc-by-nc-sa", _CC_LONG + " noncommercial sharealike [[{{version:1-2}}]] [[international]] [[unported]] license"),
    ("cc-by-nc-nd", _CC_LONG + " noncommercial noderivatives [[{{version:1-2}}]] [[international]] [[unported]] license"),
)

#: Word classes of regions, by region name; other regions take any word.
CLASSES = {"version": rb"v?[0-9]{1,3}", "year": rb"(?:19|20)[0-9]{2}", "number": rb"[0-9]+"}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Move:
    """One step of an automaton: a mandatory word (``word``), or a region of any words."""
    word: bytes | None
    low: int = 1
    high: int = 1
    optional_end: int | None = None  # first state after an optional region that starts here
    kind: re.Pattern | None = None  # words a region takes (None: any)


def compile_template(template: str) -> list[Move]:
    """Template text -> automaton moves."""
    moves: list[Move] = []
    opened: list[int] = []
    for part in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", re.sub("[A-Z]", lambda m: m[0].lower(), template)):
        if part == "[[":
            opened.append(len(moves))
            moves.append(Move(None, 0, 0))
        elif part == "]]":
            at = opened.pop()
            moves[at] = Move(None, 0, 0, len(moves))
        elif part.startswith("{{"):
            name, low, high = re.search(r"(\w+):(\d+)-(\d+)", part).groups()
            moves.append(Move(None, int(low), int(high), None, re.compile(CLASSES[name]) if name in CLASSES else None))
        else:
            moves.extend(Move(w.encode()) for w in _WORD.findall(part))
    if opened:
        raise ValueError(f"unclosed optional region: {template}")
    if len(moves) < 2 or moves[0].word is None or moves[1].word is None:
        raise ValueError(f"a template begins with two mandatory words: {template}")
    return moves


def run_automaton(moves: list[Move], n_left: int, word_at) -> tuple[int | None, int]:
    """Run from a start: (words consumed at the first acceptance or None, mandatory words
    matched at most).  ``word_at(i)`` gives the i-th word from the start."""
    def closure(states: set[tuple[int, int]]) -> set[tuple[int, int]]:
        """States (position, words already taken by the region there) after free moves."""
        out, todo = set(), list(states)
        while todo:
            s, taken = todo.pop()
            if (s, taken) in out:
                continue
            out.add((s, taken))
            if s < len(moves) and moves[s].word is None:
                m = moves[s]
                if m.optional_end is not None:
                    todo.append((m.optional_end, 0))
                if taken >= m.low:
                    todo.append((s + 1, 0))
        return out

    required = np.cumsum([m.word is not None for m in moves]).tolist()
    live, best, used = closure({(0, 0)}), 0, 0
    while live:
        best = max(best, max(required[s - 1] if s else 0 for s, _ in live))
        if any(s == len(moves) for s, _ in live):
            return used, best
        if used >= n_left:
            return None, best
        word, nxt = word_at(used), set()
        for s, taken in live:
            m = moves[s]
            if m.word is None:
                if taken < m.high and (m.kind is None or m.kind.fullmatch(word)):
                    nxt.add((s, taken + 1))
            elif m.word == word:
                nxt.add((s + 1, 0))
        live, used = closure(nxt), used + 1
    return None, best


def most_specific(places: list[tuple[int, int, int, str]]) -> list[str]:
    """Labels of (-mandatory words, start, -words, label) places without those that overlap a
    more specific one."""
    starts: list[int] = []
    ends: list[int] = []
    labels = []
    for _, start, minus, label in sorted(places):
        at = bisect(starts, start)
        if (at and ends[at - 1] > start) or (at < len(starts) and starts[at] < start - minus):
            continue
        starts.insert(at, start)
        ends.insert(at, start - minus)
        labels.append(label)
    return labels


class Scanner:
    """Compiled phrases and templates with the hashes of their first words."""

    def __init__(self, phrases, templates):
        self.phrases = [([p.encode() for p in text.split()], label) for text, label in phrases]
        self.automata = [(label, compile_template(t)) for label, t in templates]
        self.mandatory = [sum(m.word is not None for m in moves) for _, moves in self.automata]
        self._hashes: dict[bytes, np.uint64] = {}

    def hash_of(self, word: bytes) -> np.uint64:
        if word not in self._hashes:
            raw = np.frombuffer(word, np.uint8)
            w = Words(raw, np.array([0, len(raw)]), alnum_or_high(), byte_values(True))
            self._hashes[word] = w.hash[0]
        return self._hashes[word]

    def together(self, w: Words, parts: list[bytes]) -> np.ndarray:
        """Starts of consecutive words ``parts`` inside one text."""
        n = len(w) - len(parts) + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(w.hash[:n] == self.hash_of(parts[0]))
        for i, part in enumerate(parts[1:], 1):
            at = at[(w.hash[at + i] == self.hash_of(part)) & (w.doc[at + i] == w.doc[at])]
        return np.array([a for a in at if all(w.text(a + i).lower() == p for i, p in enumerate(parts))], np.int64)

    def scan(self, w: Words, rows: int) -> list[list]:
        count = np.diff(w.first)
        base: list[list] = [[] for _ in range(rows)]
        accepted: list[list] = [[] for _ in range(rows)]
        score = [0.0] * rows
        for parts, label in self.phrases:
            for a in self.together(w, parts).tolist():
                base[w.doc[a]].append((a - w.first[w.doc[a]], label))
        for (label, moves), mandatory in zip(self.automata, self.mandatory):
            for a in self.together(w, [moves[0].word, moves[1].word]).tolist():
                r = w.doc[a]
                used, best = run_automaton(moves, int(w.first[r + 1]) - a, lambda i, a=a: w.text(a + i).lower())
                if used is not None:
                    accepted[r].append((-mandatory, a, -used, label))
                    score[r] = 1.0
                else:
                    score[r] = max(score[r], 0.5 * best / mandatory)
        out = []
        for r in range(rows):
            labels = set(most_specific(accepted[r]))
            places = [p for p, _ in base[r]]
            base_labels = {b for _, b in base[r]}
            out.append([int(count[r]), len(places), int(min(places)) if places else None,
                        int(max(places)) if places else None, ",".join(sorted(base_labels)),
                        ",".join(sorted(base_labels | labels)), max(score[r], 0.5 if places else 0.0)])
        return out


_SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
           "labels string, score double")


def _scan(phrases, templates):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        is_word, values = alnum_or_high(), byte_values(True)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        for batch in batches:
            for a, b, w in words(batch.column("text"), is_word, values):
                found = list(zip(*scanner.scan(w, b - a)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *[pa.array(f, k) for f, k in zip(found, kinds)]], names)
    return run


def scan_licenses(docs: DataFrame, spark: SparkSession, phrases=BASE_PHRASES, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    prepare(spark)
    return map_batches(pick(docs, doc_id="bigint", text="string"), _scan(tuple(phrases), tuple(templates)), _SCHEMA)
