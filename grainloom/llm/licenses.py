"""License scans by template markup.

Templates are marked up as the SPDX license list does it: <<beginOptional>> ... <<endOptional>> around wording that may be
left out, and <<var;name="...";original="...";match="...">> where other wording may stand, whatever the regular expression
`match` accepts. A template is compiled to an automaton over words: a word is one step, optional wording has a way around
it, and a variable spans as many words as its expression accepts, from the first to the last of them as they are written.
A place of a text is accepted if the automaton reaches its end from there, so the mandatory wording, warranty clauses
included, stands there exactly, in order.

Words are compared as the base phrases' are: letters, digits and non-ASCII characters, ASCII in lower case.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.llm.common import quiet_threads
from grainloom.llm.textbytes import LOWER, Texts, slices, words

#: The base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

_COPYRIGHT = '<<var;name="copyright";original="Copyright (c) <year> <owner>";match="(?:copyright.{0,400})?">>'

#: Wording of public licenses, with markup.
TEMPLATES = {
    "tmpl:apache-2.0-notice": """
        Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License")<<endOptional>>; you may not use this file except in
        compliance with the License. You may obtain a copy of the License at <<var;name="url";original="http://www.apache.org/licenses/LICENSE-2.0";match=".{1,120}">>
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "tmpl:apache-2.0-statement": """Licensed under the <<beginOptional>>terms of the<<endOptional>> Apache License, Version 2.0""",
    "tmpl:gpl-3.0-statement": """
        This <<var;name="work";original="program";match=".{1,60}">> is licensed under the GNU General Public License
        <<beginOptional>>as published by the Free Software Foundation,<<endOptional>> <<beginOptional>>either<<endOptional>>
        version <<var;name="version";original="3";match="3(?:\\.0)?">> <<beginOptional>>of the License<<endOptional>>
        <<beginOptional>>, or (at your option) any later version<<endOptional>>""",
    "tmpl:gpl-notice": """
        This program is free software<<beginOptional>>:<<endOptional>> you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation<<beginOptional>>; either<<endOptional>> version
        <<var;name="version";original="2";match="[123](?:\\.0)?">> <<beginOptional>>of the License<<endOptional>>
        <<beginOptional>>, or (at your option) any later version<<endOptional>>.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "tmpl:cc-by-nc-4.0": """Licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative Commons<<endOptional>> CC BY-NC 4.0 <<beginOptional>>International<<endOptional>> <<beginOptional>>license<<endOptional>>""",
    "tmpl:cc-by-4.0": """Licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative Commons<<endOptional>> CC BY 4.0 <<beginOptional>>International<<endOptional>> <<beginOptional>>license<<endOptional>>""",
    "tmpl:mit-statement": """<<beginOptional>>This <<var;name="work";original="software";match=".{1,60}">> is<<endOptional>> released under the <<beginOptional>>terms of the<<endOptional>> MIT License""",
    "tmpl:mit": f"""
        <<beginOptional>>MIT License<<endOptional>> {_COPYRIGHT} Permission is hereby granted, free of charge, to any person obtaining a copy
        of <<var;name="software";original="this software and associated documentation files";match="this software and associated documentation files|this source file">>
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next
        paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        <<var;name="holder";original="THE AUTHORS OR COPYRIGHT HOLDERS";match=".{{1,200}}">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    "tmpl:isc": f"""
        <<beginOptional>>ISC License<<endOptional>> {_COPYRIGHT} Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this
        software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice
        appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="holder";original="THE AUTHOR";match=".{{1,200}}">> DISCLAIMS ALL WARRANTIES WITH REGARD TO
        THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
        <<var;name="liable";original="THE AUTHOR";match=".{{1,200}}">> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
        DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
        ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "tmpl:bsd": f"""
        {_COPYRIGHT} Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. <<beginOptional>><<beginOptional>>3.<<endOptional>> Neither the name of <<var;name="organization";original="the copyright holder";match=".{{1,200}}">>
        nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written
        permission.<<endOptional>>
        THIS SOFTWARE IS PROVIDED BY <<var;name="by";original="THE COPYRIGHT HOLDERS AND CONTRIBUTORS";match=".{{1,200}}">> "AS IS" AND ANY EXPRESS OR
        IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL <<var;name="liable";original="THE COPYRIGHT HOLDER OR CONTRIBUTORS";match=".{{1,200}}">> BE LIABLE FOR ANY
        DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
        ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "tmpl:unlicense": """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
        distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
        means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in
        the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
        software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
        <<beginOptional>>For more information, please refer to <<var;name="url";original="http://unlicense.org";match=".{1,60}">><<endOptional>>""",
    "tmpl:spdx-tag": """SPDX-License-Identifier: <<var;name="id";original="MIT";match="\\(?[a-z0-9][a-z0-9.+-]*(?: (?:or|and|with) [a-z0-9][a-z0-9.+-]*)*\\)?">>""",
}

_PART = re.compile(r'<<(beginOptional|endOptional|var)((?:;\w+="(?:[^"\\]|\\.)*")*)\s*>>|((?:(?!<<(?:beginOptional|endOptional|var)).)+)', re.S)
_MATCH = re.compile(r';match="((?:[^"\\]|\\.)*)"')
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def parts(template: str) -> Iterator[tuple[str, str]]:
    """("beginOptional" | "endOptional", ""), ("var", its expression) or ("", plain wording), in order."""
    at = 0
    for found in _PART.finditer(template):
        if found.start() != at:
            raise ValueError(f"unreadable markup: {template[at : at + 60]!r}")
        at = found.end()
        mark, options, plain = found.groups()
        if mark == "var":
            match = _MATCH.search(options)
            if not match:
                raise ValueError("a variable has no match")
            yield mark, match[1]
        elif mark or plain:
            yield mark or "", plain or ""
    if at != len(template):
        raise ValueError(f"unreadable markup: {template[at : at + 60]!r}")


@dataclass
class Spoken:
    """A text in lower case and its words' places: what a variable stands for is the text from a first to a last word."""

    data: bytes
    starts: list[int]
    ends: list[int]
    tokens: list[bytes]

    def between(self, at: int, to: int) -> bytes:
        return self.data[self.starts[at] : self.ends[to - 1]] if to > at else b""


def spoken(text: bytes) -> Spoken:
    """Of any UTF-8 text."""
    low = text.lower()
    found = list(_WORD.finditer(low))
    return Spoken(low, [m.start() for m in found], [m.end() for m in found], [m[0] for m in found])


@dataclass
class Automaton:
    """moves[state]: (word, next state); free[state]: states reached without a word; spans[state]: (expression, most bytes, next state). It starts at 0 and ends at `end`."""

    moves: list[list[tuple[bytes, int]]] = field(default_factory=lambda: [[]])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    spans: list[list[tuple[re.Pattern, int, int]]] = field(default_factory=lambda: [[]])
    end: int = 0

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        self.spans.append([])
        return len(self.moves) - 1

    def step(self, at: int, word: bytes) -> int:
        to = self.state()
        self.moves[at].append((word, to))
        return to

    def span(self, at: int, match: str) -> int:
        to, pattern = self.state(), re.compile(match.lower().encode(), re.S)
        self.spans[at].append((pattern, min(1 << 62, re._parser.parse(match).getwidth()[1]), to))
        return to

    def closure(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in out:
                    out.add(to)
                    todo.append(to)
        return out

    def next_words(self, state: int) -> set[bytes] | None:
        """The words that can follow state; None if the end or another variable can."""
        near = self.closure({state})
        return None if self.end in near or any(self.spans[s] for s in near) else {w for s in near for w, _ in self.moves[s]}

    def before(self, text: Spoken, hit: int) -> int:
        """How many words before word `hit` a match that holds it may start at most: all words of the template, and what its variables' most bytes have room for."""
        room = sum(most for edges in self.spans for _, most, _ in edges)
        first = hit
        while first and text.starts[hit] - text.ends[first - 1] <= room:
            first -= 1
        return min(hit, hit - first + len(self.moves))

    def longest(self, text: Spoken, at: int) -> int | None:
        """Where the longest match that starts at word `at` ends, or None."""
        found, n = None, len(text.tokens)
        ahead: dict[int, set[int]] = {at: {0}}
        while ahead:
            place = min(ahead)
            now, todo = set(), self.closure(ahead.pop(place))
            while todo:  # a variable may stand for nothing, which leads to more states of this place
                state = todo.pop()
                if state in now:
                    continue
                now.add(state)
                for pattern, most, to in self.spans[state]:
                    words = self.next_words(to)
                    last = place
                    while last <= n and (last == place or text.ends[last - 1] - text.starts[place] <= most):
                        if (words is None or last < n and text.tokens[last] in words) and pattern.fullmatch(text.between(place, last)):
                            if last == place:
                                todo |= self.closure({to})
                            else:
                                ahead.setdefault(last, set()).add(to)
                        last += 1
            if self.end in now:
                found = place
            if place < n:
                for state in now:
                    for word, to in self.moves[state]:
                        if word == text.tokens[place]:
                            ahead.setdefault(place + 1, set()).add(to)
        return found


def compile_template(text: str) -> Automaton:
    """Optional regions may nest; a region left open is an error."""
    out, at, opened = Automaton(), 0, []
    for mark, inside in parts(text):
        if mark == "beginOptional":
            opened.append(at)
        elif mark == "endOptional":
            if not opened:
                raise ValueError("an optional region ends that never began")
            # a state of its own, so that the way around ends with the region
            to = out.state()
            out.free[at].append(to)
            out.free[opened.pop()].append(to)
            at = to
        elif mark:
            at = out.span(at, inside)
        else:
            for word in _WORD.findall(inside.lower().encode()):
                at = out.step(at, word)
    if opened:
        raise ValueError("an optional region has no end")
    out.end = at
    return out


def anchor(text: str) -> tuple[tuple[bytes, ...], list[bytes] | None]:
    """The longest run of mandatory words, without which there is no match; and the words before it if these are all mandatory."""
    depth, runs, fixed = 0, [[]], [True]
    for mark, inside in parts(text):
        depth += (mark == "beginOptional") - (mark == "endOptional")
        if mark:
            runs.append([])
            fixed.append(False)
        elif not depth:
            runs[-1] += _WORD.findall(inside.lower().encode())
    best = max(range(len(runs)), key=lambda k: len(runs[k]))
    return tuple(runs[best]), [] if fixed[best] else None


_GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def _phrase(tokens: tuple[bytes, ...]) -> re.Pattern:
    """Where the words stand consecutively, in lower-case bytes."""
    return re.compile(rb"(?<![0-9a-z\x80-\xff])" + _GAP.join(map(re.escape, tokens)) + rb"(?![0-9a-z\x80-\xff])")


class Scanner:
    """labels: what each phrase or template is called. A phrase is looked for only where its rarest-looking word's bytes are found."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]) -> None:
        split = lambda p: tuple(_WORD.findall(p.lower().encode()))
        self.phrases = [(max(split(p), key=len), len(split(p)), _phrase(split(p)), label) for p, label in phrases.items()]
        self.templates = []
        for label, t in templates.items():
            run, fixed = anchor(t)
            if not run:
                raise ValueError(f"{label} has no mandatory wording")
            self.templates.append((max(run, key=len), _phrase(run), compile_template(t), fixed is not None, label))

    def scan(self, low: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """(first word, end word, label) of all phrases, and of the longest match of each template from each place."""
        base = [(int(np.searchsorted(starts, m.start())), n, label) for key, n, pattern, label in self.phrases if key in low for m in pattern.finditer(low)]
        base = [(at, at + n, label) for at, n, label in base]
        found: list[tuple[int, int, str]] = []
        text: Spoken | None = None
        for key, pattern, automaton, at_start, label in self.templates:
            if key not in low:
                continue
            hits = [int(np.searchsorted(starts, m.start())) for m in pattern.finditer(low)]
            if not hits:
                continue
            if text is None:
                text = Spoken(low, starts.tolist(), ends.tolist(), [low[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
            done = 0
            for hit in hits:
                # a match that holds this anchor starts at it, or no further back than the wording before it is long
                back = 0 if at_start else automaton.before(text, hit)
                for at in range(max(done, hit - back), hit + 1):
                    end = automaton.longest(text, at)
                    if end is not None and end > hit:
                        found.append((at, end, label))
                        done = end
                        break
        return base, found


@cache
def _scanner(phrases: tuple, templates: tuple) -> Scanner:
    return Scanner(dict(phrases), dict(templates))


def _covered(spans: list[tuple[int, int, str]]) -> int:
    n, to = 0, 0
    for s, e, _ in sorted(spans):
        n += max(0, e - max(s, to))
        to = max(to, e)
    return n


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """License phrases and templates in every whole text of docs (doc_id, text; other columns are ignored).

    Returns doc_id, n_words, n_base (places of phrases), first_word and last_word (their least and greatest start, null if
    none), base_labels and labels (distinct, sorted, comma-joined; "" if none), score (the share of words that phrases and
    matches cover) and spans (label, first and end word of each match). A null text is empty: no words, score 0. Repeated
    rows and null ids stay; an empty table gives no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    p, t = tuple(phrases.items()), tuple(templates.items())
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        scanner = _scanner(p, t)
        for batch in batches:
            for s in slices(batch.column("text")):
                low = LOWER[s.data]
                starts, ends, per = words(Texts(s.first, s.last, low, s.bounds))
                whole = low.tobytes()
                out = []
                for i in range(s.last - s.first):
                    at, to = int(s.bounds[i]), int(s.bounds[i + 1])
                    own = slice(per[i], per[i + 1])
                    base, found = scanner.scan(whole[at:to], starts[own] - at, ends[own] - at)
                    n = int(per[i + 1] - per[i])
                    places = [a for a, _, _ in base]
                    labels = {x for _, _, x in base}
                    every = sorted(labels | {x for _, _, x in found})
                    out.append((n, len(base), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(every), _covered(base + found) / n if n else 0.0, [{"label": x, "first": a, "end": e} for a, e, x in found]))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(s.first, s.last - s.first), *(pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, first: long, end: long>>")


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("spans").alias("n_templates"))
