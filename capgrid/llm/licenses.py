"""License scans by template-markup matching.

A template is license wording with markup: `<<beginOptional>>...<<endOptional>>`
may be left out, and `<<var;match=REGEX;min=N;max=N>>` stands for N to N words
that each match the expression (default: 1 to 12 of any words).  All other
wording is mandatory and must match word for word.  Templates compile into
one automaton over words: optional regions are branches around their words,
replaceable regions bounded runs of any-word steps.  Its subset states are
built as texts need them, so scanning a word is one table look-up.

Texts of licenses run through their disclaimers.  Notices that name a license (such as the GPL's) end at its version.

A text is scanned only if it holds the rarest mandatory word of some template
or base phrase; all its start places are tried.

Defined results.  Null and empty texts have no words, labels or score
(`labels` empty, score 0).  Repeated rows are scanned each; ids may be null;
columns other than the id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capgrid.llm import common, textscan

#: Phrases whose every place is counted, and their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "<<var;match=\\d+;min=0;max=1>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "<<var;match=\\d+;min=0;max=1>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. "
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY <<var>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
    "ARE DISCLAIMED. IN NO EVENT SHALL <<var>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL <<var>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)

#: Public license notices and texts, with markup for what may vary.
TEMPLATES = (
    ("apache-2.0", "<<beginOptional>>this work is<<endOptional>> licensed under the Apache License, Version 2.0"),
    ("gpl-2.0", "licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License, <<beginOptional>>as published by the Free Software Foundation<<endOptional>> version 2"),
    ("gpl-3.0", "licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License, <<beginOptional>>as published by the Free Software Foundation<<endOptional>> version 3"),
    ("mit", "<<var;match=released|licensed|distributed|available;max=1>> under the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    ("cc-by-4.0", "licensed under <<beginOptional>>a<<endOptional>> CC BY 4.0"),
    ("cc-by-sa-4.0", "licensed under <<beginOptional>>a<<endOptional>> CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "licensed under <<beginOptional>>a<<endOptional>> CC BY-NC 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;max=8>> and associated documentation files <<beginOptional>>(the \"Software\")<<endOptional>>, "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software. "
        + _MIT_DISCLAIMER,
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND <<var>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL <<var>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("bsd-2-clause", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    (
        "bsd-3-clause",
        _BSD_CONDITIONS + "<<var;match=\\d+;min=0;max=1>> Neither the name of <<var>> nor the names of <<var;max=6>> contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission. " + _BSD_DISCLAIMER,
    ),
    (
        "gpl-2.0",
        "This <<var;max=6>> is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; "
        "<<beginOptional>>either<<endOptional>> version 2 of the License",
    ),
    (
        "gpl-3.0",
        "This <<var;max=6>> is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "<<beginOptional>>either<<endOptional>> version 3 of the License",
    ),
)

_MARK = re.compile(r"<<(.*?)>>", re.S)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def split_words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


@dataclass
class Program:
    """Steps of the automaton: ("word", w, next), ("any", regex or None, next), ("fork", a, b) or ("accept", template)."""

    steps: list[tuple] = field(default_factory=list)

    def put(self, *step) -> int:
        self.steps.append(step)
        return len(self.steps) - 1


def _parse(template: str) -> list:
    """Nested list of words, optional parts and replaceable runs."""
    root: list = []
    stack = [root]
    at = 0
    for m in _MARK.finditer(template):
        stack[-1] += split_words(template[at : m.start()])
        at = m.end()
        kind, *options = m[1].split(";")
        if kind == "beginOptional":
            part: list = []
            stack[-1].append(("optional", part))
            stack.append(part)
        elif kind == "endOptional":
            if len(stack) == 1:
                raise ValueError("endOptional without beginOptional")
            stack.pop()
        elif kind == "var":
            given = dict(o.split("=", 1) for o in options)
            stack[-1].append(("var", given.get("match"), int(given.get("min", 1)), int(given.get("max", 12))))
        else:
            raise ValueError(f"unknown markup {m[0]!r}")
    if len(stack) > 1:
        raise ValueError("beginOptional without endOptional")
    root += split_words(template[at:])
    return root


def mandatory(parts: list) -> list[bytes]:
    return [p for p in parts if isinstance(p, bytes)]


class Automaton:
    """One automaton for all templates; `run` gives every accepted (template, first word, last word)."""

    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.labels = [label for label, _ in templates]
        parsed = [_parse(text) for _, text in templates]
        for label, parts in zip(self.labels, parsed):
            if not mandatory(parts):
                raise ValueError(f"template {label} has no mandatory wording")
        self.needed = {max(mandatory(parts), key=len) for parts in parsed}
        self.program = Program()
        heads = [self._compile(parts, self.program.put("accept", i)) for i, parts in enumerate(parsed)]
        self.start = self._close(heads)
        self.moves: dict[tuple[frozenset, bytes], frozenset] = {}

    def _compile(self, parts: list, after: int) -> int:
        """Steps for `parts` that go on to `after`; built from the back."""
        put = self.program.put
        for p in reversed(parts):
            if isinstance(p, bytes):
                after = put("word", p, after)
            elif p[0] == "optional":
                after = put("fork", self._compile(p[1], after), after)
            else:
                rule = re.compile(p[1].encode()) if p[1] else None
                end = after
                for i in range(p[3]):
                    step = put("any", rule, after)
                    after = put("fork", step, end) if p[3] - i > p[2] else step
        return after

    def _close(self, steps) -> frozenset:
        found, todo = set(), list(steps)
        while todo:
            s = todo.pop()
            if s in found:
                continue
            found.add(s)
            if self.program.steps[s][0] == "fork":
                todo += self.program.steps[s][1:]
        return frozenset(s for s in found if self.program.steps[s][0] != "fork")

    def move(self, state: frozenset, word: bytes) -> frozenset:
        key = state, word
        got = self.moves.get(key)
        if got is None:
            steps = self.program.steps
            got = self._close(steps[s][2] for s in state if steps[s][0] == "word" and steps[s][1] == word or steps[s][0] == "any" and (steps[s][1] is None or steps[s][1].fullmatch(word)))
            if len(self.moves) > 200_000:
                self.moves.clear()
            self.moves[key] = got
        return got

    def run(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        out = []
        for i, w in enumerate(words):
            if self.move(self.start, w):
                out += self.run_at(words, i)
        return out

    def ends(self, words: list[bytes], first: int) -> list[int]:
        """Last words of what is accepted from word `first` on."""
        return [last for _, _, last in self.run_at(words, first)]

    def run_at(self, words: list[bytes], i: int) -> list[tuple[int, int, int]]:
        out = []
        if i < len(words):
            state, j = self.move(self.start, words[i]), i
            while state:
                out += [(self.program.steps[s][1], i, j) for s in state if self.program.steps[s][0] == "accept"]
                j += 1
                if j == len(words):
                    break
                state = self.move(state, words[j])
        return out


def phrase_places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    out, at = [], -1
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return out
        if words[at : at + len(phrase)] == phrase:
            out.append(at)


def scan(docs: DataFrame, templates=TEMPLATES, phrases=BASE_PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches).

    Labels are distinct, sorted and comma-joined; `labels` adds those of accepted
    templates.  score is 1 with an accepted template, 0.5 with a base phrase
    alone, else 0.  matches lists (label, first word, last word).
    """
    match = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(templates)
        base = [(split_words(p), label) for p, label in phrases]
        needed = automaton.needed | {max(p, key=len) for p, _ in base}
        for batch in batches:
            for at, texts in common.byte_lists(batch.column(1), 1 << 22):
                rows = []
                for text in texts:
                    raw = text.lower()
                    starts, ends = textscan.spans(np.frombuffer(raw, np.uint8), textscan.ALNUM)
                    places, own, matches = [], set(), []
                    if any(n in raw for n in needed):
                        words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                        for phrase, label in base:
                            if found := phrase_places(words, phrase):
                                own.add(label)
                                places += found
                        matches = sorted((automaton.labels[t], a, b) for t, a, b in automaton.run(words))
                    both = own | {m[0] for m in matches}
                    rows.append((len(starts), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(own)), ",".join(sorted(both)), 1.0 if matches else 0.5 if own else 0.0, [dict(zip(("label", "first", "last"), m)) for m in matches]))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(match))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *columns], ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(
        run,
        f"id {slim.schema['id'].dataType.simpleString()}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, matches array<struct<label:string,first:bigint,last:bigint>>",
    )
