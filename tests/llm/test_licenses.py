import re

import pytest

from capgrid.llm import licenses as L
from capgrid.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_pattern(template):
    """The template as a regular expression over space-terminated words."""
    out, at = "", 0
    literal = lambda t: "".join(re.escape(w) + " " for w in split(t))
    for m in re.finditer(r"<<(.*?)>>", template):
        out += literal(template[at : m.start()])
        at = m.end()
        if m[1] == "beginOptional":
            out += "(?:"
        elif m[1] == "endOptional":
            out += ")?"
        else:
            o = dict(x.split("=", 1) for x in m[1].split(";")[1:])
            out += f"(?:{'(?:' + o['match'] + ')' if 'match' in o else '[^ ]+'} ){{{o.get('min', 1)},{o.get('max', 12)}}}"
    return re.compile(r"(?:^|(?<= ))" + out + literal(template[at:]))


def brute(doc, text):
    w = split(text)
    line = "".join(x + " " for x in w)
    places, base = [], set()
    for phrase, label in L.BASE_PHRASES:
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += found
        if found:
            base.add(label)
    more = {label for label, template in L.TEMPLATES if brute_pattern(template).search(line)}
    return doc, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if more else 0.5 if base else 0.0


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted((r["doc_id"], *(r[c] for c in COLUMNS)) for r in QUERIES["op2_license_scan"](spark, sf).collect())
    want = sorted(brute(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert got == want
    assert any(g[-1] == 1.0 for g in got)


MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
    "the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)


def test_odd_rows_and_full_texts(spark, odd_docs):
    whole = MIT + MIT_END
    texts = [whole, whole.replace("free of charge", "free of any charge"), "x " * 5000 + whole + " y" * 5000, "MIT License CC BY MIT license", "licensed under the gnu general public license version 3 apache license"]
    docs = odd_docs.select("doc_id", "text").unionAll(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string"))
    got = sorted(((r["id"], *(r[c] for c in COLUMNS)) for r in L.scan(docs).collect()), key=repr)
    assert got == sorted((brute(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    by_id = {g[0]: g for g in got}
    assert by_id[100][6] == "mit" and by_id[101][6] == "" and by_id[102][6] == "mit"
    assert L.scan(odd_docs.limit(0)).count() == 0


def test_automaton_agrees_with_regular_expressions():
    import random

    rng = random.Random(1)
    templates = (("t", "a <<var;min=1;max=3>> b"), ("u", "c <<beginOptional>>d <<var;match=\\d+;min=0;max=2>><<endOptional>> e"), ("v", "<<beginOptional>>a<<endOptional>> <<var;match=c|d;max=1>> e e"))
    automaton = L.Automaton(templates)
    for _ in range(3000):
        w = [rng.choice(["a", "b", "c", "d", "e", "1", "22"]) for _ in range(rng.randrange(9))]
        line = "".join(x + " " for x in w)
        got = {t for t, _, _ in automaton.run([x.encode() for x in w])}
        assert got == {i for i, (_, t) in enumerate(templates) if brute_pattern(t).search(line)}, w


def test_bad_markup_is_refused():
    for template in ("a <<endOptional>>", "a <<beginOptional>> b", "a <<what>> b", "<<var>>"):
        with pytest.raises(ValueError):
            L.Automaton((("x", template),))


CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain "
    "the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND '
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
    'all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT '
    "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
MIT_END = (
    '\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND '
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF "
    "OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
GPL = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."


def test_whole_texts_and_altered_disclaimers(spark):
    cases = [
        (CONDITIONS + BSD_END, "bsd-2-clause", 1.0), (CONDITIONS + THIRD + BSD_END, "bsd-3-clause", 1.0), (CONDITIONS, "", 0.0), (CONDITIONS + BSD_END.replace("NEGLIGENCE", "CARE"), "", 0.0),
        (ISC, "isc", 1.0), (ISC.replace("NO EVENT", "ANY EVENT"), "", 0.0), (ISC[: ISC.index("THE SOFTWARE IS")], "", 0.0),
        (MIT + MIT_END, "mit", 1.0), (MIT + MIT_END.replace("WITHOUT WARRANTY", "WITH WARRANTY"), "", 0.0), (MIT + MIT_END[:-20], "", 0.0), (MIT, "", 0.0),
        (GPL, "gpl,gpl-2.0", 1.0), (GPL.replace("version 2", "version 9"), "gpl", 0.5),
    ]
    docs = spark.createDataFrame([(i, "Copyright 2020 Someone\n\n" + t + "\n\nend") for i, (t, _, _) in enumerate(cases)], "doc_id bigint, text string")
    rows = sorted(L.scan(docs).collect(), key=lambda r: r["id"])
    assert [(r["labels"], r["score"]) for r in rows] == [c[1:] for c in cases]
    words = split("Copyright 2020 Someone " + MIT + MIT_END)
    assert [(m["first"], m["last"]) for m in rows[7]["matches"]] == [(3, len(words) - 1)]
