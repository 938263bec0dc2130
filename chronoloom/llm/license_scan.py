"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

Templates are license texts as a whole, and the grants, headers and notices that stand for them in files. A block is a
stretch of consecutive words across line ends, up to SLACK per cent or BETWEEN words longer than the template, whichever is
more, for names and years within. It meets a template if it holds at least `percent` per cent of the template's distinct
words, all of its distinctive words among them; it meets a template of fewer than SHORT words, which say little in another
order, if it holds all of its words in order. Distinctive words of a template are those that a template much like it lacks (at least `percent` per cent of the
one's words are the other's): they tell versions of one license apart.

Words are ordered by how many documents of the whole corpus hold them, rarest first, ties by the word. A block that
meets a template of n words holds one of the first n - need + 1 in that order (prefix filter), so only blocks around
those are looked at; the text has at least need words (length filter); and within a block's reach of the prefix word
there are at least need places of template words (positional filter). What passes is compared whole by a window that
slides over the places of template words, so the result is exact.

Templates are few and given by the caller (their size is checked), and so are the counts of their words: both travel
with the code. Everything else is one pass over the texts for the counts and one for the join.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case.

Defined results: null and empty texts have no words, places or labels; a phrase may overlap itself or others, and all
places count; where two templates meet one block and all words of one are the other's, the larger is meant; repeated
rows are scanned each; an empty table gives an empty result; extra columns are not looked at. Very long texts are
scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.hashing import slim_batches

NOT_WORD = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}

#: phrase -> label. Fixed values.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label -> template: grants, headers and notices as licenses ask for them. Fixed values.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "gpl-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-2.1": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "all-rights-reserved": "copyright all rights reserved",
    "cc-by-nd": "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
}
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: label -> whole license text, without the line that names a holder and a year. Fixed values.
TEXTS = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd-2": f"{_BSD_GRANT}\n{_BSD_WARRANTY}",
    "bsd-3": f"{_BSD_GRANT}\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n{_BSD_WARRANTY}",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    "boost": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.""",
    "apache-2": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
}
PERCENT, SLACK, BETWEEN, SHORT, MOST_TEMPLATE_WORDS = 80, 25, 8, 8, 100_000


def words_of(text: str) -> str:
    """The words, joined by one space."""
    return NOT_WORD.sub(" ", text.translate(UPPER) if not text.isascii() else text.lower()).strip(" ")


def places(words: str, phrase: str) -> list[int]:
    """Where, in words from 0, a phrase's words stand consecutively."""
    words, phrase, found, at = f" {words} ", f" {phrase} ", [], -1
    counted, place = 0, 0
    while (at := words.find(phrase, at + 1)) >= 0:
        place += words.count(" ", counted, at)
        counted = at
        found.append(place)
    return found


def document_counts(docs: DataFrame, vocabulary: frozenset[str]) -> DataFrame:
    """(word, n): how many documents of the corpus hold each word of the vocabulary."""

    def counted(parts):
        for batch in parts:
            n = Counter()
            for text in batch.column(0):
                n.update(vocabulary.intersection(words_of(text.as_py() or "").split(" ")))
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    return docs.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Template:
    """every: the words in order; a short template needs them all, a longer one a share of its distinct ones."""

    def __init__(self, label: str, every: list[str], order: dict[str, int], percent: int):
        self.label, self.every, self.words, self.ordered = label, every, frozenset(every), len(every) < SHORT
        self.need = len(self.words) if self.ordered else -(-len(self.words) * percent // 100)
        self.reach = max(len(every) * (100 + SLACK) // 100, len(every) + BETWEEN)
        self.prefix = frozenset(sorted(self.words, key=order.__getitem__)[: len(self.words) - self.need + 1])
        self.own: frozenset[str] = frozenset()


class Join:
    """Templates prepared for blocks in the global order of words."""

    def __init__(self, templates: list[tuple[str, list[str]]], order: dict[str, int], percent: int):
        self.templates = [Template(label, every, order, percent) for label, every in templates]
        for t in self.templates:
            like = [u for u in self.templates if u is not t and 100 * len(t.words & u.words) >= percent * len(t.words)]
            t.own = frozenset().union(*(t.words - u.words for u in like))
        self.prefixes = frozenset().union(*(t.prefix for t in self.templates))
        self.vocabulary = frozenset().union(*(t.words for t in self.templates))

    def __call__(self, words: list[str]) -> list[tuple[str, int, int, float]]:
        """(label, first word, words, share) of the best block of each place that meets a template."""
        places = [(i, w) for i, w in enumerate(words) if w in self.vocabulary]
        present = {w for _, w in places}
        met = []
        for t in self.templates:
            if len(words) < t.need or t.prefix.isdisjoint(present) or not t.own <= present or len(t.words & present) < t.need:
                continue
            own = [(i, w) for i, w in places if w in t.words]
            if t.ordered:
                met += [(t, first, last - first + 1, 1.0) for first, last in self.in_order(own, t)]
                continue
            at = [i for i, _ in own]
            done, end = -1, -1
            for x in (i for i, w in own if w in t.prefix):
                if x < end:  # within a block that met
                    continue
                low, high = max(done + 1, bisect_left(at, x - t.reach + 1)), bisect_left(at, x + t.reach)
                if high - low < t.need:
                    continue
                best = self.best(own, low, high, t)
                if best:
                    share, first, last = best
                    met.append((t, at[first], at[last] - at[first] + 1, share))
                    done, end = last, at[last]
        inside = lambda m: any(m[0].words < o[0].words and o[1] < m[1] + m[2] and m[1] < o[1] + o[2] for o in met)
        return [(t.label, first, n, share) for t, first, n, share in met if not inside((t, first, n, share))]

    @staticmethod
    def in_order(own: list[tuple[int, str]], t: Template):
        """(first, last) of the stretches of at most t.reach words that hold the template's words in its order. begun[k] is
        the latest start of a run of the first k words so far, so that stretches are as short as can be."""
        begun: list[int | None] = [None] * (len(t.every) + 1)
        for i, w in own:
            for k in range(len(t.every) - 1, -1, -1):
                if t.every[k] == w and (k == 0 or begun[k] is not None):
                    begun[k + 1] = i if k == 0 else begun[k]
            if begun[-1] is not None:
                if i - begun[-1] < t.reach:
                    yield begun[-1], i
                    begun = [None] * len(begun)
                else:
                    begun[-1] = None

    @staticmethod
    def best(own, low: int, high: int, t: Template):
        """The (share, first, last) of the window of at most t.reach words with most distinct words, the earliest of equals."""
        held, first, found = Counter(), low, None
        for last in range(low, high):
            held[own[last][1]] += 1
            while own[last][0] - own[first][0] >= t.reach or held[own[first][1]] > 1:
                w = own[first][1]
                held[w] -= 1
                if not held[w]:
                    del held[w]
                first += 1
            if len(held) >= t.need and t.own <= held.keys() and not t.prefix.isdisjoint(held) and (found is None or len(held) > found[0]):
                found = (len(held), first, last)
        return found and (found[0] / len(t.words), found[1], found[2])


def license_scan(docs: DataFrame, phrases=PHRASES, templates=(TEMPLATES, TEXTS), percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base (places of all phrases), first_word and last_word (smallest and largest start,
    else null), base_labels and labels (distinct, sorted, comma-joined; labels has the join's too; templates are one or more
    tables of label and text), score (the largest
    share of a template in one block, 1 where a phrase stands, else 0), and blocks (label, first, words, share) that met."""
    listed = [(label, words_of(text).split(" ")) for some in ([templates] if isinstance(templates, dict) else templates) for label, text in some.items()]
    vocabulary = frozenset(w for _, every in listed for w in every)
    if len(vocabulary) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"the templates have {len(vocabulary)} words; {MOST_TEMPLATE_WORDS} at most go with the code")
    slim_batches(docs.sparkSession)
    counts = {r["word"]: r["n"] for r in document_counts(docs.select(F.col(text_col).alias("text")), vocabulary).collect()}  # a row for each template word at most
    order = {w: i for i, (_, w) in enumerate(sorted((counts.get(w, 0), w) for w in vocabulary))}
    join = Join(listed, order, percent)

    def scanned(parts):
        for batch in parts:
            out = [[] for _ in range(8)]
            for text in batch.column(1):
                text = text.as_py() or ""
                words = words_of(text)
                starts, base = [], set()
                for phrase, label in phrases.items():
                    if phrase in words and (found := places(words, phrase)):
                        starts += found
                        base.add(label)
                # A text without a word of a prefix cannot meet: it is passed over at once.
                each = words.split(" ")
                blocks = [] if join.prefixes.isdisjoint(each) else join(each)
                met = {label: max(b[3] for b in blocks if b[0] == label) for label in {b[0] for b in blocks}}
                blocks = [dict(zip(("label", "first", "words", "share"), b, strict=True)) for b in blocks]
                for column, value in zip(out, (words.count(" ") + 1 if words else 0, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(met))), max([1.0 if base else 0.0, *met.values()]), blocks), strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64()), ("share", pa.float64())]))]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out, kinds)], names=names)

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, blocks array<struct<label string, first long, words long, share double>>"
    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(scanned, schema)
