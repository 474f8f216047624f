"""License scans by template markup.

A template is a license's wording with three kinds of markup: [[ ]] encloses words that may be missing, << | >> wordings of which one
must be there, and {{n}} stands for 1 to n words of any kind (a name, a year, a list of holders). Each template becomes a token automaton. It accepts
a stretch of words if all wording outside the markup is there, in order and word for word.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

#: Phrases that count wherever their words stand one after the other, and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Public license wording, with markup. A license's notice, which points to the license, and its whole text are templates of their own.
TEMPLATES = {
    "mit": (
        "under the [[terms of the]] mit license",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice [[(including the next paragraph)]] shall be included in all
        copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL {{12}} BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
        FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE""",
    ),
    "apache-2": (
        "licensed under the [[terms of the]] apache license version 2",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at [[http]] [[https]] {{8}} Unless required by applicable law or agreed to
        in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License""",
        """Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide,
        non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of,
        publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object
        form. [[3]] [[Grant of Patent License]] Subject to the terms and conditions of this License, each Contributor hereby grants to You a
        perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (except as stated in this section) patent
        license to make, have made, use, offer to sell, sell, import, and otherwise transfer the Work""",
    ),
    "gpl-2": (
        """{{6}} is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License
        as published by the Free Software Foundation; [[either]] version 2 of the License [[or (at your option) any later version]].
        {{6}} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details""",
    ),
    "gpl-3": (
        "licensed under the [[terms of the]] gnu general public license [[v3]] version 3",
        """{{6}} is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
        as published by the Free Software Foundation, [[either]] version 3 of the License [[or (at your option) any later version]].
        {{6}} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details""",
    ),
    "lgpl": (
        """{{6}} is free software; you can redistribute it and/or modify it under the terms of the GNU <<Lesser|Library>> General
        Public License as published by the Free Software Foundation; [[either]] version {{3}} of the License [[or (at your option) any
        later version]]. {{6}} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU <<Lesser|Library>> General Public License for more details.
        You should have received a copy of the GNU <<Lesser|Library>> General Public License along with""",
    ),
    "agpl-3": (
        """{{6}} is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License
        as published by the Free Software Foundation, [[either]] version 3 of the License [[or (at your option) any later version]].
        {{6}} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details""",
    ),
    "mpl-2": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at [[http]] [[https]] [[www]] mozilla.org/MPL/2.0""",
    ),
    "cc-by-4": (
        "licensed under [[a]] [[the]] creative commons attribution 4 0 international license",
        """You are free to: Share copy and redistribute the material in any medium or format [[for any purpose, even commercially]] Adapt remix, transform,
        and build upon the material for any purpose, even commercially. {{14}} Under the following terms: Attribution You must give appropriate
        credit, provide a link to the license, and indicate if changes were made. You may do so in any reasonable manner, but not in any way that
        suggests the licensor endorses you or your use. No additional restrictions""",
    ),
    "cc-by-sa-4": (
        "licensed under [[a]] [[the]] creative commons attribution sharealike 4 0 international license",
        """You are free to: Share copy and redistribute the material in any medium or format [[for any purpose, even commercially]] Adapt remix, transform,
        and build upon the material for any purpose, even commercially. {{14}} Under the following terms: Attribution You must give appropriate
        credit, provide a link to the license, and indicate if changes were made. You may do so in any reasonable manner, but not in any way that
        suggests the licensor endorses you or your use. ShareAlike If you remix, transform, or build upon the material, you must distribute your
        contributions under the same license as the original""",
    ),
    "cc-by-nc-4": (
        "licensed under [[a]] [[the]] [[creative commons]] cc by nc 4",
        "licensed under [[a]] [[the]] creative commons attribution noncommercial 4 0",
    ),
    "isc": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND {{8}} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {{8}} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE""",
    ),
    "bsd": (
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: [[1]] Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. [[2]] Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. [[[[3]] Neither the name of {{12}} nor the names of its contributors may
        be used to endorse or promote products derived from this software without specific prior written permission.]]
        THIS SOFTWARE IS PROVIDED BY {{12}} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {{12}} BE LIABLE
        FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
        AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
        ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE""",
    ),
    "zlib": (
        """This software is provided 'as-is', without any express or implied warranty. In no event will {{8}} be held liable
        for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
        purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: [[1]] The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. [[2]] Altered source versions must be plainly marked as such, and must not be misrepresented as being the
        original software. [[3]] This notice may not be removed or altered from any source distribution""",
    ),
    "bsl-1": (
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
        and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
        Software is furnished to do so, all subject to the following""",
    ),
    "unlicense": (
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means""",
    ),
}

#: What is no word: control characters, ASCII punctuation and white space. Capital letters are lower-cased before.
_BREAK = bytes(x if x > 0x7F or chr(x).isdigit() or 0x61 <= x <= 0x7A else 0x20 for x in range(256))


def words(text: bytes) -> list[bytes]:
    return text.lower().translate(_BREAK).split()


class Automaton:
    """States 0..n; a state's moves are a word or any word to one state, and free moves."""

    def __init__(self, template: str):
        self.word, self.any, self.free, self.longest = {}, {}, {0: []}, 0
        run, runs, depth, opened, state = [], [], 0, [], 0

        def new() -> int:
            self.free[len(self.free)] = []
            return len(self.free) - 1

        choices = []
        for part in re.findall(r"\[\[|\]\]|<<|>>|\||\{\{\d+\}\}|[^\[\]{}<>|]+", template):
            if part == "[[":
                opened.append(state)
                depth, run, runs = depth + 1, [], [*runs, run]
            elif part == "]]":
                depth -= 1
                end = new()
                self.free[state].append(end)
                self.free[opened.pop()].append(end)
                state, run = end, []
            elif part in ("<<", "|"):
                if part == "<<":
                    choices.append((state, []))
                    depth, run, runs = depth + 1, [], [*runs, run]
                else:
                    choices[-1][1].append(state)
                state = new()
                self.free[choices[-1][0]].append(state)
            elif part == ">>":
                depth, run, end = depth - 1, [], new()
                for s in (*choices.pop()[1], state):
                    self.free[s].append(end)
                state = end
            elif part[0] == "{":
                runs, run, stops = [*runs, run], [], []
                for _ in range(int(part[2:-2])):
                    self.any[state] = nxt = new()
                    state, self.longest = nxt, self.longest + 1
                    stops.append(nxt)
                end = new()
                for s in stops:
                    self.free[s].append(end)
                state = end
            else:
                for w in words(part.encode()):
                    nxt = new()
                    self.word[state] = (w, nxt)
                    state, self.longest = nxt, self.longest + 1
                    if not depth:
                        run.append(w)
        self.final = state
        #: The longest wording that every accepted stretch holds.
        self.needed = b" " + b" ".join(max([*runs, run], key=lambda r: len(b" ".join(r)))) + b" "

    def closed(self, states) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for n in self.free[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return seen

    def accepts(self, text: list[bytes], starts: list[tuple[int, int]]) -> bool:
        """True if a stretch of words is accepted that begins in one of the ranges (first, last), which are in order and apart.

        All starts share one set of states, so a text is read once however many there are.
        """
        first, states, k = self.closed([0]), set(), 0
        at = starts[0][0] if starts else 0
        while k < len(starts):
            if not states:
                at = max(at, starts[k][0])
            if starts[k][0] <= at <= starts[k][1]:
                states = states | first
            if self.final in states:
                return True
            if at >= len(text):
                return False
            w = text[at]
            states = self.closed({n for s in states for x, n in [self.word.get(s, (None, 0))] if x == w} | {self.any[s] for s in states if s in self.any})
            at += 1
            while k < len(starts) and at > starts[k][1] and (not states or k + 1 < len(starts)):
                k += 1
        return self.final in states


def places(joined: bytes, phrase: bytes) -> list[int]:
    """The word numbers where the space-enclosed phrase stands in the space-enclosed text."""
    out, at, word, counted = [], joined.find(phrase), 0, 0
    while at >= 0:
        word += joined.count(b" ", counted, at)
        counted = at
        out.append(word)
        at = joined.find(phrase, at + 1)
    return out


class Scanner:
    def __init__(self, phrases=PHRASES, templates=None):
        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases]
        self.automata = [(label, Automaton(t)) for label, ts in (templates or TEMPLATES).items() for t in ts]

    def scan(self, text: bytes) -> tuple:
        """(n_words, n_base, first_word, last_word, base_labels, labels, score)"""
        found = words(text)
        joined = b" " + b" ".join(found) + b" "
        base = [(at, label) for p, label in self.phrases for at in places(joined, p)]
        own = {label for label, a in self.automata if self._holds(a, found, joined)}
        names = {label for _, label in base}
        at = [a for a, _ in base]
        score = 1.0 if own else 0.5 if base else 0.0
        return len(found), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(names)), ",".join(sorted(names | own)), score

    @staticmethod
    def _holds(automaton: Automaton, found: list[bytes], joined: bytes) -> bool:
        starts: list[tuple[int, int]] = []
        for at in places(joined, automaton.needed):
            lo = max(0, at - automaton.longest)
            if starts and lo <= starts[-1][1] + 1:
                starts[-1] = (starts[-1][0], at)
            else:
                starts.append((lo, at))
        return automaton.accepts(found, starts)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    A-Z are lower-cased; words are runs of a-z, 0-9 and characters beyond ASCII. n_base counts the places where a
    phrase's words stand one after the other; first_word and last_word are the smallest and largest of them, words
    from 0, else null. labels joins the phrases' labels and those of templates that accept a stretch of the words,
    sorted, by commas. score is 1 with an accepted template, 0.5 with phrases alone, else 0. Null texts count as
    empty: no words, empty labels. Long texts are scanned whole. Repeated rows and null ids stay. Extra columns are ignored, whatever their names; an empty table gives no rows.
    """
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

    def run(batches):
        import pyarrow as pa

        scanner, kinds = Scanner(phrases, templates), (pa.int64(),) * 4 + (pa.string(), pa.string(), pa.float64())
        for batch in batches:
            if batch.num_rows:
                columns = zip(*map(scanner.scan, text_bytes(batch.column(1))))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", *names])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
