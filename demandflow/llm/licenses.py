"""License scan: templates with optional and replaceable regions as token automata.

Template markup: plain words are mandatory; ``[[ ... ]]`` is optional;
``{{n}}`` stands for up to n words of any kind. A template compiles into a
nondeterministic automaton over words (``ALNUM`` runs, ASCII lower case);
punctuation and white space do not matter. It accepts a place in a text if the
words from there on match all its mandatory words, exactly and in order.

Templates begin with mandatory words: these are looked up for all words of a
batch at once, and automata run only from where they occur.

``FULL_TEMPLATES`` hold whole licenses (MIT, ISC, BSD with two and three clauses)
and Apache's file header; ``NOTICES`` only the sentences that name a license.

Defined results: null and empty texts have no words, places or labels and
score 0; a very long text is scanned as a whole; all places count, those inside other places too; repeated rows are
scanned each; null ids stay null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .store import ship_code

SLICE_BYTES = 4 << 20
_ANCHOR = 3

#: label, template. Fixed wording of common license notices.
BASE_TEMPLATES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
#: whole wording: texts that change, leave out or add mandatory words are not accepted
_BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
[[ 1 ]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
[[ 2 ]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
in the documentation and or other materials provided with the distribution"""
_BSD_NAMES = """[[ 3 ]] neither the name of {{12}} nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission"""
_BSD_DISCLAIMER = """this software is provided by {{12}} as is and any express or implied warranties including but not limited to the implied warranties of
merchantability and fitness for a particular purpose are disclaimed in no event shall {{12}} be liable for any direct indirect incidental special exemplary
or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption
however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of
the use of this software even if advised of the possibility of such damage"""
FULL_TEMPLATES = [
    ("mit", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the {{2}} to deal in the
     {{2}} without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the {{2}} and
     to permit persons to whom the {{2}} is furnished to do so subject to the following conditions the above copyright notice and this permission notice
     [[ including the next paragraph ]] shall be included in all copies or substantial portions of the {{2}} the {{2}} is provided as is without warranty of any
     kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event
     shall the {{6}} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection
     with the {{2}} or the use or other dealings in the {{2}}"""),
    ("isc", """permission to use copy modify [[ and ]] [[ or ]] distribute this software for any purpose with or without fee is hereby granted provided that the above
     copyright notice and this permission notice appear in all copies the software is provided as is and {{6}} disclaims all warranties with regard to this
     software including all implied warranties of merchantability and fitness in no event shall {{6}} be liable for any special direct indirect or consequential
     damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising
     out of or in connection with the use or performance of this software"""),
    ("bsd-2-clause", f"{_BSD} {_BSD_DISCLAIMER}"),
    ("bsd-3-clause", f"{_BSD} {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    ("apache-2.0", """licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license you may obtain a copy of the
     license at {{8}} unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without
     warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"""),
]
#: notices that name a license whose wording is elsewhere
NOTICES = [
    ("apache-2.0", "licensed under the apache license [[ version ]] 2.0"),
    ("mit", "released under the [[ terms of the ]] mit license"),
    ("mit", "licensed under the [[ terms of the ]] mit license"),
    ("gpl-3", "licensed under the gnu general public license [[ , ]] version 3"),
    ("gpl-2", "licensed under the gnu general public license [[ , ]] version 2"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu [[ lesser ]] [[ affero ]] general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license [[ v ]] [[ version ]] 2.0"),
    ("mpl-2.0", "licensed under the mozilla public license [[ v ]] [[ version ]] 2.0"),
    ("cc-by-nc-4.0", "licensed under [[ a ]] [[ the ]] cc by nc 4.0"),
    ("cc-by-4.0", "licensed under [[ a ]] [[ the ]] cc by 4.0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4.0 international license"),
    ("cc0", "to the extent possible under law {{12}} has waived all copyright and related or neighboring rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("spdx", "spdx license identifier {{1}}"),
    ("proprietary", "copyright {{10}} all rights reserved"),
]
TEMPLATES = FULL_TEMPLATES + NOTICES


def _hashes(text: str) -> list[int]:
    return T.words(pa.array([text]), T.ALNUM, True)[0].tolist()


@dataclass
class Automaton:
    """States in template order; state i reads ``reads[i]`` (None: any word) and moves to i + 1, or to a state of ``skips[i]`` unread."""

    label: str
    base: bool
    reads: list[int | None]
    skips: list[list[int]]
    done: list[int]  # mandatory words behind each state

    @classmethod
    def compile(cls, label: str, template: str, base: bool) -> Automaton:
        reads: list[int | None] = []
        jumps: list[tuple[int, int]] = []
        mandatory, opened = [], None
        for piece in template.split():
            if piece == "[[":
                opened = len(reads)
            elif piece == "]]":
                jumps.append((opened, len(reads)))
                opened = None
            elif piece.startswith("{{"):
                for _ in range(int(piece[2:-2])):
                    jumps.append((len(reads), len(reads) + 1))
                    reads.append(None)
                    mandatory.append(0)
            else:
                for h in _hashes(piece):
                    reads.append(h)
                    mandatory.append(int(opened is None))
        skips: list[list[int]] = [[] for _ in range(len(reads) + 1)]
        for a, b in jumps:
            if a != b:
                skips[a].append(b)
        return cls(label, base, reads, skips, [0, *np.cumsum(mandatory).tolist()])

    def anchor(self) -> list[int]:
        """The words every match begins with, ``_ANCHOR`` at most."""
        n = next((i for i, r in enumerate(self.reads) if r is None or self.skips[i]), len(self.reads))
        return self.reads[:min(n, _ANCHOR)]

    def run(self, h: np.ndarray, at: int, stop: int) -> tuple[int | None, float]:
        """(end of the longest match that starts at ``at``, or None; share of the mandatory words that were read)."""
        last, end, most = len(self.reads), None, 0
        states = self._closure({0})
        while states:
            most = max(most, max(self.done[s] for s in states))
            if last in states:
                end = at
            if at >= stop:
                break
            word = int(h[at])
            states = self._closure({s + 1 for s in states if s < last and self.reads[s] in (None, word)})
            at += 1
        return end, (1.0 if end is not None else most / self.done[last])

    def _closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states


def _scan(automata: list[Automaton]) -> Callable:
    anchors: dict[int, dict[int, list[int]]] = {}
    for i, a in enumerate(automata):
        words = np.array(a.anchor(), np.uint64)
        anchors.setdefault(len(words), {}).setdefault(int(T.windows(words, len(words))[0]), []).append(i)
    keys = {size: np.array(sorted(k), np.uint64) for size, k in anchors.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.row_slices(batches, "text", SLICE_BYTES):
            h, _, _, first = T.words(T.column(part, "text"), T.ALNUM, True)
            places: list[list[dict]] = [[] for _ in range(part.num_rows)]
            score = np.zeros(part.num_rows)
            for size, known in keys.items():
                w = T.windows(h, size)
                for at in np.flatnonzero(np.isin(w, known) & T.starts_inside(first, size)).tolist():
                    row = int(np.searchsorted(first, at, "right")) - 1
                    for i in anchors[size][int(w[at])]:
                        end, share = automata[i].run(h, at, int(first[row + 1]))
                        score[row] = max(score[row], share)
                        if end is not None:
                            places[row].append({"label": automata[i].label, "base": automata[i].base, "start": at - int(first[row]), "stop": end - int(first[row])})
            kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([T.column(part, "id"), pa.array(np.diff(first)), pa.array(places, kind), pa.array(score)], ["id", "n_words", "places", "score"])
    return run


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """A row for each document: (id_col, n_words, places: array of (label, base, start, stop) in words, score).

    ``score``: the largest share of a template's mandatory words that the text has in order; 1 where a template is accepted.
    """
    ship_code(docs.sparkSession)
    automata = [Automaton.compile(*t, True) for t in BASE_TEMPLATES] + [Automaton.compile(*t, False) for t in (TEMPLATES if templates is None else templates)]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(_scan(automata), f"id {id_type}, n_words long, places array<struct<label:string,base:boolean,start:long,stop:long>>, score double").withColumnRenamed("id", id_col)
