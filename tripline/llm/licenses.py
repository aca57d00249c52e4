"""License scans by template-markup matching.

A template is the wording of a license or notice. ``[[...]]`` is a region that may be left out, ``{{n}}`` one that up
to n words of any kind replace; all else is mandatory, word for word. Each is compiled into an automaton over words,
which is run from every place where the template's first words stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.flat import ALPHANUMERIC, Words, flattened, pieces, words_of

# Phrases and the labels they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# The wording of licenses and notices, with markup. Each begins with two mandatory words or more.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the {{4}}Software{{2}}), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice [[(including the next paragraph)]] shall"
        " be included in all copies or substantial portions of the Software."
    ),
    "MIT-notice": "Released under the {{2}}MIT License[[, version {{2}}]]",
    "MIT-notice-licensed": "Licensed under the {{2}}MIT License",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0[[ (the {{1}}License{{1}})]]",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the {{1}}License{{1}}); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at {{12}} Unless required by applicable"
        " law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0": "licensed under the GNU General Public License[[ (GPL)]], [[either ]]version 3",
    "GPL-2.0": "licensed under the GNU General Public License[[ (GPL)]], [[either ]]version 2",
    "GPL-notice": (
        "is free software[[: you can redistribute it]]; you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation"
    ),
    "CC-BY-NC-4.0": "Licensed under [[a ]][[the ]][[Creative Commons Attribution NonCommercial ]]CC BY-NC 4.0",
    "CC-BY-4.0": "Licensed under [[a ]][[the ]][[Creative Commons Attribution ]]CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under [[a ]][[the ]][[Creative Commons Attribution ShareAlike ]]CC BY-SA 4.0",
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: [[1. ]]Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer."
    ),
    "ISC": (
        "Permission to use, copy, modify, and[[/or]] distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-disclaimer": (
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO"
        " THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE[[,]] AND NONINFRINGEMENT. IN NO EVENT SHALL"
        " {{12}} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,"
        " ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: [[1. ]]Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. [[2. ]]Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"
        " and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY {{14}} AS IS AND ANY EXPRESS"
        " OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
        " PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {{14}} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
        " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: [[1. ]]Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. [[2. ]]Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"
        " and/or other materials provided with the distribution. [[3. ]]Neither the name of {{14}} nor the names of [[its]]"
        " {{3}} contributors may be used to endorse or promote products derived from this software without specific prior"
        " written permission."
    ),
    "Zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event will the {{3}} be held"
        " liable for any damages arising from the use of this software. Permission is granted to anyone to use this"
        " software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject"
        " to the following restrictions: [[1. ]]The origin of this software must not be misrepresented; you must not claim"
        " that you wrote the original software. If you use this software in a product, an acknowledgment in the product"
        " documentation would be appreciated but is not required. [[2. ]]Altered source versions must be plainly marked as"
        " such, and must not be misrepresented as being the original software. [[3. ]]This notice may not be removed or"
        " altered from any source distribution."
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and"
        " accompanying documentation covered by this license (the {{1}}Software{{1}}) to use, reproduce, display,"
        " distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit"
        " third-parties to whom the Software is furnished to do so, all subject to the following:"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at"
    ),
    "LGPL-notice": (
        "is free software[[: you can redistribute it]]; you can redistribute it and/or modify it under the terms of"
        " the GNU Lesser General Public License as published by the Free Software Foundation"
    ),
    "AGPL-notice": (
        "is free software[[: you can redistribute it]]; you can redistribute it and/or modify it under the terms of"
        " the GNU Affero General Public License as published by the Free Software Foundation"
    ),
    "GPL-disclaimer": (
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU [[Lesser ]][[Affero ]]General Public License for"
        " more details."
    ),
    "CC0-1.0": "To the extent possible under law, {{14}} waived all copyright and related or neighboring rights to",
}


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score``, ``spans``.

    Words are lower-cased runs of a-z, 0-9 and all beyond ASCII. ``n_base`` counts the places where a phrase's words
    follow each other; ``first_word`` and ``last_word`` are the smallest and largest start of those, from 0, or NULL.
    ``base_labels`` are the labels of phrases found, ``labels`` also the names of templates accepted; both distinct,
    sorted, comma-joined. ``spans`` has the template, first and last word of each place that was accepted. ``score``
    is 1 if a template was accepted; else the largest share of a template's mandatory words that was read from one
    place, at least a half if a phrase was found. NULL and empty texts have no words and nothing found. Rows are
    judged one by one, whatever their doc_id; an empty table gives no rows; other columns are not read.
    """
    automata = [compiled(name, text) for name, text in templates.items()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scanned(automata, phrases), _OUT)


_OUT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<template string, first long, last long>>"
)
_SPANS = pa.list_(pa.struct([("template", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))


def split(text: str) -> list[str]:
    """Words of a template or phrase."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


@dataclass
class Automaton:
    """States are numbers from 0; from a state, a word leads to one other, or any word does.

    ``mandatory[s]`` is the number of mandatory words read on the way to state s.
    """

    name: str
    start: list[str]
    total: int = 0
    words: list[dict[str, int]] = field(default_factory=list)
    any_word: list[int | None] = field(default_factory=list)
    skips: list[list[int]] = field(default_factory=list)
    mandatory: list[int] = field(default_factory=list)

    def _state(self, mandatory: int) -> int:
        self.words.append({})
        self.any_word.append(None)
        self.skips.append([])
        self.mandatory.append(mandatory)
        return len(self.words) - 1

    def _closed(self, states: set[int]) -> set[int]:
        """With all that can be reached without a word."""
        todo = list(states)
        while todo:
            for state in self.skips[todo.pop()]:
                if state not in states:
                    states.add(state)
                    todo.append(state)
        return states

    def run(self, words: Iterator[str]) -> tuple[int | None, int]:
        """The number of words of the longest accepted text, if any, and the most mandatory words that were read."""
        final, states, accepted, best = len(self.words) - 1, self._closed({0}), None, 0
        for n, word in enumerate(words, 1):
            after = {t for s in states for t in (self.words[s].get(word), self.any_word[s]) if t is not None}
            if not after:
                break
            states = self._closed(after)
            best = max(best, max(self.mandatory[s] for s in after))
            if final in states:
                accepted = n
        return accepted, best


def compiled(name: str, text: str) -> Automaton:
    """The automaton of a template."""
    parts = re.split(r"(\[\[|\]\]|\{\{\d+\}\})", text)
    start = split(parts[0])
    if len(start) < 2:
        raise ValueError(f"template {name} does not begin with two mandatory words")
    out = Automaton(name, start)
    at, opened = out._state(0), []
    for part in parts:
        if part == "[[":
            opened.append(at)
        elif part == "]]":
            if not opened:
                raise ValueError(f"template {name} closes a region that is not open")
            # The region begins at a state of its own end too: it is left out by going there at once.
            out.skips[opened.pop()].append(at)
        elif part.startswith("{{"):
            before = at
            ends = [before]
            for _ in range(int(part[2:-2])):
                after = out._state(out.mandatory[before])
                out.any_word[ends[-1]] = after
                ends.append(after)
            at = out._state(out.mandatory[before])
            for state in ends:
                out.skips[state].append(at)
        else:
            for word in split(part):
                after = out._state(out.mandatory[at] + (not opened))
                out.words[at][word] = after
                at = after
    if opened:
        raise ValueError(f"template {name} leaves a region open")
    out.total = out.mandatory[at]
    return out


# In tasks


def _name(words: list[str]) -> np.ndarray:
    """Fingerprints of single words, as texts have them."""
    return words_of(flattened(pa.array([" ".join(words)])), ALPHANUMERIC).names


def _places(words: Words, wanted: list[str]) -> np.ndarray:
    """Where the wanted words follow each other inside one text."""
    names = words.names
    n = len(names) - len(wanted) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    wanted_names = _name(wanted)
    at = np.flatnonzero(names[:n] == wanted_names[0])
    for k, name in enumerate(wanted_names):
        at = at[names[at + k] == name]
    return at[words.text[at] == words.text[at + len(wanted) - 1]]


def _scanned(automata: list[Automaton], phrases: dict[str, str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield _piece(piece, automata, phrases)

    return scan


def _piece(piece: pa.RecordBatch, automata: list[Automaton], phrases: dict[str, str]) -> pa.RecordBatch:
    flat = flattened(piece.column("text")).lowered
    words = words_of(flat, ALPHANUMERIC)
    n = len(flat)
    base = [set() for _ in range(n)]
    more = [set() for _ in range(n)]
    starts: list[list[int]] = [[] for _ in range(n)]
    spans: list[list[tuple]] = [[] for _ in range(n)]
    share = np.zeros(n)
    for phrase, label in phrases.items():
        for at in _places(words, split(phrase)):
            text = words.text[at]
            base[text].add(label)
            starts[text].append(int(at - words.offsets[text]))
    data = flat.data

    def read(at: int, end: int) -> Iterator[str]:
        for k in range(at, end):
            yield data[words.starts[k] : words.ends[k]].tobytes().decode()

    for automaton in automata:
        for at in _places(words, automaton.start):
            text = words.text[at]
            length, best = automaton.run(read(at, words.offsets[text + 1]))
            share[text] = max(share[text], 1.0 if length else best / automaton.total)
            if length:
                first = int(at - words.offsets[text])
                more[text].add(automaton.name)
                spans[text].append((automaton.name, first, first + length - 1))
    found = np.array([bool(x) for x in base])
    score = np.where(found, np.maximum(share, 0.5), share)
    return pa.RecordBatch.from_arrays(
        [
            piece.column("doc_id"),
            pa.array(words.counts.astype(np.int64)),
            pa.array([len(x) for x in starts], pa.int64()),
            pa.array([min(x, default=None) for x in starts], pa.int64()),
            pa.array([max(x, default=None) for x in starts], pa.int64()),
            pa.array([",".join(sorted(x)) for x in base], pa.string()),
            pa.array([",".join(sorted(x | y)) for x, y in zip(base, more)], pa.string()),
            pa.array(score, pa.float64()),
            pa.array([[dict(zip(("template", "first", "last"), s)) for s in sorted(x, key=lambda s: (s[1], s[0]))] for x in spans], _SPANS),
        ],
        ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
    )


