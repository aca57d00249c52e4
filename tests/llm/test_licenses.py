from __future__ import annotations

import itertools
import re

import pytest

from tests.llm.texts import awkward, clashing, documents
from tripline.llm.licenses import PHRASES, TEMPLATES, compiled, license_scan, split


def pattern(text: str) -> str:
    """A template as a regular expression over words that each end with a blank."""
    out = []
    for part in re.split(r"(\[\[|\]\]|\{\{\d+\}\})", text):
        if part == "[[":
            out.append("(?:")
        elif part == "]]":
            out.append(")?")
        elif part.startswith("{{"):
            out.append(r"(?:[^ ]+ ){0,%s}" % part[2:-2])
        else:
            out.extend(re.escape(word) + " " for word in split(part))
    return "".join(out)


def brute_force(doc_id, text) -> tuple:
    words = split(text or "")
    starts = {k: set() for k in range(len(words))}
    base = set()
    n = 0
    for phrase, label in PHRASES.items():
        own = split(phrase)
        for k in range(len(words)):
            if words[k : k + len(own)] == own:
                n += 1
                base.add(label)
                starts[k].add(label)
    places = [k for k, found in starts.items() if found]
    more = set()
    for name, template in TEMPLATES.items():
        for k in range(len(words)):
            if re.match(pattern(template), "".join(w + " " for w in words[k:])):
                more.add(name)
    return (
        doc_id, len(words), n, min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | more)),
    )


LICENSES = [
    "Released under the MIT License.",
    "x released UNDER the well known MIT license, version 2 b and more",
    "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "licensed under the GNU General Public License (GPL), either version 3 or later",
    "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0",
    "licensed under a CC BY-SA 4.0 license; cc by cc by",
    "the apache license apache license MIT License mit licenses",
    "gnu general public\nlicense gnu general",
    "licensed under the licensed under the apache license version",
    re.sub(r"\[\[.*?\]\]|\{\{\d+\}\}", " ", TEMPLATES["MIT"]),
    re.sub(r"\[\[|\]\]|\{\{\d+\}\}", " ", TEMPLATES["MIT"]),
    re.sub(r"\[\[|\]\]|\{\{\d+\}\}", " ", TEMPLATES["Apache-2.0-header"]).replace("License at", "License at http://x.org/LICENSE-2.0"),
    TEMPLATES["ISC"].replace("[[/or]]", "").replace("fee is", "fees are"),
]


def check(docs) -> None:
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = license_scan(docs).collect()
    assert sorted((tuple(r)[:7] for r in found), key=repr) == sorted((brute_force(*row) for row in rows), key=repr)
    for row in found:
        assert 0 <= row.score <= 1
        assert (row.score == 1) == bool(row.spans)
        assert row.score >= 0.5 or not row.n_base


def test_awkward_rows(spark):
    texts = [t if not isinstance(t, tuple) else t for t in awkward()]
    long = " ".join(["licensed under the"] * 50 + ["apache license version 2 0"])
    check(clashing(documents(spark, [t for t in texts if len(str(t)) < 20_000] + LICENSES + [long])))


def test_empty_tables(spark):
    check(documents(spark, []))
    check(documents(spark, [None, ""]))


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r.doc_id: tuple(r)[:7] for r in license_scan(docs).collect()}
    for row in docs.where("lower(text) LIKE '%licen%' OR doc_id % 9 = 0").collect():
        assert found[row.doc_id] == brute_force(row.doc_id, row.text)


def test_markup():
    automaton = compiled("t", "a b [[c [[d]] e]] {{2}} f")
    words = ["a", "b", "c", "d", "e", "f", "x"]
    for n in range(2, 8):
        for tail in itertools.product(words, repeat=n - 2):
            text = ["a", "b", *tail]
            accepted, _ = automaton.run(iter(text))
            wanted = max((k for k in range(1, n + 1) if re.fullmatch(pattern("a b [[c [[d]] e]] {{2}} f"), "".join(w + " " for w in text[:k]))), default=None)
            assert accepted == wanted
        if n == 5:
            break


def test_bad_templates():
    for text in ("a", "[[a b]]", "a b [[c", "a b c]]"):
        with pytest.raises(ValueError):
            compiled("t", text)


def test_whole_wordings(spark):
    """Wordings as files carry them, with names filled in, are accepted; one other mandatory word is not."""
    bsd = """Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:
 * 1. Redistributions of source code must retain the above copyright notice, this
 *    list of conditions and the following disclaimer.
 * 2. Redistributions in binary form must reproduce the above copyright notice, this list of
 *    conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
    third = "* 3. Neither the name of the Example Project nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
    warranty = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
 WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
 ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
 SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"""
    texts = [
        bsd + warranty,
        bsd + third + warranty,
        bsd.replace("retain", "keep") + third + warranty,
        "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed with this\n// file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "it is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3",
        "To the extent possible under law, A. N. Author has waived all copyright and related or neighboring rights to this work.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ]
    docs = documents(spark, texts)
    found = {r.doc_id: set(filter(None, r.labels.split(","))) for r in license_scan(docs).collect()}
    assert found[0] == {"BSD-notice", "BSD-2-Clause"}
    assert found[1] == {"BSD-notice", "BSD-3-Clause"}
    assert found[2] == set()
    assert found[3] == {"MPL-2.0"}
    assert found[4] == {"LGPL-notice"}
    assert found[5] == {"CC0-1.0"}
    assert found[6] == {"gpl", "GPL-disclaimer"}
    check(docs)


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_each_template_accepts_its_own_wording(name):
    """With optional regions and without, and with names in place of what may be replaced."""
    wording = TEMPLATES[name]
    for keep in (True, False):
        text = re.sub(r"\[\[(.*?)\]\]", r"\1" if keep else "", wording)
        words = split(re.sub(r"\{\{(\d+)\}\}", lambda m: " any " * int(m[1]) if keep else " ", text))
        automaton = compiled(name, wording)
        assert automaton.run(iter(words))[0] == len(words)
        assert keep or automaton.run(iter([*words[:-1], "another"]))[0] is None
