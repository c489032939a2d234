import re

from rateflow.llm import licenses as L
from tests.llm.helpers import documents, no_documents

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License."""


def _plain(text):
    """Sentences by the definition: every line start to the next mark, or the line alone."""
    known = L.tables()[0]
    text = re.sub(r"(?i)(spdx-license-identifier):", r"\1", text or "")
    out = []
    for segment in re.split(r"[.!?;:]+(?=\s|$)", text):
        lines = segment.split("\n")
        i = 0
        while i < len(lines):
            rest = L.normalised(" ".join(lines[i:]))
            if L.normalised(lines[i]) and rest in known:
                out.append(known[rest])
                break
            one = L.normalised(lines[i])
            if one in known:
                out.append(known[one])
            elif re.match(r"copyright (c |\d{4}\b|by )", one):
                out.append(L.COPYRIGHT)
            i += 1
    return out


DOCS = [
    (1, "Released under the MIT License."), (2, "Text before.\nLicensed under CC BY-NC 4.0.\nText after."),
    (3, "This work is licensed under the GNU General Public License, version 3."), (4, MIT), (5, APACHE + " More."),
    (6, "SPDX-License-Identifier: Apache-2.0"), (7, "no licence here, just a permit"), (8, None), (9, ""),
    (10, "words without end\nReleased under\nthe MIT License\n"), (11, "Released under the MIT License. Released under the MIT License."),
    (12, "We released under the MIT License name a thing."), (13, MIT + "\n" + APACHE), (None, "Licensed under the ISC License"),
    (14, "x " * 50_000 + ". Released under the MIT License."), (15, "you may not use this file except in compliance with the License."),
    (16, "RELEASED UNDER THE MIT LICENSE!"), (17, "Licensed under CC BY-NC-SA 3.0 Unported License."),
]


def test_licences_by_document(spark):
    got = {}
    rows = L.scan(documents(spark, [*DOCS, DOCS[0]])).collect()
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.licenses, r.unmatched))
    assert len(rows) == len(DOCS) + 1 and got[1] == [(["MIT"], [])] * 2
    assert got[2] == [(["CC-BY-NC-4.0"], [])] and got[3] == [(["GPL-3.0"], [])] and got[4] == [(["MIT"], [])]
    assert got[5] == [(["Apache-2.0"], [])] and got[6] == [(["Apache-2.0"], [])]
    for i in (7, 8, 9, 12):
        assert got[i] == [([], [])]
    assert got[10] == [(["MIT"], [])] and got[11] == [(["MIT"], [])] and got[13] == [(["MIT", "Apache-2.0"], [])]
    assert got[None] == [(["ISC"], [])] and got[14] == [(["MIT"], [])] and got[16] == [(["MIT"], [])]
    assert got[15] == [([], ["Apache-2.0-comply"])] and got[17] == [(["CC-BY-NC-SA-3.0"], [])]


def test_sentences_against_the_definition(spark):
    rows = {r.doc_id: r.sentences for r in L.scan(documents(spark, DOCS)).collect()}
    for i, text in DOCS:
        assert rows[i] == _plain(text), i


def test_every_known_sentence_has_an_anchor():
    known, rules, anchor, most = L.tables()
    assert all(anchor.search(s) for s in known) and max(len(s.split()) for s in known) == most
    assert [len(r[1]) for r in rules] == sorted((len(r[1]) for r in rules), reverse=True)


def test_no_documents(spark):
    assert L.scan(no_documents(spark)).collect() == []
