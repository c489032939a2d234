"""Licence scan by sentence rules.

A text is cut into sentences, each is normalised (lower case, words only) and looked up
among the known licence sentences. The sequence of identifiers found, in text order, is
then matched against the ordered licence rules: at each place the longest rule that
fits decides and its sentences are used up; known sentences that no rule takes stay
unmatched. A sentence ends at ``. ! ? ; :`` before white space, or at the end of a line; a
known sentence that is wrapped over lines is found too, from any line start to the next
such mark.

The tables are fixed and small (a few thousand sentences built from phrases and names), so
every task holds them. A text without any of the words that known sentences are made of
(each sentence has at least one of them) is not cut at all.

Defined cases: null and empty texts have no sentences; repeated sentences count each
time, and a licence found several times is named once; repeated rows are scanned each;
null doc_id is kept. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm import text as T

# SPDX identifiers with the names that notices use, normalised.
NAMES = {
    "MIT": ["mit", "mit license", "expat license"],
    "ISC": ["isc", "isc license"],
    "BSD-2-Clause": ["bsd 2 clause", "bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause", "bsd 3 clause license", "3 clause bsd license", "new bsd license"],
    "Apache-2.0": ["apache 2 0", "apache license 2 0", "apache license version 2 0", "apache 2 0 license"],
    "MPL-2.0": ["mpl 2 0", "mozilla public license 2 0", "mozilla public license version 2 0", "mozilla public license v 2 0"],
    "GPL-2.0": ["gpl 2 0", "gplv2", "gnu gpl v2", "gnu general public license version 2", "gnu general public license v2 0"],
    "GPL-3.0": ["gpl 3 0", "gplv3", "gnu gpl v3", "gnu general public license version 3", "gnu general public license v3 0"],
    "LGPL-2.1": ["lgpl 2 1", "gnu lesser general public license version 2 1"],
    "LGPL-3.0": ["lgpl 3 0", "gnu lesser general public license version 3"],
    "AGPL-3.0": ["agpl 3 0", "gnu affero general public license version 3"],
    "CC0-1.0": ["cc0", "cc0 1 0", "cc0 1 0 universal"],
    "Unlicense": ["unlicense", "unlicense license"],
}
# Creative Commons licences: parts, and the versions that they came in.
CC_PARTS = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
CC_KINDS = [("by",), ("by", "sa"), ("by", "nc"), ("by", "nd"), ("by", "nc", "sa"), ("by", "nc", "nd")]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
# Phrases that a name follows.
PHRASES = ["released under", "licensed under", "distributed under", "available under", "provided under", "published under",
           "made available under", "is licensed under", "spdx license identifier"]
SUBJECTS = ["this work", "this text", "this document", "this software", "this project", "this file", "this program", "this code",
            "this article", "this page", "this content", "the source code"]
# Sentences of licence texts and notices, by identifier, and the rules over them.
SENTENCES = {
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "MIT-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "as-is-software": "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    "no-liability-software": "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "BSD-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "BSD-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "Apache-2.0-head": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "Apache-2.0-comply": "you may not use this file except in compliance with the License",
    "GPL-free": "This program is free software",
    "GPL-2.0-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version".replace(";", ","),
    "GPL-3.0-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0".replace("v. ", "v "),
    "Unlicense-text": "This is free and unencumbered software released into the public domain",
}
RULES = [
    ("MIT", ["MIT-grant", "MIT-keep", "as-is-software", "no-liability-software"]),
    ("MIT", ["MIT-grant", "MIT-keep"]),
    ("ISC", ["ISC-grant"]),
    ("BSD-3-Clause", ["BSD-grant", "BSD-source", "BSD-binary", "BSD-endorse"]),
    ("BSD-2-Clause", ["BSD-grant", "BSD-source", "BSD-binary"]),
    ("Apache-2.0", ["Apache-2.0-head", "Apache-2.0-comply"]),
    ("Apache-2.0", ["Apache-2.0-head"]),
    ("GPL-2.0-or-later", ["GPL-free", "GPL-2.0-terms"]),
    ("GPL-3.0-or-later", ["GPL-free", "GPL-3.0-terms"]),
    ("MPL-2.0", ["MPL-2.0-notice"]),
    ("Unlicense", ["Unlicense-text"]),
]
COPYRIGHT = "copyright-line"

_NOT_WORD = re.compile(r"[\W_]+")
_HARD_END = re.compile(r"[.!?;:]+(?=\s|$)")
_COPYRIGHT = re.compile(r"copyright (?:c |\d{4}\b|by )")
# Stems that nearly all known sentences hold one of.
_STEMS = ["licen", "copyright", "permission", "warrant", "redistribut", "liable", "free software", "gpl"]


def normalised(sentence: str) -> str:
    return _NOT_WORD.sub(" ", sentence.lower()).strip()


def cc_names() -> dict[str, list[str]]:
    out = {}
    for kind in CC_KINDS:
        for version in CC_VERSIONS:
            v = version.replace(".", " ")
            long = "creative commons " + " ".join(CC_PARTS[p] for p in kind)
            short = "cc " + " ".join(kind)
            out[f"CC-{'-'.join(kind).upper()}-{version}"] = [
                f"{n} {v}{end}" for n in (short, long) for end in ("", " license", " international", " international license", " unported license")]
    return out


@cache
def tables() -> tuple[dict[str, str], list[tuple[str, list[str]]], re.Pattern, int]:
    """Normalised sentence -> identifier, rules (longest first), a pattern of which every
    known sentence holds a match, and the most words of a known sentence."""
    known = {normalised(s): i for i, s in SENTENCES.items()}
    rules = list(RULES)
    openings = [f"{start}{p}" for p in PHRASES for start in ("", *(f"{s} is " for s in SUBJECTS)) if not (start and p.startswith(("is ", "spdx")))]
    for licence, names in {**NAMES, **cc_names()}.items():
        rules.append((licence, [f"{licence}-notice"]))
        for name in names:
            for opening in openings:
                for article in ("", "the ", "a ", "an "):
                    known.setdefault(f"{opening} {article}{name}", f"{licence}-notice")
    rules.sort(key=lambda r: -len(r[1]))  # stable: the order above among equal lengths
    words = list(_STEMS)
    for s in known:
        if not any(w in s for w in words):
            words.append(max(s.split(), key=len))
    anchor = re.compile("|".join(re.escape(w).replace(r"\ ", r"\W+") for w in words))
    return known, rules, anchor, max(len(s.split()) for s in known)


def sentences(text: str) -> Iterator[str]:
    """Identifiers of the known sentences of a text, in order."""
    known, _, _, most = tables()
    text = re.sub(r"(?i)(spdx-license-identifier):", r"\1", text)
    for segment in _HARD_END.split(text):
        lines = [normalised(x) for x in segment.split("\n")]
        i = 0
        while i < len(lines):
            found = None
            if lines[i]:
                # From this line start to the sentence's end, then the line alone.
                if i + 1 < len(lines):
                    rest, words = [], 0
                    for line in lines[i:]:
                        rest.append(line)
                        words += line.count(" ") + bool(line)
                        if words > most:
                            break
                    else:
                        found = known.get(" ".join(x for x in rest if x))
                if found:
                    yield found
                    break
                found = known.get(lines[i]) or (COPYRIGHT if _COPYRIGHT.match(lines[i]) else None)
                if found:
                    yield found
            i += 1


def match(found: list[str]) -> tuple[list[str], list[str]]:
    """(licences in the order found, identifiers that no rule took)."""
    _, rules, _, _ = tables()
    found = [f for f in found if f != COPYRIGHT]
    licences, left, i = [], [], 0
    while i < len(found):
        for licence, sequence in rules:
            if found[i: i + len(sequence)] == sequence:
                licences.append(licence)
                i += len(sequence)
                break
        else:
            left.append(found[i])
            i += 1
    return list(dict.fromkeys(licences)), left


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchor = tables()[2]
    for batch in batches:
        for rows, _, _ in T.row_chunks(batch):
            found, licences, left = [], [], []
            for text in rows.column(1).to_pylist():
                ids = list(sentences(text)) if text and anchor.search(text.lower()) else []
                got, rest = match(ids)
                found.append(ids)
                licences.append(got)
                left.append(rest)
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(found, strings), pa.array(licences, strings), pa.array(left, strings)],
                names=["doc_id", "sentences", "licenses", "unmatched"])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, sentences (identifiers in text order), licenses (each
    once, in the order found), unmatched (identifiers that no rule took)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    strings = "array<string>"
    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .mapInArrow(_scan, f"doc_id {id_type}, sentences {strings}, licenses {strings}, unmatched {strings}"))
