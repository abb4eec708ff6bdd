"""Operator 3: licence scan by sentence rules.

Texts are split into segments at line feeds and marks. A run of segments of one paragraph whose
normalised words are a known licence sentence gets its identifier, so wrapped lines, colons and
abbreviations inside a sentence do not matter; the longest run wins. The sequence of identifiers
is matched against ordered rules: at each place the first rule that fits from there wins, and
matching goes on behind it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Other sentences that may stand between two sentences of one rule.
GAP = 2

# Wording of public licence texts and notices. `<v>` stands for a version.
SENTENCES = {
    "rights": ["all rights reserved"],
    "mit-notice": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "spdx license identifier mit"],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"
    ],
    "mit-condition": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is": [
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
    ],
    "apache-notice": ["licensed under the apache license version <v>", "licensed under the apache license version <v> the license", "released under the apache license version <v>", "spdx license identifier apache <v>"],
    "apache-comply": ["you may not use this file except in compliance with the license"],
    "apache-as-is": [
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"
    ],
    "gpl-notice": ["this work is licensed under the gnu general public license version <v>", "licensed under the gnu general public license version <v>", "released under the gnu general public license version <v>", "spdx license identifier gpl <v>", "spdx license identifier gpl <v> only", "spdx license identifier gpl <v> or later"],
    "gpl-grant": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version <v> of the license or at your option any later version"
    ],
    "gpl-warranty": [
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"
    ],
    "lgpl-notice": ["licensed under the gnu lesser general public license version <v>", "this work is licensed under the gnu lesser general public license version <v>", "spdx license identifier lgpl <v>", "spdx license identifier lgpl <v> only", "spdx license identifier lgpl <v> or later"],
    "mpl-notice": ["this source code form is subject to the terms of the mozilla public license v <v>", "licensed under the mozilla public license version <v>", "spdx license identifier mpl <v>"],
    "bsd-notice": ["released under the bsd license", "licensed under the bsd license", "spdx license identifier bsd <v> clause"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
    ],
    "bsd-endorse": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
    ],
    "cc-by": ["this work is licensed under a creative commons attribution <v> international license", "licensed under cc by <v>", "this work is licensed under cc by <v>", "spdx license identifier cc by <v>"],
    "cc-by-sa": [
        "this work is licensed under a creative commons attribution sharealike <v> international license",
        "licensed under cc by sa <v>",
        "this work is licensed under cc by sa <v>",
        "spdx license identifier cc by sa <v>",
    ],
    "cc-by-nc": [
        "this work is licensed under a creative commons attribution noncommercial <v> international license",
        "licensed under cc by nc <v>",
        "this work is licensed under cc by nc <v>",
        "spdx license identifier cc by nc <v>",
    ],
    "cc-by-nd": [
        "this work is licensed under a creative commons attribution noderivatives <v> international license",
        "licensed under cc by nd <v>",
        "this work is licensed under cc by nd <v>",
        "spdx license identifier cc by nd <v>",
    ],
    "cc-by-nc-sa": [
        "this work is licensed under a creative commons attribution noncommercial sharealike <v> international license",
        "licensed under cc by nc sa <v>",
        "this work is licensed under cc by nc sa <v>",
        "spdx license identifier cc by nc sa <v>",
    ],
    "cc-by-nc-nd": [
        "this work is licensed under a creative commons attribution noncommercial noderivatives <v> international license",
        "licensed under cc by nc nd <v>",
        "this work is licensed under cc by nc nd <v>",
        "spdx license identifier cc by nc nd <v>",
    ],
    "cc-zero": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "released under cc0 <v>", "spdx license identifier cc0 <v>"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}

#: Ordered rules: (licence, identifiers in order). Longer ones stand before their beginnings.
RULES = [
    ("MIT", ["mit-grant", "mit-condition", "as-is"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("MIT", ["mit-notice"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD", ["bsd-notice"]),
    ("Apache", ["apache-notice", "apache-comply", "apache-as-is"]),
    ("Apache", ["apache-notice"]),
    ("GPL", ["gpl-grant", "gpl-warranty"]),
    ("GPL", ["gpl-grant"]),
    ("GPL", ["gpl-notice"]),
    ("LGPL", ["lgpl-notice"]),
    ("MPL", ["mpl-notice"]),
    ("CC-BY-SA", ["cc-by-sa"]),
    ("CC-BY-NC", ["cc-by-nc"]),
    ("CC-BY-ND", ["cc-by-nd"]),
    ("CC-BY-NC-SA", ["cc-by-nc-sa"]),
    ("CC-BY-NC-ND", ["cc-by-nc-nd"]),
    ("CC-BY", ["cc-by"]),
    ("CC0", ["cc-zero"]),
    ("Unlicense", ["unlicense"]),
    ("All-rights-reserved", ["rights"]),
]

#: Every known sentence has one of these, so a text without any has no match.
_HINT = re.compile("licen[cs]e|licensed|released under|rights|permission|warranty|redistribut|compliance|copyright|software", re.IGNORECASE)

#: A segment ends at a line feed, at a mark before white space or the end, and behind a list's `(a)`.
_END = re.compile(r"[.!?:;]+(?=\s|$)|\n+|^[ \t]*\(?\w\)(?=\s)", re.MULTILINE)
_VERSION = re.compile(r"\bv?\d+(?:\.\d+)*\b")
_WORD = re.compile(r"<v>|[^\W_]+")

_IDS = {text: name for name, texts in SENTENCES.items() for text in texts}

#: Every beginning of a known sentence that ends with a word.
_BEGINNINGS = {text[: m.start()] for text in _IDS for m in re.finditer(" ", text)}


def normalise(sentence: str) -> tuple[str, str | None]:
    """(lower-cased words with one blank between, versions as `<v>`; the last version)."""
    versions = _VERSION.findall(sentence.lower())
    words = " ".join(_WORD.findall(_VERSION.sub("<v>", sentence.lower())))
    return words, versions[-1].removeprefix("v") if versions else None


def segments(text: str) -> Iterator[tuple[int, int, str, str | None, int, int]]:
    """(start, end, words, version, sentence, paragraph) of the segments that hold words.

    `sentence` counts the marks and blank lines before, not the single line feeds; `paragraph`
    the blank lines, where a line of comment signs alone is one too.
    """
    at = sentence = paragraph = 0
    begins_line, pending = True, False
    for mark in [*_END.finditer(text), None]:
        end = mark.start() if mark else len(text)
        words, version = normalise(text[at:end])
        if words:
            yield at, end, words.replace("licence", "license"), version, sentence, paragraph
            pending = True
        if mark is None:
            return
        feeds = mark.group().count("\n")
        blank = feeds > 1 or feeds and begins_line and not words
        paragraph += bool(blank)
        if pending and (blank or not feeds):
            sentence, pending = sentence + 1, False
        begins_line, at = bool(feeds), mark.end()


def known(text: str) -> Iterator[tuple[int, int, str, str | None, int, int]]:
    """(first sentence, last sentence, identifier, version, start, end) of the known sentences."""
    parts = list(segments(text))
    i = 0
    while i < len(parts):
        words = version = best = None
        for j in range(i, len(parts)):
            if parts[j][5] != parts[i][5]:
                break
            words = f"{words} {parts[j][2]}" if words else parts[j][2]
            version = parts[j][3] or version
            if words in _IDS:
                best = j, version, _IDS[words]
            if words not in _BEGINNINGS:
                break
        if best:
            j, version, name = best
            yield parts[i][4], parts[j][4], name, version, parts[i][0], parts[j][1]
            i = j
        i += 1


def scan(text: str | None) -> list[dict]:
    """Matches of one text: licence with version, first and last place, sentence identifiers."""
    if not text or not _HINT.search(text):
        return []
    found = list(known(text))
    out, at = [], 0
    while at < len(found):
        for licence, wanted in RULES:
            own = found[at : at + len(wanted)]
            if [x[2] for x in own] == wanted and all(b[0] - a[1] <= GAP + 1 for a, b in zip(own, own[1:])):
                version = next((x[3] for x in own if x[3] and licence[:2] != "BS"), None)
                out.append({"license": f"{licence}-{version}" if version else licence, "start": own[0][4], "end": own[-1][5], "sentences": wanted})
                at += len(wanted)
                break
        else:
            at += 1
    return out


_MATCH = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("sentences", pa.list_(pa.string()))]))


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, matches) of every row; start and end are code points of the whole text.

    Null and empty texts have no match; repeated rows and null ids come back as they are. Where
    several rules fit from one sentence the first of `RULES` wins. Further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _MATCH)], names=["doc_id", "matches"])

    kind = "doc_id long, matches array<struct<license: string, start: long, end: long, sentences: array<string>>>"
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, kind)
