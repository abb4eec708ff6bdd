import re

from conftest import DATA

from barloom.llm.licenses import _HINT, RULES, SENTENCES, normalise, scan, scan_licenses


def test_rules_name_known_sentences_and_every_sentence_has_a_hint():
    assert {s for _, ids in RULES for s in ids} == set(SENTENCES)
    for texts in SENTENCES.values():
        for t in texts:
            assert _HINT.search(t) and normalise(t.replace("<v>", "2.0")) == (t, "2.0" if "<v>" in t else None)


def test_documents_equal_a_plain_search(spark):
    wording = {
        "GPL": r"This work is licensed under the GNU General Public License, version (\d+)",
        "All-rights-reserved": r"All rights reserved",
        "MIT": r"Released under the MIT License",
        "Apache": r"Licensed under the Apache License, Version (\d\.\d)",
        "CC-BY-NC": r"Licensed under CC BY-NC (\d\.\d)",
    }
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    found = 0
    for r in scan_licenses(docs).collect():
        wanted = set()
        for name, pattern in wording.items():
            for m in re.finditer(rf"(?:^|[.!?:;]\s|\n)\s*{pattern}\.?(?=\s|$)", text[r.doc_id]):
                wanted.add(f"{name}-{m.group(1)}" if m.groups() else name)
        assert {m.license for m in r.matches} == wanted
        found += bool(wanted)
    assert found


def test_sequences_gaps_and_order():
    grant, condition, as_is = (SENTENCES[s][0].capitalize() for s in ("mit-grant", "mit-condition", "as-is"))
    text = f"Foo.\n{grant}:\n\n{condition}.\nBar. Baz.\n{as_is}. All Rights Reserved!"
    one, two = scan(text)
    assert (one["license"], one["sentences"]) == ("MIT", ["mit-grant", "mit-condition", "as-is"])
    assert text[one["start"] : one["end"]].strip().startswith("Permission") and two["license"] == "All-rights-reserved"
    far = scan(f"{grant}:\n{condition}.\nA. B. C.\n{as_is}.")
    assert [m["sentences"] for m in far] == [["mit-grant", "mit-condition"]]
    assert scan(f"{condition}.") == []
    assert [m["license"] for m in scan("Released under the MIT licence. Licensed under the Apache License, Version 2.0")] == ["MIT", "Apache-2.0"]


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "x. " * 50_000 + "All rights reserved.", 1), (3, "software", 1), (None, "Released under the MIT License.", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches int")
    got = [(r.doc_id, [m.license for m in r.matches]) for r in scan_licenses(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, []), (2, []), (3, ["All-rights-reserved"]), (3, []), (None, ["MIT"])], key=str)
    assert scan_licenses(docs.limit(0)).count() == 0


def test_every_licence_line_of_the_table_is_found(spark):
    wording = {
        "GPL": r"This work is licensed under the GNU General Public License, version (\d+)\.",
        "All-rights-reserved": r"All rights reserved\.",
        "MIT": r"Released under the MIT License\.",
        "Apache": r"Licensed under the Apache License, Version (\d\.\d)\.",
        "CC-BY-NC": r"Licensed under CC BY-NC (\d\.\d)\.",
    }
    docs = spark.read.parquet(f"{DATA}/../sf0.01/documents.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: [m.license for m in r.matches] for r in scan_licenses(docs).collect()}
    lines = 0
    for i, t in text.items():
        wanted = []
        for line in t.split("\n"):
            # No other wording occurs: a line that speaks of a licence ends in one of the five.
            if re.search(r"licen[cs]|rights reserved|copyright|spdx", line, re.IGNORECASE):
                name, m = next((name, m) for name, p in wording.items() if (m := re.search(rf"(?:^|[.!?:;]\s){p}$", line)))
                wanted.append(f"{name}-{m.group(1)}" if m.groups() else name)
        lines += len(wanted)
        assert got[i] == wanted
    assert lines == 46


def test_each_creative_commons_variant_has_its_own_name():
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for text in (f"Licensed under CC {kind} 4.0.", f"This work is licensed under CC {kind} 4.0."):
            assert [m["license"] for m in scan(text)] == [f"CC-{kind}-4.0"]
    full = "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."
    assert [m["license"] for m in scan(full)] == ["CC-BY-NC-SA-4.0"]


MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_original_wrapped_texts():
    texts = {"MIT": (MIT, 3), "Apache-2.0": (APACHE, 3), "GPL-3": (GPL, 2), "MPL-2.0": (MPL, 1), "BSD-3-Clause": (BSD, 4)}
    for name, (text, sentences) in texts.items():
        as_comment = "".join(f"# {line}".rstrip() + "\n" for line in text.splitlines())
        for t in (text, text.replace("\n", "\r\n"), as_comment, f"Foo bar\nbaz:\n{text}\nBar"):
            assert [(m["license"], len(m["sentences"])) for m in scan(t)] == [(name, sentences)]
    assert [m["license"] for m in scan(BSD.replace("1.", "(a)").replace("2.", "(b)").replace("3.", "(c)"))] == ["BSD-3-Clause"]


def test_spdx_tags():
    for tag, name in {"MIT": "MIT", "Apache-2.0": "Apache-2.0", "GPL-3.0-or-later": "GPL-3.0", "LGPL-2.1-only": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "BSD-3-Clause": "BSD", "CC-BY-NC-4.0": "CC-BY-NC-4.0", "CC0-1.0": "CC0-1.0"}.items():
        for t in (f"SPDX-License-Identifier: {tag}", f"// SPDX-License-Identifier: {tag}\nint x;", f"<!-- SPDX-License-Identifier: {tag} -->\n"):
            assert [m["license"] for m in scan(t)] == [name]


def test_every_known_sentence_passes_the_splitter_wrapped():
    for name, texts in SENTENCES.items():
        for t in texts:
            words = t.replace("<v>", "2.0").split()
            text = "Foo.\n" + "\n".join(" ".join(words[i : i + 5]) for i in range(0, len(words), 5)) + ".\nBar."
            found = [s for m in scan(text) for s in m["sentences"]]
            assert found == ([name] if [name] in [ids for _, ids in RULES] else [])
    # Another paragraph is another sentence.
    assert scan("Released under\n\nthe MIT License.") == []
