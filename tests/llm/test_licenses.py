import re

from newsflow.llm import licenses as L

MIT = (
    "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
    'software and\nassociated documentation files (the "Software"), to deal in the Software without '
    "restriction,\nincluding without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense,\nand/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so,\nsubject to the following conditions:\n\nThe above copyright notice "
    "and this permission notice shall be included in all copies or\nsubstantial portions of the Software."
)


def plain(sentence):
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def notice(sentence):
    verb = re.match(L.NOTICE, sentence)
    if not verb:
        return sentence
    return re.sub(L.NOTICE_TAIL, "", "under " + sentence[verb.end():])


def brute_ids(text):
    """Every break is a place to begin; what begins there ends at its sentence, clause or line."""
    text, ids = re.sub(r"\r\n?", "\n", text or ""), []
    for sentence in re.split(r"(?<![.!?])[.!?]+(?=\s|$)|\n[^A-Za-z0-9\n]*\n", text):
        clauses = [m.end() for m in re.finditer(r"(?<![;:])[;:]+(?=\s|$)", sentence)]
        lines = [m.end() for m in re.finditer("\n", sentence)]
        begins = sorted({0, *clauses, *lines})
        for at, upto in zip(begins, begins[1:] + [len(sentence)]):
            if not re.search("[A-Za-z0-9]", sentence[at:upto]):
                continue
            line = sentence[at:].split("\n")[0]
            tag = re.match(r"[^A-Za-z0-9]*SPDX-License-Identifier:\s*(.+)", line, re.I)
            if tag:
                for word in re.split(r"[^A-Za-z0-9.+-]+", tag[1]):
                    short = re.sub(r"(?i)(-only|-or-later|\+)$", "", word).lower()
                    ids += [f"{n}:spdx" for n in L.NAMES if n.lower() == short]
                continue
            clause = sentence[at:next((c for c in clauses if c > at), None)]
            for piece in (sentence[at:], clause, line):
                known = L.SENTENCES.get(notice(plain(piece)))
                if known:
                    ids.append(known)
                    break
    return ids


def within(rule, ids):
    rest = iter(ids)
    return all(i in rest for i in rule)


def brute(text):
    ids, held = brute_ids(text), []
    for name, rules in L.RULES.items():
        held += [(name, rule) for rule in rules if within(rule, ids)]
    found = {
        name for name, rule in held
        if not any(other != name and len(longer) > len(rule) and within(rule, longer)
                   for other, longer in held)
    }
    return ids, sorted(found) or ["Proprietary"] * ("reserved" in ids)


def result(df):
    return {r[0]: (r[1], r[2]) for r in L.scan(df).collect()}


def test_whole_table(spark, documents):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = result(df)
    assert found == {r["doc_id"]: brute(r["text"]) for r in documents}
    named = sum("icense" in r["text"] for r in documents)
    assert named and sum(bool(f[1]) for f in found.values()) >= named


CASES = [
    (1, None), (2, ""), (3, MIT), (4, MIT.replace("\n\n", ". ").replace("\n", " ").upper()),
    (5, "Permission is hereby granted."), (6, "word\nLicensed under the Apache License, Version 2.0\nword"),
    (7, "SPDX-License-Identifier: GPL-3.0-or-later"), (8, "x. Licensed under CC BY-NC 4.0. All rights "
     "reserved. This work is licensed under CC BY-NC 4.0."),
    (9, "You may not use this file except in compliance with the License. Then.\nYou may obtain a copy of "
        "the License at\n\n http://x"),
    (10, "You may obtain a copy of the License at\n\nYou may not use this file except in compliance with "
         "the License."),
    (11, "a " * 200_000 + "\nLicensed under the MIT License."),
    (11, "a " * 200_000 + "\nLicensed under the MIT License."),
]


def test_cases_equal_brute_force(frame):
    df = frame([(*c, "x", [1]) for c in CASES], "doc_id long, text string, licenses string, p array<int>")
    found = result(df)
    assert found == {i: brute(t) for i, t in CASES}
    assert found[3][1] == found[4][1] == ["MIT"] and found[1] == found[2] == ([], [])
    assert found[6][1] == ["Apache-2.0"] and found[7][1] == ["GPL-3.0"] and found[5][1] == []
    assert found[8][1] == ["CC-BY-NC-4.0"]  # a grant outweighs the reservation
    assert found[9][1] == ["Apache-2.0"] and found[10][1] == []  # the order of a rule counts
    assert L.scan(df).count() == len(CASES)


def test_every_sentence_is_normal_and_hinted():
    for sentence in L.SENTENCES:
        hinted = any(h in sentence for h in L.HINTS) or sentence.startswith("under ")
        assert plain(sentence) == sentence and hinted, sentence
    for verb in re.search(r"\(\?:(licensed[^)]*)\)", L.NOTICE)[1].split("|"):
        assert any(h in verb for h in L.HINTS)
    known = set(L.SENTENCES.values()) | {f"{n}:spdx" for n in L.NAMES}
    rules = [*L.RULES.values(), *L.FALLBACK.values()]
    assert all(i in known for some in rules for rule in some for i in rule)
    assert len(L.NAMES) >= 30


def test_no_python_runs(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    plan = L.scan(df)._jdf.queryExecution().toString()
    # "python" alone is also a word of a licence's name.
    assert not re.search("PythonUDF|EvalPython|Arrow|Pandas|Exchange", plan)
    assert L.scan(df).collect() == []


GPL = (
    "This program is free software{} you can redistribute it and/or modify\nit under the terms of the "
    "GNU General Public License as published by\nthe Free Software Foundation{} either version {} of "
    "the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope "
    "that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\n"
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more "
    "details."
)
BSD = (
    "Copyright (c) 2020, Somebody. All rights reserved.\n\nRedistribution and use in source and binary "
    "forms, with or without\nmodification, are permitted provided that the following conditions are "
    "met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of "
    "conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the "
    "above copyright notice,\n   this list of conditions and the following disclaimer in the "
    "documentation\n   and/or other materials provided with the distribution.\n"
)
NAMES_KEPT = (
    "{}. Neither the name of the copyright holder nor the names of its\n   contributors may be used to "
    "endorse or promote products derived from\n   this software without specific prior written "
    "permission.\n"
)
ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software\n   must display the "
    "following acknowledgement:\n   This product includes software developed by Somebody.\n"
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without "
    "fee is hereby granted"
)
HEADERS = {
    "MIT": MIT,
    "GPL-3.0": GPL.format(":", ",", 3),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a "
    "copy of the MPL was not distributed with this\nfile, You can obtain one at "
    "https://mozilla.org/MPL/2.0/.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this '
    "file except in compliance with the License.\nYou may obtain a copy of the License at\n\n"
    "    http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-2.0": GPL.format(";", ";", 2),
    "LGPL-2.1": GPL.format(";", ";", 2.1).replace("GNU General", "GNU Lesser General")
        .replace("This program", "This library"),
    "AGPL-3.0": GPL.format(":", ",", 3).replace("GNU General", "GNU Affero General"),
    "BSD-2-Clause": BSD, "BSD-3-Clause": BSD + NAMES_KEPT.format(3),
    "BSD-4-Clause": BSD + ADVERTISING + NAMES_KEPT.format(4),
    "ISC": ISC + ", provided that the above\ncopyright notice and this permission notice appear in all "
        "copies.",
    "0BSD": ISC + ".",
    "Zlib": "Permission is granted to anyone to use this software for any purpose,\nincluding commercial "
        "applications, and to alter it and redistribute it\nfreely, subject to the following "
        "restrictions:\n\n1. The origin must not be misrepresented.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization\nobtaining a "
        "copy of the software and accompanying documentation covered by\nthis license (the "
        "\"Software\") to use, reproduce, display, distribute,\nexecute, and transmit the Software, and to "
        "prepare derivative works of the\nSoftware, and to permit third-parties to whom the Software is "
        "furnished to\ndo so, all subject to the following:",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MPL-1.1": "The contents of this file are subject to the Mozilla Public License\nVersion 1.1 (the "
        "\"License\"); you may not use this file except in\ncompliance with the License.",
    "EPL-2.0": "This program and the accompanying materials are made\navailable under the terms of the "
        "Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 "
        "International License.",
    "OFL-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
}


def test_official_headers_wrapped_in_comments_and_on_one_line(frame):
    rows, names = [], []
    for name, header in HEADERS.items():
        lines = header.split("\n")
        for text in (header, " ".join(header.split()), "\n".join(f"# {x}" for x in lines),
                     "/*\n" + "\n".join(f" * {x}" for x in lines) + "\n */\nint x;"):
            rows.append((len(rows), f"Some words.\n\n{text}"))
            names.append(name)
    found = result(frame(rows, "doc_id long, text string"))
    assert [(n, found[i][1]) for i, n in enumerate(names)] == [(n, [n]) for n in names]
    assert found == {i: brute(t) for i, t in rows}


# Notices and what they say, stated by hand.
STATED = [
    ("You may obtain a copy of the License at\nyou may not use this file except in compliance with the "
     "License.", []),
    ("SPDX-License-Identifier: GPL-2.0-or-later OR MIT", ["GPL-2.0", "MIT"]),
    ("// SPDX-License-Identifier: (LGPL-2.1+ AND BSD-3-Clause) */\nint x;", ["BSD-3-Clause", "LGPL-2.1"]),
    ("SPDX-License-Identifier:GPL-2.0-only WITH Classpath-exception-2.0", ["GPL-2.0"]),
    ("Copyright Somebody. All rights reserved.", ["Proprietary"]),
    ("All rights reserved.\nReleased under the MIT License.", ["MIT"]),
    ("This project is licensed under the terms of the GNU General Public License, version 3 or later.",
     ["GPL-3.0"]),
    ("Dual licensed under the Apache License, Version 2.0.\r\nReleased under the MIT licence!",
     ["Apache-2.0", "MIT"]),
    ("License: The MIT License (MIT)", []), ("It is not licensed under the MIT License.", []),
    ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
    ("We talked of the MIT License and the GPL 3.0 at length.", []),
    ("no\u0001tice\nLicensed under CC0 1.0 Universal", ["CC0-1.0"]),
]


def test_stated_licences(frame):
    rows = [(i, t) for i, (t, _) in enumerate(STATED)]
    found = result(frame(rows, "doc_id long, text string"))
    assert [found[i][1] for i, _ in rows] == [names for _, names in STATED]
    assert found == {i: brute(t) for i, t in rows}


def test_every_name_by_notice_and_by_tag(frame):
    rows, names = [], []
    for name, titles in L.NAMES.items():
        for text in [f"Licensed under the {t}." for t in titles] + [f"SPDX-License-Identifier: {name}"]:
            rows.append((len(rows), text))
            names.append(name)
    found = result(frame(rows, "doc_id long, text string"))
    assert [found[i][1] for i, _ in rows] == [[n] for n in names]


def test_many_known_sentences_in_one_take_time_in_proportion(frame):
    text = "All rights reserved\n" * 20_000
    grants = "Redistribution and use in source and binary forms, with or without modification, are " \
        "permitted provided that the following conditions are met:\n" * 3_000  # fmt: skip
    found = result(frame([(1, text), (2, grants), (3, "!" * 200_000 + "x licence")],
                         "doc_id long, text string"))
    assert len(found[1][0]) == 20_000 and found[1][1] == ["Proprietary"]
    assert len(found[2][0]) == 3_000 and found[2][1] == [] and found[3] == ([], [])


def test_sentences_of_another_table_need_no_hint(frame):
    df = frame([(1, "Do as you please."), (2, "Nothing here.")], "doc_id long, text string")
    rows = L.scan(df, sentences={"do as you please": "free"}, rules={"Free": [["free"]]}).collect()
    assert {r.doc_id: r.licenses for r in rows} == {1: ["Free"], 2: []}
