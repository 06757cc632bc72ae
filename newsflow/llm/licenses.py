"""Licences named or quoted in texts, by rules over known sentences.

A text is cut into sentences; each is normalised and looked up among known licence sentences. A
licence is found where the identifiers of its rule occur in the rule's order. All of it is one
projection of built-in functions: nothing is shuffled, joined or collected.

A known sentence may begin after any break (end of sentence, of clause or of line) and run to the
next end of its sentence, clause or line; the longest known one counts, and identifiers stand in the
order of the places where their sentences begin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.bind import let

# Names of public licences in notices such as "Licensed under the MIT License".
NAMES = {
    "0BSD": ["zero clause bsd license", "bsd zero clause license"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu agplv3", "agplv3", "agpl 3 0"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license"],
    "Artistic-2.0": ["artistic license 2 0", "artistic license version 2 0"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license"],
    "BSD-4-Clause": ["bsd 4 clause license", "4 clause bsd license"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0"],
    "CC0-1.0": ["cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal"],
    "CDDL-1.0": ["common development and distribution license version 1 0", "cddl 1 0"],
    "EPL-1.0": ["eclipse public license v1 0", "eclipse public license 1 0"],
    "EPL-2.0": ["eclipse public license v2 0", "eclipse public license 2 0"],
    "EUPL-1.2": ["eupl version 1 2", "eupl 1 2", "european union public licence 1 2"],
    "GPL-2.0": ["gnu general public license version 2", "gnu gplv2", "gplv2", "gpl 2 0"],
    "GPL-3.0": ["gnu general public license version 3", "gnu gplv3", "gplv3", "gpl 3 0"],
    "ISC": ["isc license"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "gnu lgplv2 1", "lgpl 2 1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lgplv3", "lgpl 3 0"],
    "MIT": ["mit license", "mit licence"],
    "MPL-1.1": ["mozilla public license version 1 1"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0"],
    "MS-PL": ["microsoft public license"],
    "OFL-1.1": ["sil open font license version 1 1"],
    "PostgreSQL": ["postgresql license"],
    "Python-2.0": ["python software foundation license version 2"],
    "Unlicense": ["unlicense"],
    "WTFPL": ["wtfpl", "do what the fuck you want to public license"],
    "Zlib": ["zlib license"],
}
# The parts of the Creative Commons 4.0 names, short and long.
CC_PARTS = {
    "by": "attribution",
    "by nc": "attribution noncommercial",
    "by nd": "attribution noderivatives",
    "by sa": "attribution sharealike",
    "by nc nd": "attribution noncommercial noderivatives",
    "by nc sa": "attribution noncommercial sharealike",
}
for _short, _long in CC_PARTS.items():
    NAMES[f"CC-{_short.upper().replace(' ', '-')}-4.0"] = [
        f"cc {_short} 4 0", f"creative commons {_long} 4 0 international license",
    ]
# Sentences of public licences, normalised as `normal` does, with their identifiers.
SENTENCES = {
    "apache license version 2 0 january 2004": "apache-title",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at": "apache-obtain",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and or sell copies of the software and to permit persons to whom the software is furnished to "
    "do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software": "mit-notice-kept",
    "permission to use copy modify and or distribute this software for any purpose with or without "
    "fee is hereby granted provided that the above copyright notice and this permission notice "
    "appear in all copies": "isc-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without "
    "fee is hereby granted": "0bsd-grant",
    "permission is granted to anyone to use this software for any purpose including commercial "
    "applications and to alter it and redistribute it freely subject to the following restrictions":
        "zlib-grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of "
    "the software and accompanying documentation covered by this license the software to use "
    "reproduce display distribute execute and transmit the software and to prepare derivative works "
    "of the software and to permit third parties to whom the software is furnished to do so all "
    "subject to the following": "bsl-grant",
    "permission to use copy modify and distribute this software and its documentation for any purpose "
    "without fee and without a written agreement is hereby granted provided that the above copyright "
    "notice and this paragraph and the following two paragraphs appear in all copies":
        "postgresql-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-free",
    "everyone is permitted to copy and distribute verbatim or modified copies of this license "
    "document and changing it is allowed as long as the name is changed": "wtfpl-copy",
    "the person who associated a work with this deed has dedicated the work to the public domain by "
    "waiving all of his or her rights to the work worldwide under copyright law including all related "
    "and neighboring rights to the extent allowed by law": "cc0-deed",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions "
    "and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the "
    "distribution": "bsd-binary",
    "all advertising materials mentioning features or use of this software must display the following "
    "acknowledgement": "bsd-advertising",
    "neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission": "bsd-names",
    "this source code form is subject to the terms of the mozilla public license v": "mpl-form",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org "
    "mpl 2 0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org "
    "mpl 2 0": "mpl2-copy",
    "the contents of this file are subject to the mozilla public license version 1 1 the license":
        "mpl1-contents",
    "the contents of this file are subject to the terms of the common development and distribution "
    "license the license": "cddl-contents",
    "this program and the accompanying materials are made available under the terms of the eclipse "
    "public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2-available",
    "this program and the accompanying materials are made available under the terms of the eclipse "
    "public license v1 0 which accompanies this distribution and is available at http www eclipse org "
    "legal epl v10 html": "epl1-available",
    "mit license": "mit-title",
    "the mit license": "mit-title",
    "the mit license mit": "mit-title",
    "all rights reserved": "reserved",
}
# Licences whose header names the foundation and a version.
FREE_HEADERS = {
    "AGPL-3.0": ("gnu affero general public license", "3"),
    "GPL-2.0": ("gnu general public license", "2"),
    "GPL-3.0": ("gnu general public license", "3"),
    "LGPL-2.1": ("gnu lesser general public license", "2 1"),
    "LGPL-3.0": ("gnu lesser general public license", "3"),
}
_FREE = "you can redistribute it and or modify it under the terms of the "
for _name, (_title, _version) in FREE_HEADERS.items():
    _by = "as published by the free software foundation"
    SENTENCES |= {
        f"{_FREE}{_title} {_by} either version {_version} of the license or at your option any later "
        "version": f"{_name}:free",
        f"{_FREE}{_title} version {_version} {_by}": f"{_name}:free",
        f"{_FREE}{_title} {_by} version {_version} of the license": f"{_name}:free",
    }
# On one line the title runs into the grant.
_grant = next(text for text, i in SENTENCES.items() if i == "mit-grant")
SENTENCES |= {f"{text} {_grant}": "mit-grant" for text in ("mit license", "the mit license mit")}
# A notice is known by "under" and the name; `normal` forms of names come from the table above.
SENTENCES |= {f"under {n}": f"{k}:notice" for k, names in NAMES.items() for n in names}
# Rules in order of identifiers; any rule of a licence is enough. Notices, headers and
# SPDX tags name one licence each; the other rules are listed.
RULES = {
    "0BSD": [["0bsd-grant"]],
    "Apache-2.0": [["apache-title"], ["apache-comply", "apache-obtain"]],
    "BSD-2-Clause": [["bsd-grant", "bsd-source", "bsd-binary"]],
    "BSD-3-Clause": [["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]],
    "BSD-4-Clause": [["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names"]],
    "BSL-1.0": [["bsl-grant"]],
    "CC0-1.0": [["cc0-deed"]],
    "CDDL-1.0": [["cddl-contents"]],
    "EPL-1.0": [["epl1-available"]],
    "EPL-2.0": [["epl2-available"]],
    "ISC": [["isc-grant"]],
    "MIT": [["mit-title", "mit-grant"], ["mit-grant", "mit-notice-kept"]],
    "MPL-1.1": [["mpl1-contents"]],
    "MPL-2.0": [["mpl-form", "mpl2-copy"]],
    "PostgreSQL": [["postgresql-grant"]],
    "Unlicense": [["unlicense-free"]],
    "WTFPL": [["wtfpl-copy"]],
    "Zlib": [["zlib-grant"]],
}
for _name in NAMES:
    RULES.setdefault(_name, []).extend([[f"{_name}:notice"], [f"{_name}:spdx"]])
    if _name in FREE_HEADERS:
        RULES[_name].append([f"{_name}:free"])
# A reservation of all rights says something only of a text that grants none.
FALLBACK = {"Proprietary": [["reserved"]]}
# Every known sentence and every notice holds one of these words, so others are not looked up.
HINTS = (
    "licen", "permi", "redistribut", "copyright", "reserved", "mozilla", "advertising",
    "released", "distributed", "published", "available",
)
SENTENCE_END = r"(?<![.!?])[.!?]++(?=\s|\z)|\n[^A-Za-z0-9\n]*+\n"
CLAUSE_END = r"(?<![;:])[;:]++(?=\s|\z)"
NOTICE = (
    r"^(?:th(?:is|ese) (?:[a-z]+ ){1,3}?(?:is|are) |it is )?(?:dual )?"
    r"(?:licensed|released|distributed|published|available|made available) under "
    r"(?:the terms (?:and conditions )?of )?(?:the |an? )?"
)
NOTICE_TAIL = r" the license$|(?: or (?:at your option )?(?:any )?later(?: version)?| only)$"
SPDX_TAG = r"(?i)^[^a-z0-9]*spdx-license-identifier[:\x01]\s*(.*)$"
_CLAUSE, _SENTENCE = "\x01", "\x02"


def normal(sentence: Column) -> Column:
    """ASCII letters and digits in lower case, everything else one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _notice(plain: Column) -> Column:
    """A normalised notice as "under" and the licence's name; any other sentence as it is."""
    short = F.regexp_replace(F.regexp_replace(plain, NOTICE, "under "), NOTICE_TAIL, "")
    return F.when(plain.rlike(NOTICE), short).otherwise(plain)


def _hints(sentences: dict[str, str] | None) -> str:
    """Pattern that every known sentence matches: the hints, and a word of sentences without one."""
    more = {max(s.split(), key=len) for s in sentences or () if not any(h in s for h in HINTS)}
    return "|".join([*HINTS, *sorted(more)])


def _table(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _spdx(expression: Column) -> Column:
    """Identifiers of the licences that an SPDX expression names; exceptions are no licences."""
    known = _table({name.lower(): f"{name}:spdx" for name in NAMES})
    names = F.split(F.lower(expression), r"[^a-z0-9.+-]+")
    plain = F.transform(names, lambda n: F.regexp_replace(n, r"(?:-only|-or-later|\+)$", ""))
    return F.transform(plain, lambda n: F.element_at(known, n))


def _ids_from(run: Column, table: Column) -> Column:
    """Identifiers of what begins where ``run`` begins: an SPDX tag's, or the longest sentence's."""

    def look_up(end: str) -> Column:
        piece = F.regexp_extract(run, f"^[^{end}]*", 0) if end else run
        return let(normal(piece), lambda plain: F.element_at(table, _notice(plain)))

    expression = F.regexp_extract(F.regexp_extract(run, r"^[^\n]*", 0), SPDX_TAG, 1)
    sentence = F.coalesce(look_up(""), look_up(_CLAUSE), look_up(r"\n"))
    return F.when(expression != "", _spdx(expression)).otherwise(F.array(sentence))


def sentence_ids(text: Column, sentences: dict[str, str] | None = None) -> Column:
    """Identifiers of the known sentences of a text, in the order of their places, repeats included.

    Sentences end with a mark before white space or at a line without a letter or digit, clauses
    with a semicolon or colon before white space. A sentence may run over as many breaks as the
    longest known one has words.
    """
    sentences = sentences or SENTENCES
    table = _table(sentences)
    span = max(len(s.split()) for s in sentences)
    text = F.translate(F.coalesce(text.cast("string"), F.lit("")), _CLAUSE + _SENTENCE, "  ")
    text = F.regexp_replace(text, r"\r\n?", "\n")
    marked = F.regexp_replace(F.regexp_replace(text, SENTENCE_END, _SENTENCE), CLAUSE_END, _CLAUSE)
    hinted = F.filter(
        F.split(marked, _SENTENCE), lambda s: F.lower(s).rlike(_hints(sentences))
    )

    def of_sentence(sentence: Column) -> Column:
        def of_pieces(pieces: Column) -> Column:
            def of_piece(piece: Column, i: Column) -> Column:
                run = F.array_join(F.slice(pieces, i + 1, span), "")
                found = let(run, lambda run: _ids_from(run, table))
                none = F.array().cast("array<string>")
                return F.when(piece.rlike("[A-Za-z0-9]"), found).otherwise(none)

            return F.flatten(F.transform(pieces, of_piece))

        # Each piece keeps the break after it, so a run knows where its clause and its line end.
        return let(F.split(sentence, f"(?<=[{_CLAUSE}\n])"), of_pieces)

    return F.filter(F.flatten(F.transform(hinted, of_sentence)), lambda x: x.isNotNull())


def _holds(ids: Column, rule: list[str]) -> Column:
    """Whether the rule's identifiers occur in its order; one walk over the identifiers."""
    if len(rule) == 1:
        return F.array_contains(ids, rule[0])
    wanted = F.array(*map(F.lit, rule))
    walked = F.aggregate(
        ids, F.lit(0), lambda n, x: F.when(x == F.get(wanted, n), n + 1).otherwise(n)
    )
    return walked == len(rule)


def _contains(longer: list[str], shorter: list[str]) -> bool:
    rest = iter(longer)
    return len(longer) > len(shorter) and all(i in rest for i in shorter)


def matches(
    ids: Column,
    rules: dict[str, list[list[str]]] | None = None,
    fallback: dict[str, list[list[str]]] | None = None,
) -> Column:
    """Licences of which a rule's identifiers occur in its order, others possibly between, sorted.

    A rule does not count where a rule of another licence that contains it matches as well. A
    ``fallback`` licence counts only where no other is found.
    """
    if rules is None:
        rules, fallback = RULES, FALLBACK if fallback is None else fallback

    def named(table: dict[str, list[list[str]]]) -> Column:
        found = []
        for name, some in sorted(table.items()):
            hits = []
            for rule in some:
                above = [r for n, rs in table.items() if n != name for r in rs if _contains(r, rule)]
                hit = _holds(ids, rule)
                for longer in above:
                    hit = hit & ~_holds(ids, longer)
                hits.append(hit)
            found.append(F.when(F.greatest(*hits, F.lit(False), F.lit(False)), F.lit(name)))
        return F.filter(F.array(*found), lambda x: x.isNotNull())

    if not fallback:
        return named(rules)
    return let(
        named(rules), lambda found: F.when(F.size(found) > 0, found).otherwise(named(fallback))
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: dict[str, str] | None = None,
    rules: dict[str, list[list[str]]] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, sentence_ids and licenses, both arrays.

    NULL and empty texts, and texts without a known sentence, have empty arrays. A licence is listed
    once however often it occurs; several are in order of name. Of the licences of one family only
    the one with the longest matching rule is listed, so a text that quotes two of them in full shows
    that one. Repeated rows give repeated rows, an empty table an empty table; other columns are not
    looked at.
    """
    hinted = F.lower(F.col(text_col)).rlike(_hints(sentences))
    none = F.array().cast("array<string>")
    ids = F.when(hinted, sentence_ids(F.col(text_col), sentences)).otherwise(none)
    rows = docs.select(F.col(id_col).alias("doc_id"), ids.alias("sentence_ids"))
    return rows.select(
        "doc_id",
        "sentence_ids",
        F.when(F.size("sentence_ids") > 0, matches(F.col("sentence_ids"), rules)).otherwise(none)
        .alias("licenses"),
    )
