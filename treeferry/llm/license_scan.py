"""Licences recognised by their sentences.

A text is cut into sentences, and each is normalised and looked up among known licence
sentences, or else each of its lines. The identifiers found, in the order of the text, form a
sequence; ordered rules name the licence whose sequence of identifiers stands in it. Lines of
the form ``SPDX-License-Identifier: MIT OR Apache-2.0`` are read as expressions.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeferry.llm.columns import LiteralIndex, let

# Sentences of licences. A sentence ends at its first mark before white space.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "mit-keep": ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",),
    "mit-warranty": ("The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",),
    "apache-file": ("Licensed under the Apache License, Version 2.0 (the \"License\")",),
    "apache-use": ("you may not use this file except in compliance with the License",),
    "apache-copy": ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at"),
    "apache-basis": ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",),
    "gpl-free": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",),
    "gpl-hope": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",),
    "gpl-implied": ("without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",),
    "bsd-permit": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",),
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",),
    "bsd-binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",),
    "bsd-endorse": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "gpl-terms": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",),
    "gpl2-only": ("you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",),
    "lgpl-terms": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",),
    "later-2": ("either version 2 of the License, or (at your option) any later version",),
    "later-21": ("either version 2.1 of the License, or (at your option) any later version",),
    "lgpl3-free": tuple(f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version" for what in ("program", "library")),
    "agpl3-free": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",),
    "mpl2-file": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "isc-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    "cc0-dedicated": ("This work is dedicated to the public domain under CC0 1.0",),
    "unlicense-free": ("This is free and unencumbered software released into the public domain",),
}

# What licences are called where a text only names one.
NAMES: dict[str, tuple[str, ...]] = {
    "mit-notice": ("MIT License", "MIT"),
    "apache-notice": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0"),
    "gpl2-notice": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GPL 2.0", "GPLv2"),
    "gpl3-notice": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPL 3.0", "GPLv3"),
    "lgpl21-notice": ("GNU Lesser General Public License, version 2.1", "LGPL 2.1", "LGPLv2.1"),
    "lgpl3-notice": ("GNU Lesser General Public License, version 3", "LGPL 3.0", "LGPLv3"),
    "agpl3-notice": ("GNU Affero General Public License, version 3", "AGPL 3.0", "AGPLv3"),
    "mpl2-notice": ("Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "bsd2-notice": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD 2-Clause"),
    "bsd3-notice": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "BSD 3-Clause"),
    "isc-notice": ("ISC License", "ISC"),
    "cc0-notice": ("CC0 1.0",),
    "by4-notice": ("CC BY 4.0",),
    "by-sa4-notice": ("CC BY-SA 4.0",),
    "by-nc4-notice": ("CC BY-NC 4.0",),
    "unlicense-notice": ("Unlicense",),
}

#: (licence, sequence of sentence identifiers), tried in this order. What a rule has
#: matched is used up, so a longer rule comes before those that are part of it.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit-grant", "mit-keep", "mit-warranty")),
    ("Apache-2.0", ("apache-file", "apache-use", "apache-copy", "apache-basis")),
    ("GPL-3.0", ("gpl-free", "gpl-hope")),
    ("BSD-3-Clause", ("bsd-permit", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-permit", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-file",)),
    ("GPL-3.0", ("gpl-free",)),
    ("MIT", ("mit-notice",)),
    ("Apache-2.0", ("apache-notice",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("CC-BY-NC-4.0", ("by-nc4-notice",)),
    ("CC-BY-4.0", ("by4-notice",)),
    ("GPL-2.0", ("gpl-terms", "later-2", "gpl-hope")),
    ("GPL-2.0", ("gpl-terms", "later-2")),
    ("GPL-2.0", ("gpl2-only",)),
    ("LGPL-2.1", ("lgpl-terms", "later-21")),
    ("LGPL-3.0", ("lgpl3-free",)),
    ("AGPL-3.0", ("agpl3-free",)),
    ("MPL-2.0", ("mpl2-file",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense-free",)),
    ("GPL-2.0", ("gpl2-notice",)),
    ("LGPL-2.1", ("lgpl21-notice",)),
    ("LGPL-3.0", ("lgpl3-notice",)),
    ("AGPL-3.0", ("agpl3-notice",)),
    ("MPL-2.0", ("mpl2-notice",)),
    ("ISC", ("isc-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("BSD-2-Clause", ("bsd2-notice",)),
    ("BSD-3-Clause", ("bsd3-notice",)),
    ("CC-BY-SA-4.0", ("by-sa4-notice",)),
    ("Unlicense", ("unlicense-notice",)),
)

FOUND = "array<struct<line:int,sentence:int,whole:boolean,id:string>>"
#: So many unknown sentences may stand between two of one licence, such as holders' names.
GAP = 2
#: Words of a known sentence shorter than this are anchors only where it has no longer one.
ANCHOR_LETTERS = 6
#: A sentence ends at one of these marks before white space or the text's end. Some texts
#: break lines inside sentences and others have a sentence a line. Every cut by sentence is
#: one by line as well, so a sentence that is not known as a whole is looked up line by line.
BY_SENTENCE = r"[.!?;]+(?:\s+|$)|\n[ \t\r]*\n"


#: A mark in "v. 2.0" ends no sentence.
SHIELD = r"(^|[^A-Za-z0-9])([Vv]|[Vv]er|[Vv]ers|[Nn]o)[.][ \t\r\n]+([0-9])"
#: Ways to say that something is under a licence, of normalised sentences; all become the first.
OPENING = "licensed under "
OPENINGS = r"^(?:(?:this(?: [a-z0-9]+){1,3} is )?(?:made )?(?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the )?|license (?:the )?)"
#: What a text with such a sentence contains.
OPENED = r"(?:released|licensed|distributed|available)[^a-z0-9]+under|license[^a-z0-9]"

TAG = "SPDX-License-Identifier:"
ID = r"[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?[+]?"
#: Ends of SPDX names that say which versions are meant; the licence is the same.
VERSIONS = r"(?:-only|-or-later|[+])$"
JOINING, NO_NAMES = ("AND", "OR", "and", "or"), ("AND", "OR", "and", "or", "NONE", "NOASSERTION")


def normalised(sentence: str) -> str:
    plain = re.sub("[^a-z0-9]+", " ", re.sub(SHIELD, r"\1\2 \3", sentence).lower()).strip(" ")
    return re.sub(OPENINGS, OPENING, plain)


def _known() -> dict[str, str]:
    """Identifier by normalised sentence, of whole sentences and of notices that name a licence."""
    named = {normalised(OPENING + name): identifier for identifier, names in NAMES.items() for name in names}
    return named | {normalised(variant): identifier for identifier, variants in SENTENCES.items() for variant in variants}


def anchors(known: Iterable[str]) -> list[str]:
    """Words such that every known sentence contains one, so texts without them need no
    cutting: always the word in most of the sentences that have none yet."""
    left = {key: set(re.findall("[a-z0-9]+", key)) for key in known}
    left = {key: {w for w in words if len(w) >= ANCHOR_LETTERS} or {max(words, key=lambda w: (len(w), w))} for key, words in left.items() if words}
    found = []
    while left:
        counts = Counter(word for words in left.values() for word in words)
        best = max(counts, key=lambda w: (counts[w], len(w), w))
        found.append(best)
        left = {key: words for key, words in left.items() if best not in words}
    return found


def _normalised(sentence: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " ")), OPENINGS, OPENING)


def _prefilter(known: Iterable[str]) -> str:
    """A pattern that every lower-cased text with a known sentence matches."""
    opened = [OPENED] if any(key.startswith(OPENING) for key in known) else []
    return "|".join([*anchors(key for key in known if not key.startswith(OPENING)), *opened]) or r"(?!)"


def _expression(line: Column) -> Column:
    """The longest SPDX expression that a line begins with: ``expression`` (its parts joined by
    blanks) and ``names`` (its licences, without exceptions and versions)."""
    operand, after_name, exception, after_all, over = range(5)
    parts = F.regexp_extract_all(line, F.lit(r"([()]|[^ \t()]+)"), F.lit(1))
    nothing = F.array().cast("array<string>")
    start = F.struct(F.lit(operand).alias("want"), nothing.alias("read"), nothing.alias("whole"), nothing.alias("names"))

    def step(state: Column, part: Column) -> Column:
        name, want = F.regexp_extract(part, f"^({ID})", 1), state["want"]
        named = (name != "") & want.isin(operand, exception)
        closes = (part == ")") & want.isin(after_name, after_all)
        opens = (part == "(") & (want == operand)
        joins = part.isin(*JOINING) & want.isin(after_name, after_all)
        excepts = part.isin("WITH", "with") & (want == after_name)
        read = F.array_append(state["read"], F.when(named, name).otherwise(part))
        rest = F.when(want == operand, F.lit(after_name)).otherwise(F.lit(after_all))
        return F.struct(
            F.when(named, F.when(name == part, rest).otherwise(F.lit(over))).when(closes, F.lit(after_all)).when(opens | joins, F.lit(operand)).when(excepts, F.lit(exception)).otherwise(F.lit(over)).alias("want"),
            read.alias("read"),
            F.when(named | closes, read).otherwise(state["whole"]).alias("whole"),
            F.when(named & (want == operand) & ~name.isin(*NO_NAMES), F.array_append(state["names"], F.regexp_replace(name, VERSIONS, ""))).otherwise(state["names"]).alias("names"),
        )

    return F.aggregate(parts, start, step, lambda state: F.struct(F.array_join(state["whole"], " ").alias("expression"), state["names"].alias("names")))


def _sequence(text: Column, index: LiteralIndex) -> Column:
    """The known identifiers of a text in order: whole sentences, and lines of sentences
    that are not known. ``sentence`` and ``line`` are places among those of the text."""
    id_of = lambda s: F.get(index.find(s), F.lit(0))["id"]
    unit = lambda j, whole, id: F.struct(j.alias("sentence"), whole.alias("whole"), id.alias("id"))

    def lines(own: Column, j: Column) -> Column:
        parts = F.filter(F.transform(F.split(own, r"\n"), _normalised), lambda s: s != "")
        return F.transform(parts, lambda s: unit(j, F.lit(False), id_of(s)))

    def units(s: Column, j: Column) -> Column:
        whole = F.array(unit(j, F.lit(True), s["id"]))
        return F.when(s["id"].isNull() & F.contains(s["own"], F.lit("\n")), lines(s["own"], j)).otherwise(whole)

    shielded = F.regexp_replace(text, SHIELD, "$1$2 $3")
    sentences = F.transform(F.split(shielded, BY_SENTENCE), lambda s: F.struct(s.alias("own"), _normalised(s).alias("plain")))
    known = F.transform(F.filter(sentences, lambda s: s["plain"] != ""), lambda s: F.struct(s["own"].alias("own"), id_of(s["plain"]).alias("id")))
    placed = F.transform(F.flatten(F.transform(known, units)), lambda x, i: F.struct(i.alias("line"), x["sentence"].alias("sentence"), x["whole"].alias("whole"), x["id"].alias("id")))
    return F.filter(placed, lambda x: x["id"].isNotNull())


def _joined(found: Column) -> Column:
    """``;a;b;|;c;``: identifiers in order, with a bar where the gap is too wide. It is
    counted in sentences between two whole ones, and else in lines."""

    def wide(x: Column, before: Column) -> Column:
        return F.when(x["whole"] & before["whole"], x["sentence"] - before["sentence"]).otherwise(x["line"] - before["line"]) > GAP + 1

    parts = F.transform(
        found,
        lambda x, j: F.concat(F.when(wide(x, F.get(found, j - 1)), F.lit("|;")).otherwise(""), x["id"], F.lit(";")),
    )
    return F.concat(F.lit(";"), F.array_join(parts, ""))


def scan_licences(docs: DataFrame, text: str = "text", rules: Sequence[tuple[str, tuple[str, ...]]] = RULES, known: Mapping[str, str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``sentences`` (the known identifiers in
    order, as ``;a;b;|;c;``, or empty), ``licences`` (names without repeats, in the order
    of the rules and then those of SPDX expressions, joined by commas, or empty),
    ``n_sentences`` recognised, and ``expressions`` (SPDX expressions without repeats, as
    ``MIT OR Apache-2.0;ISC``, or empty). Of a malformed one counts what is whole; parentheses
    that do not match are kept. Names that no rule knows are licences as they are written.

    Whole texts are scanned. Null and empty texts have no licence. Each row is scanned
    where it is read; only ``doc_id`` and the text are used, so repeated rows, null ids
    and extra columns of any name make no difference. An empty table gives an empty result.
    A text is cut into an array of its sentences: it needs some times its own size in memory.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    known = {normalised(s): i for s, i in (known or _known()).items()}
    index = LiteralIndex({s: [{"id": i}] for s, i in known.items()}, "id:string")
    # Lower-cased as the sentences will be.
    anchored = F.lower(body).rlike(_prefilter(known))
    none = F.lit(None).cast(FOUND)
    lines = F.when(F.contains(body, F.lit(TAG)), F.regexp_extract_all(body, F.lit(rf"{TAG}([^\r\n]*)"), F.lit(1)))
    found = docs.select(
        "doc_id",
        F.when(anchored, let(body, lambda own: _sequence(own, index))).otherwise(none).alias("found"),
        F.transform(lines, _expression).alias("spdx"),
    )
    some = found.select("doc_id", "found", "spdx", F.when(F.size("found") > 0, _joined(F.col("found"))).otherwise("").alias("sentences"))
    steps = F.from_json(
        F.lit("[" + ",".join(f'{{"name":"{name}","ids":";{";".join(ids)};"}}' for name, ids in rules) + "]"),
        "array<struct<name:string,ids:string>>",
    )
    start = F.struct(F.col("sentences").alias("left"), F.array().cast("array<string>").alias("names"))

    def apply(state: Column, rule: Column) -> Column:
        fits = F.contains(state["left"], rule["ids"])
        return F.struct(
            F.when(fits, F.replace(state["left"], rule["ids"], F.lit(";|;"))).otherwise(state["left"]).alias("left"),
            F.when(fits, F.array_append(state["names"], rule["name"])).otherwise(state["names"]).alias("names"),
        )

    nothing = F.array().cast("array<string>")
    names = F.when(F.col("sentences") == "", nothing).otherwise(F.aggregate(steps, start, apply, lambda state: state["names"]))
    stated = F.coalesce(F.flatten(F.transform("spdx", lambda x: x["names"])), nothing)
    expressions = F.filter(F.transform("spdx", lambda x: x["expression"]), lambda x: x != "")
    return some.select(
        "doc_id",
        "sentences",
        F.array_join(F.array_distinct(F.concat(names, stated)), ",").alias("licences"),
        F.coalesce(F.array_join(F.array_distinct(expressions), ";"), F.lit("")).alias("expressions"),
        F.greatest(F.size(F.coalesce("found", F.array().cast(FOUND))), F.lit(0)).alias("n_sentences"),
    )


def licensed_rows(docs: DataFrame, licences: Sequence[str]) -> DataFrame:
    """``doc_id`` of the rows that carry one of these licences."""
    found = scan_licences(docs).where(F.arrays_overlap(F.split("licences", ","), F.array(*map(F.lit, licences))))
    return found.select("doc_id", "licences")


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in _known().items())
    left, names = "sentences", []
    for name, ids in RULES:
        sequence = quote(";" + ";".join(ids) + ";")
        names.append(f"CASE WHEN contains({left}, {sequence}) THEN '{name}' END")
        left = f"replace({left}, {sequence}, ';|;')"
    names = ", ".join(names)
    plain = lambda x: f"regexp_replace(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), '{OPENINGS}', '{OPENING}')"
    operand = rf"[ \t(]*{ID}(?:[ \t]+(?:WITH|with)[ \t]+{ID})?(?:[ \t]*[)])*"
    expression = rf"^{operand}(?:[ \t]*(?:{'|'.join(JOINING)})(?:[ \t]|[(]){operand})*"
    joining = ", ".join(map(quote, NO_NAMES))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
known(s, id) AS (VALUES {known}),
cut AS (SELECT r, string_split_regex(regexp_replace(t, '{SHIELD}', '\1\2 \3', 'g'), '{BY_SENTENCE}') AS own FROM d),
spread AS (SELECT r, unnest(own) AS own, unnest(range(len(own))) AS place FROM cut),
sentence AS (SELECT r, own, row_number() OVER (PARTITION BY r ORDER BY place) AS j, {plain("own")} AS s FROM spread WHERE {plain("own")} <> ''),
whole AS (SELECT r, own, j, id FROM sentence LEFT JOIN known USING (s)),
parts AS (SELECT r, j, list_filter(list_transform(string_split(own, chr(10)), lambda x: {plain("x")}), lambda x: x <> '') AS ss
  FROM whole WHERE id IS NULL AND contains(own, chr(10))),
line AS (SELECT r, j, unnest(ss) AS s, unnest(range(len(ss))) AS k FROM parts),
unit AS (SELECT r, j, 0 AS k, TRUE AS entire, id FROM whole WHERE id IS NOT NULL OR NOT contains(own, chr(10))
  UNION ALL SELECT r, j, k, FALSE, id FROM line LEFT JOIN known USING (s)),
placed AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY j, k) AS i FROM unit),
hit AS (SELECT *, CASE WHEN entire AND lag(entire) OVER o THEN j - lag(j) OVER o ELSE i - lag(i) OVER o END AS gap
  FROM placed WHERE id IS NOT NULL WINDOW o AS (PARTITION BY r ORDER BY i)),
seq AS (SELECT r, count(*) AS n, ';' || string_agg(CASE WHEN gap > {GAP + 1} THEN '|;' ELSE '' END || id || ';', '' ORDER BY i) AS sentences
  FROM hit GROUP BY r),
tagged AS (SELECT r, list_transform(regexp_extract_all(t, '{TAG}([^\r\n]*)', 1), lambda x: regexp_extract(x, '{expression}', 0)) AS found
  FROM d WHERE contains(t, '{TAG}')),
spdx AS (SELECT r, list_filter(list_transform(found, lambda x: array_to_string(regexp_extract_all(x, '[()]|[^ \t()]+'), ' ')), lambda x: x <> '') AS expressions,
  list_filter(flatten(list_transform(found, lambda x: list_transform(list_filter(
    regexp_extract_all(regexp_replace(x, '[ \t](?:WITH|with)[ \t]+{ID}', '', 'g'), '{ID}'), lambda y: y NOT IN ({joining})), lambda y: regexp_replace(y, '{VERSIONS}', '')))), lambda y: TRUE) AS stated
  FROM tagged),
every AS (SELECT doc_id, n, sentences, expressions, list_concat(CASE WHEN sentences IS NULL THEN [] ELSE list_filter([{names}], lambda x: x IS NOT NULL) END, coalesce(stated, [])) AS names
  FROM d LEFT JOIN seq USING (r) LEFT JOIN spdx USING (r))
SELECT doc_id, coalesce(sentences, '') AS sentences, CAST(coalesce(n, 0) AS INTEGER) AS n_sentences,
  array_to_string(list_filter(names, lambda x, k: list_position(names, x) = k), ',') AS licences,
  coalesce(array_to_string(list_filter(expressions, lambda x, k: list_position(expressions, x) = k), ';'), '') AS expressions
FROM every
"""


ORACLE = _sql()
