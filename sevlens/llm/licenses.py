"""Licence scan by sentence rules.

Texts are cut into sentences, each normalised to lower-case letters and digits between single
spaces and mapped to the identifier of a known licence sentence.  A rule is an ordered sequence
of identifiers; it holds where they follow one another in a text, other sentences between known
ones aside.  Longer rules are matched first and use their sentences up, so that a rule contained in another
holds only where it stands by itself.  The holder's name in a sentence on contributors is free.  "All rights
reserved" belongs to many licences' headers: it stands for a rule of its own only in a text without another
licence.  Texts are cut twice, at line ends and across them, so that both a licence line of its
own and a wrapped paragraph are found; of what one cut sees in part, the fuller rule of the other cut counts.

Defined results: null, empty and unknown texts have no licence; whole texts are read whatever their
length; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Known sentences in normal form; a sentence's identifier is its place from 1.
_SENTENCES = (
    "released under the mit license",
    "licensed under the mit license",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "licensed under the apache license version 2 0",
    "licensed under the apache license version 2 0 the license",
    "you may not use this file except in compliance with the license",
    "this work is licensed under the gnu general public license version 3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "licensed under cc by 4 0",
    "licensed under cc by sa 4 0",
    "licensed under cc by nc 4 0",
    "this work is licensed under a creative commons attribution 4 0 international license",
    "all rights reserved",
    # 22-25: the header of sentences 10 and 11 as its colon and semicolon cut it
    "this program is free software",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "this program is distributed in the hope that it will be useful but without any warranty",
    "without even the implied warranty of merchantability or fitness for a particular purpose",
)
# Fixed values: (licence, identifiers in order).
_RULES = (
    ("MIT", (1,)), ("MIT", (2,)), ("MIT", (3, 4, 5)), ("Apache-2.0", (6,)), ("Apache-2.0", (7, 8)), ("GPL-3.0", (9,)),
    ("GPL-3.0-or-later", (10, 11)), ("BSD-2-Clause", (12, 13, 14)), ("BSD-3-Clause", (12, 13, 14, 15)), ("ISC", (16,)), ("CC-BY-4.0", (17,)),
    ("CC-BY-4.0", (20,)), ("CC-BY-SA-4.0", (18,)), ("CC-BY-NC-4.0", (19,)),
    ("GPL-3.0-or-later", (22, 23, 24, 25)),
)
#: Ends of sentences where lines end sentences, and where only marks and blank lines do.
LINE_END = r"[.:;!?][ \t]+|\r?\n"
MARK_END = r"[.:;!?][ \t\r\n]+|\r?\n[ \t]*\r?\n"
#: The licence and the sentence that count only where no other licence holds.
WEAK = ("Proprietary", 21)
#: What a sentence on the names of contributors begins with, whoever the holder is.
HOLDER, ANY_HOLDER = "^(neither the name of .* )?nor the names of its contributors ", "nor the names of its contributors "

# Fixed values: (licence, its header); rules come from cutting them like any text.
_HEADERS = [
    ("GPL-2.0-only", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
]
# Fixed values: (licence, version, name of the licence) of one header, as programs and libraries punctuate it.
_HEADERS += [
    (f"{name}-or-later", f"This {what} is free software{first} you can redistribute it and/or modify it under the terms of the GNU {title} as "
                         f"published by the Free Software Foundation{second} either version {version} of the License, or (at your option) any later version.")
    for name, version, title in (("GPL-2.0", "2", "General Public License"), ("GPL-3.0", "3", "General Public License"),
                                 ("LGPL-2.1", "2.1", "Lesser General Public License"), ("LGPL-3.0", "3", "Lesser General Public License"),
                                 ("AGPL-3.0", "3", "Affero General Public License"))
    for what in ("program", "library") for first, second in ((";", ";"), (":", ","))]
# Licences named by a tag.
_TAGGED = ("MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
           "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "BSD-2-Clause", "BSD-3-Clause",
           "ISC", "Unlicense", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Zlib", "0BSD")
_HEADERS += [(name, f"SPDX-License-Identifier: {name}") for name in _TAGGED]


def _known() -> tuple[tuple[str, ...], tuple[tuple[str, tuple[int, ...]], ...]]:
    """All sentences and rules, those of the headers behind the listed ones, longer rules first."""
    place = {s: i for i, s in enumerate(_SENTENCES, 1)}
    rules = list(_RULES)
    for name, text in _HEADERS:
        parts = [re.sub("[^a-z0-9]+", " ", part).strip() for part in re.split(MARK_END, text.lower())]
        rules.append((name, tuple(place.setdefault(x, len(place) + 1) for x in parts if x)))
    return tuple(place), tuple(sorted(rules, key=lambda r: -len(r[1])))


SENTENCES, RULES = _known()


def key(ids) -> str:
    """Identifiers as they stand in a line of them."""
    return "".join(f",{i}," for i in ids)


#: (licence, licence with a rule that contains one of its rules).
WITHIN = tuple(sorted({(short, long) for short, a in RULES for long, b in RULES if short != long and key(a) in key(b)}))


def identifiers(text: Column, end: str) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = F.array(*[F.lit(s) for s in SENTENCES])
    normal = lambda s: F.regexp_replace(F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")), HOLDER, ANY_HOLDER)
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.transform(F.split(lower, end), lambda s: F.array_position(known, normal(s))), lambda i: i > 0)


def matched(ids: Column) -> Column:
    """Licences of the rules that hold; a rule uses up the sentences it matches."""
    none = F.array().cast("array<string>")
    line = F.array_join(F.transform(F.filter(ids, lambda i: i != WEAK[1]), lambda i: F.concat(F.lit(","), i.cast("string"), F.lit(","))), "")
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(key(r)).alias("key")) for name, r in RULES])
    step = lambda a, r: F.struct(
        F.replace(a["line"], r["key"], F.lit(",0,")).alias("line"),
        F.when(F.contains(a["line"], r["key"]), F.array_append(a["found"], r["name"])).otherwise(a["found"]).alias("found"))
    return F.when(F.size(ids) > 0, F.aggregate(rules, F.struct(line.alias("line"), none.alias("found")), step, lambda a: a["found"])).otherwise(none)


def whole(own: Column, other: Column) -> Column:
    """The licences of a cut without those of which the other cut alone sees a fuller rule."""
    pairs = F.array(*[F.struct(F.lit(short).alias("short"), F.lit(long).alias("long")) for short, long in WITHIN])
    return F.filter(own, lambda n: ~F.exists(pairs, lambda p: (p["short"] == n) & F.array_contains(other, p["long"]) & ~F.array_contains(own, p["long"])))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, sentence_ids, licenses): known sentences line by line, sorted licences of either cut."""
    cut = docs.select("doc_id", identifiers(F.col("text"), LINE_END).alias("a"), identifiers(F.col("text"), MARK_END).alias("b"))
    held = cut.select("*", matched(F.col("a")).alias("la"), matched(F.col("b")).alias("lb"))
    names = F.array_sort(F.array_distinct(F.concat(whole(F.col("la"), F.col("lb")), whole(F.col("lb"), F.col("la")))))
    weak = F.array_contains("a", WEAK[1]) | F.array_contains("b", WEAK[1])
    return held.select("doc_id", F.array_join(F.col("a").cast("array<string>"), ",").alias("sentence_ids"),
                       F.when((F.size(names) == 0) & weak, WEAK[0]).otherwise(F.array_join(names, ",")).alias("licenses"))
