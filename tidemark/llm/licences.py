"""Licence recognition by sentence rules (operator 5, DataFrame operations only).

A text is cut into sentences, each is normalised (lower case, everything but
a-z and 0-9 to single spaces) and mapped to the identifier of a known licence
sentence; the resulting identifier sequence is matched against ordered rules,
longest first.  A rule matches when its identifiers occur in its order, whatever
lies between, and takes them out of the sequence for the rules after it: a text
of one licence is not also the shorter licence that it contains, and of two
licences in one text each needs sentences of its own.

Licence texts come wrapped at any column as well as line by line, and in source
comments.  A sentence ends at its punctuation, at a line without letters and
digits (after its comment leader), and around a copyright line; it is looked up
as a whole, and each of its lines by itself.  ``sentence_ids`` has what either
way found, by position, and ``licences`` the rules that match this sequence.

Before the cutting, a text must contain one of the words that each known
sentence contains (``CUES``, checked at import), so other texts are not cut.

Sentences and rules are parameters (:class:`Licences`); the ones below cover
common licences.

Defined results: null text counts as empty; a text without a known sentence
gives empty lists.  Texts of any length are cut whole.  Rules of one length are
tried as listed, so there are no ties; a licence found twice is named once.
Every row gives one row, repeated ones too.  An empty table gives an empty
result; other columns take no part.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import text_of

#: Known licence sentences, by identifier; public licence wording.
SENTENCES = {
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-short": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache2-short": "Licensed under the Apache License, Version 2.0.",
    "apache2-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache2-comply": "you may not use this file except in compliance with the License.",
    "apache2-obtain": "You may obtain a copy of the License at",
    "apache2-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache2-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-program": "This program is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ccby4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "ccby4-short": "Licensed under CC BY 4.0.",
    "ccbysa4-short": "Licensed under CC BY-SA 4.0.",
    "ccbync4-short": "Licensed under CC BY-NC 4.0.",
    "ccbync4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0-dedicated": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense": "This is free and unencumbered software released into the public domain without copyright.",
    "rights-reserved": "All rights reserved.",
    "lgpl-free": "This library is free software;",
    "lgpl21-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "epl1-made": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "epl2-made": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "bsl1-header": "Distributed under the Boost Software License, Version 1.0.",
    "bsl1-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "artistic2-terms": "This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed.",
    "classpath-exception": "As a special exception, the copyright holders of this library give you permission to link this library with independent modules to produce an executable, regardless of the license terms of these independent modules, and to copy and distribute the resulting executable under terms of your choice, provided that you also meet, for each linked independent module, the terms and conditions of the license of that module.",
    "llvm-exception": "Part of the LLVM Project, under the Apache License v2.0 with LLVM Exceptions.",
}

#: Fixed values: (licence, identifiers in order).  One licence can have several rules.
RULES = (
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-title", "mit-grant")),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache2-short",)),
    ("Apache-2.0", ("apache2-header", "apache2-comply")),
    ("Apache-2.0", ("apache2-header", "apache2-as-is")),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("GPL-3.0-only", ("gpl3-program",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-redistribute")),
    ("GPL-2.0-or-later", ("gpl2-redistribute", "gpl-hope")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("MPL-2.0", ("mpl2-subject",)),
    ("CC-BY-4.0", ("ccby4-work",)),
    ("CC-BY-4.0", ("ccby4-short",)),
    ("CC-BY-SA-4.0", ("ccbysa4-short",)),
    ("CC-BY-NC-4.0", ("ccbync4-short",)),
    ("CC-BY-NC-4.0", ("ccbync4-work",)),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("Unlicense", ("unlicense",)),
    ("all-rights-reserved", ("rights-reserved",)),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl21-redistribute")),
    ("LGPL-3.0-or-later", ("lgpl3-redistribute",)),
    ("AGPL-3.0-or-later", ("agpl3-redistribute",)),
    ("BSD-4-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse")),
    ("BSD-1-Clause", ("bsd-redistribution", "bsd-source")),
    ("EPL-1.0", ("epl1-made",)),
    ("EPL-2.0", ("epl2-made",)),
    ("BSL-1.0", ("bsl1-header",)),
    ("BSL-1.0", ("bsl1-grant",)),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("Artistic-2.0", ("artistic2-terms",)),
    ("Classpath-exception-2.0", ("classpath-exception",)),
    ("Apache-2.0 WITH LLVM-exception", ("llvm-exception",)),
)

#: Each known sentence contains one of these words.
CUES = ("licen", "copyright", "warrant", "permi", "redistribut", "rights", "software")


def normal_sentence(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def _pieces(sentence: str) -> list[str]:
    """What the cutting makes of a known sentence (punctuation inside it ends a piece)."""
    cut = re.sub(r"[.!?;:]+ ", "\n", re.sub(r"\s+", " ", sentence.lower()))
    return [p for p in (normal_sentence(x) for x in cut.split("\n")) if p]


#: What the cutting makes of the known sentences that it splits, a name for each piece.
SPLIT = {
    "gpl2-redistribute": ("gpl-redistribute", "gpl2-or-later"),
    "lgpl21-redistribute": ("lgpl-redistribute", "lgpl21-or-later"),
    "mpl2-subject": ("mpl-subject", "mpl-2"),
}
#: Other pieces that follow "gpl-redistribute" and "lgpl-redistribute".
ENDS = {
    "gpl3-or-later": "either version 3 of the License, or (at your option) any later version.",
    "gpl2-version": "version 2 of the License.",
    "gpl3-version": "version 3 of the License.",
    "lgpl21-version": "version 2.1 of the License.",
}
#: (licence, name of the piece after "gpl-redistribute"), and the same after "lgpl-redistribute".
GPL = (("GPL-2.0-or-later", "gpl2-or-later"), ("GPL-3.0-or-later", "gpl3-or-later"), ("GPL-2.0-only", "gpl2-version"), ("GPL-3.0-only", "gpl3-version"))
LGPL = (("LGPL-2.1-or-later", "lgpl21-or-later"), ("LGPL-2.1-only", "lgpl21-version"), ("LGPL-3.0-or-later", "gpl3-or-later"), ("LGPL-3.0-only", "gpl3-version"))


class Licences:
    """Known sentences and ordered rules over their pieces.

    ``split`` names the pieces of a sentence that the cutting splits, ``ends``
    are further pieces, ``more`` further rules; ``,`` in a rule joins pieces
    that follow each other directly.
    """

    def __init__(self, known: dict[str, str], rules, split: dict | None = None, ends: dict | None = None, more=()):
        split, ends = split or {}, ends or {}
        #: Normalised piece -> identifier, every piece of every known sentence.
        self.pieces: dict[str, str] = {}
        for name, sentence in (known | ends).items():
            cut = _pieces(sentence)
            own = split.get(name, (name,))
            if len(cut) != len(own) or any(p in self.pieces for p in cut):
                raise ValueError(f"{name}: needs a name for each of its pieces, none of them known")
            if not any(c in " ".join(cut) for c in CUES):
                raise ValueError(f"{name}: has none of the cues")
            self.pieces.update(zip(cut, own))
        over = [(licence, tuple(",".join(split.get(i, (i,))) for i in rule)) for licence, rule in rules]
        # Longest first; of one length as listed.
        #: (licence, pieces in order).
        self.rules = sorted(dict.fromkeys([*over, *more]), key=lambda r: -sum(i.count(",") + 1 for i in r[1]))
        # What follows a cut inside a known sentence is a sentence by its punctuation, never by its line.
        later = {*ends, *(i for names in split.values() for i in names[1:])}
        self.by_line = {piece: i for piece, i in self.pieces.items() if i not in later}

    def patterns(self) -> list[tuple[str, str, int]]:
        """(licence, expression over the tagged sequence, number of its gaps)."""
        return [(licence, GAP.join("".join(f"<{i}>" for i in part.split(",")) for part in rule), len(rule) - 1) for licence, rule in self.rules]


#: Identifiers between those of a rule, as few as possible.
GAP = "((?:<[^>]+>)*?)"


def _foundation() -> list[tuple[str, tuple[str, ...]]]:
    """The rules of the headers whose version stands in a piece of its own."""
    found = []
    for licence, end in GPL:
        found += [(licence, (f"gpl-redistribute,{end}", "gpl-hope")), (licence, ("gpl-free", f"gpl-redistribute,{end}"))]
    return found + [(licence, (f"lgpl-redistribute,{end}",)) for licence, end in LGPL]


KNOWN = Licences(SENTENCES, RULES, SPLIT, ENDS, _foundation())


#: Comment leaders; lines without letters or digits; copyright lines (known sentences have "copyright notice", "holder" and "and" at a line's start, too).
LEADERS = r"(?md)^[ \t]*(?:/?\*+/?|//+|#+|--+|;+)"
BLANK = r"(?md)^[^\p{L}\p{N}\n]+$"
COPYRIGHT = r"(?md)^[^\p{L}\p{N}\n(©]*(?:portions )?(?:copyright\b[ \t:]*(?!notice|holder|and\b)[^ \t\r\n]|(?:\(c\)|©)[ \t]*[0-9]{4})[^\n]*$"


def sentences(lowered: Column) -> Column:
    """The sentences of a lower-case text, in order; line ends inside them stay."""
    bare = F.regexp_replace(F.regexp_replace(lowered, LEADERS, ""), BLANK, "")
    apart = F.regexp_replace(bare, COPYRIGHT, "\n$0\n")
    return F.split(F.regexp_replace(apart, r"[.!?;:]+[ \t\r\n]+", "\n\n"), r"\n{2,}")


def _known(cut: Column, licences: Licences) -> Column:
    """Identifiers by position: of each sentence as a whole, then of its lines."""
    def look(ids: dict[str, str], s: Column) -> Column:
        known = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
        return F.try_element_at(known, F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))

    whole = F.transform(cut, lambda s: F.struct(look(licences.pieces, s).alias("id"), s.alias("s")))
    lines = lambda x: F.transform(F.split(x["s"], "\n"), lambda line: look(licences.by_line, line))
    more = lambda x: F.filter(lines(x), lambda i: i.isNotNull() & ~i.eqNullSafe(x["id"]))
    found = F.transform(whole, lambda x: F.concat(F.array(x["id"]), F.when(x["s"].contains("\n"), more(x)).otherwise(F.array().cast("array<string>"))))
    return F.array_compact(F.flatten(found))


def _matches(ids: Column, licences: Licences) -> Column:
    """Licences whose rules match, by name; each rule takes its identifiers out of the sequence."""
    tagged = F.concat_ws("", F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))))
    rules = F.array(*[
        F.struct(F.lit(p).alias("p"), F.lit("".join(f"${k + 1}" for k in range(gaps))).alias("rest"), F.lit(licence).alias("licence"))
        for licence, p, gaps in licences.patterns()])

    def apply(held: Column, rule: Column) -> Column:
        found = F.when(F.regexp_like(held["left"], rule["p"]), F.concat(held["found"], F.array(rule["licence"]))).otherwise(held["found"])
        return F.struct(F.regexp_replace(held["left"], rule["p"], rule["rest"]).alias("left"), found.alias("found"))

    start = F.struct(tagged.alias("left"), F.array().cast("array<string>").alias("found"))
    return F.array_sort(F.array_distinct(F.aggregate(rules, start, apply, lambda held: held["found"])))


def scan_licences(docs: DataFrame, licences: Licences = KNOWN) -> DataFrame:
    """doc_id, n_known, sentence_ids (comma-joined, in order) and licences (comma-joined, by name)."""
    lowered = F.lower(text_of())
    cue = F.lower(text_of()).rlike("|".join(CUES))
    none = F.array().cast("array<string>")
    rows = docs.select("doc_id", "text").select("doc_id", F.when(cue, _known(sentences(lowered), licences)).otherwise(none).alias("ids"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_known"),
        F.concat_ws(",", "ids").alias("sentence_ids"),
        F.when(F.size("ids") > 0, F.concat_ws(",", _matches(F.col("ids"), licences))).otherwise("").alias("licences"),
    )


def oracle(licences: Licences = KNOWN) -> str:
    """The same in DuckDB: lines told apart one by one, and a column for what each rule leaves."""
    def table(ids: dict[str, str]) -> str:
        return "MAP([" + ",".join(f"'{k}'" for k in ids) + "],[" + ",".join(f"'{i}'" for i in ids.values()) + "])"

    def look(ids: dict[str, str], x: str) -> str:
        return f"{table(ids)}[trim(regexp_replace({x}, '[^a-z0-9]+', ' ', 'g'))]"

    begin = "^[^\\p{L}\\p{N}(©]*(?:portions )?".replace("\\\\", "\\")
    copyright = (
        f"regexp_matches(l, '{begin}(?:copyright\\b[ \\t]*:|(?:\\(c\\)|©)[ \\t]*[0-9]{{4}})') OR (regexp_matches(l, '{begin}copyright\\b[ \\t]*[^ \\t\\r\\n:]')"
        f" AND NOT regexp_matches(l, '{begin}copyright\\b[ \\t]*(?:notice|holder|and\\b)'))"
    )
    patterns = licences.patterns()
    steps = ",\n".join(
        f"regexp_matches(s{k}, '{p}') AS h{k}, regexp_replace(s{k}, '{p}', '{''.join(chr(92) + str(g + 1) for g in range(gaps))}', 'g') AS s{k + 1}"
        for k, (_, p, gaps) in enumerate(patterns))
    hits = ", ".join(f"CASE WHEN h{k} THEN '{licence}' END" for k, (licence, _, _) in enumerate(patterns))
    return f"""
WITH t AS (SELECT doc_id, regexp_replace(regexp_replace(lower(coalesce(text, '')), '(?m)^[ \\t]*(?:/?\\*+/?|//+|#+|--+|;+)', '', 'g'), '(?m)^[^\\p{{L}}\\p{{N}}\\n]+$', '', 'g') AS bare,
             regexp_matches(lower(coalesce(text, '')), '{"|".join(CUES)}') AS cue FROM documents),
l AS (SELECT doc_id, CASE WHEN cue THEN array_to_string(list_transform(string_split(bare, chr(10)),
        lambda l: CASE WHEN {copyright} THEN chr(10) || l || chr(10) ELSE l END), chr(10)) ELSE '' END AS apart FROM t),
c AS (SELECT doc_id, list_transform(string_split_regex(regexp_replace(apart, '[.!?;:]+[ \\t\\r\\n]+', chr(10) || chr(10), 'g'), '\\n{{2,}}'),
        lambda s: {{'s': s, 'id': {look(licences.pieces, "s")}}}) AS cut FROM l),
i AS (SELECT doc_id, list_filter(flatten(list_transform(cut, lambda x: list_concat([x.id], CASE WHEN contains(x.s, chr(10)) THEN
        list_filter(list_transform(string_split(x.s, chr(10)), lambda y: {look(licences.by_line, "y")}), lambda z: z IS NOT NULL AND z IS DISTINCT FROM x.id) ELSE [] END))),
        lambda z: z IS NOT NULL) AS ids FROM c),
r AS (SELECT doc_id, ids, array_to_string(list_transform(ids, lambda z: '<' || z || '>'), '') AS s0,
{steps} FROM i)
SELECT doc_id, len(ids)::BIGINT AS n_known, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
       coalesce(array_to_string(list_sort(list_distinct(list_filter([{hits}], lambda z: z IS NOT NULL))), ','), '') AS licences
FROM r
""".replace("\\\\", "\\")
