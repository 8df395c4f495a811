"""Licence scans by sentence rules.

Normalised sentences of a text are mapped to identifiers of known licence sentences; the identifiers in
the order of the text are then matched against ordered licence rules. DataFrame operations only.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_columns

#: Standard wordings, and how many of their first sentences name the licence.
TEXTS = (
    (
        "apache2",
        "Apache-2.0",
        2,
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    (
        "mit",
        "MIT",
        2,
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    (
        "bsd",
        "BSD-3-Clause",
        4,
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\nRedistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\nRedistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "bsd",
        "BSD-2-Clause",
        3,
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\nRedistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\nRedistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    ("isc", "ISC", 1, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("zlib", "Zlib", 1, "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("unlicense", "Unlicense", 1, "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("boost", "BSL-1.0", 1, "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("boost-grant", "BSL-1.0", 1, 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'),
    ("mpl2", "MPL-2.0", 1, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("gpl3", "GPL-3.0-or-later", 1, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl2", "GPL-2.0-or-later", 1, "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl2-only", "GPL-2.0-only", 1, "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("lgpl21", "LGPL-2.1-or-later", 1, "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl3", "LGPL-3.0-or-later", 1, "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("agpl3", "AGPL-3.0-or-later", 1, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("apache2-text", "Apache-2.0", 1, "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/"),
    ("gpl3-text", "GPL-3.0-only", 1, "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
    ("gpl2-text", "GPL-2.0-only", 1, "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991"),
    ("lgpl3-text", "LGPL-3.0-only", 1, "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
    ("lgpl21-text", "LGPL-2.1-only", 1, "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999"),
    ("agpl3-text", "AGPL-3.0-only", 1, "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007"),
    ("mpl2-text", "MPL-2.0", 1, "Mozilla Public License Version 2.0"),
    ("epl2-text", "EPL-2.0", 1, "Eclipse Public License - v 2.0"),
    ("cc0-text", "CC0-1.0", 1, "CC0 1.0 Universal"),
)
#: Other known sentences with their identifiers, and the licence that one alone names.
NOTICES = (
    ("apache2-short", "Apache-2.0", "licensed under the apache license, version 2.0"),
    ("apache2-notice", "Apache-2.0", 'licensed under the apache license, version 2.0 (the "license")'),
    ("apache2-line", None, 'licensed under the apache license, version 2.0 (the "license");'),
    ("apache2-use", None, "you may not use this file except in compliance with the license"),
    ("mit-short", "MIT", "released under the mit license"),
    ("mit-licensed", "MIT", "licensed under the mit license"),
    ("mit-title", "MIT", "the mit license"),
    ("mit-title-mit", "MIT", "the mit license (mit)"),
    ("mit-name", "MIT", "mit license"),
    ("isc-name", "ISC", "isc license"),
    ("bsd3-name", "BSD-3-Clause", "bsd 3-clause license"),
    ("bsd2-name", "BSD-2-Clause", "bsd 2-clause license"),
    ("gpl3-short", "GPL-3.0-only", "this work is licensed under the gnu general public license, version 3"),
    ("gpl2-short", "GPL-2.0-only", "this work is licensed under the gnu general public license, version 2"),
    ("gpl-hope", None, "this program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-details", None, "see the gnu general public license for more details"),
    ("mpl2-at", None, "if a copy of the mpl was not distributed with this file, you can obtain one at http://mozilla.org/mpl/2.0/"),
    ("cc0-short", "CC0-1.0", "to the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by-short", "CC-BY-4.0", "licensed under cc by 4.0"),
    ("cc-by-sa-short", "CC-BY-SA-4.0", "licensed under cc by-sa 4.0"),
    ("cc-by-nc-short", "CC-BY-NC-4.0", "licensed under cc by-nc 4.0"),
    ("cc-by-nc-nd-short", "CC-BY-NC-ND-4.0", "licensed under cc by-nc-nd 4.0"),
    ("cc-by-work", "CC-BY-4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("all-rights", "LicenseRef-all-rights-reserved", "all rights reserved"),
)
#: Names by which notices call licences.
NAMES = (
    ("MIT", ("the mit license", "mit license", "mit")),
    ("Apache-2.0", ("the apache license, version 2.0", "the apache license 2.0", "the apache 2.0 license", "apache license 2.0", "apache-2.0")),
    ("BSD-3-Clause", ("the bsd 3-clause license", "the 3-clause bsd license", "bsd-3-clause")),
    ("BSD-2-Clause", ("the bsd 2-clause license", "the 2-clause bsd license", "bsd-2-clause")),
    ("ISC", ("the isc license", "isc")),
    ("MPL-2.0", ("the mozilla public license 2.0", "the mozilla public license, version 2.0", "mpl-2.0")),
    ("GPL-3.0-only", ("the gnu general public license, version 3", "the gnu general public license v3.0", "the gnu gpl v3", "gplv3", "gpl-3.0")),
    ("GPL-2.0-only", ("the gnu general public license, version 2", "the gnu gpl v2", "gplv2", "gpl-2.0")),
    ("LGPL-3.0-only", ("the gnu lesser general public license, version 3", "lgpl-3.0")),
    ("LGPL-2.1-only", ("the gnu lesser general public license, version 2.1", "lgpl-2.1")),
    ("AGPL-3.0-only", ("the gnu affero general public license, version 3", "agpl-3.0")),
    ("Unlicense", ("the unlicense",)),
    ("CC0-1.0", ("cc0 1.0", "cc0")),
)
#: Verbs of notices, and the six Creative Commons licences that have conditions, from which further notices are made.
VERBS = ("licensed under", "released under", "distributed under", "available under", "published under", "covered by")
COMMONS = (("BY", "attribution"), ("BY-SA", "attribution-sharealike"), ("BY-NC", "attribution-noncommercial"), ("BY-ND", "attribution-noderivatives"), ("BY-NC-SA", "attribution-noncommercial-sharealike"), ("BY-NC-ND", "attribution-noncommercial-noderivatives"))

#: Marks of comments and lists at the beginning of a line, and of comments at its end.
MARKS = r"""(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|!+|<!--|"+ |- |[0-9]{1,2}[.)] |rem |dnl ) *"""
BEGIN = rf"(^|\n) *(?:{MARKS})+"
CLOSE = r" *(?:\*+/|-->) *(\n|$)"
#: The same for Java's matcher, which calls itself for each round of a group unless that is possessive, and would try a run of stars from each of its places.
BEGIN_ONCE = BEGIN + "+"
CLOSE_ONCE = r" ?(?:(?<!\*)\*+/|-->) ?(\n|$)"
#: Characters that normalisation drops: all but ASCII letters and digits and some marks.
NOISE = r"""[^a-z0-9 .,;:/()"'\n-]+"""
#: A full stop that ends a sentence, and an empty line.
END = r"\.( |\n|$)|\n\n+"
#: What may stand before a notice's verb.
LEAD = r"^(?:this|the|these|all|our|its)(?: [a-z0-9.-]+){1,4} (?:is|are|was|has been|have been)(?: hereby| also| being| made)? "


def pieces(text: str) -> list[str]:
    """The sentences of a text as sentence_ids() cuts and compares them."""
    t = re.sub(r"[\t\r\f\x0B]+", " ", text.lower())
    t = re.sub(CLOSE, r"\1", re.sub(BEGIN, r"\1", t))
    t = re.sub(r" ?\n ?", "\n", re.sub(" +", " ", re.sub(NOISE, "", t)))
    found = re.split(END.replace("(", "(?:"), t)
    return [x for x in (p.replace("\n", " ").strip() for p in found) if re.search("[a-z]", x)]


def dictionary() -> tuple[dict[str, str], tuple[tuple[str, tuple[str, ...]], ...]]:
    """(identifier of each known sentence, rules in order): all as the scanner's own cutting gives them.

    A sentence that ends in a colon may be followed by the next one without an empty line; then both are one.
    """
    known: dict[str, str] = {}
    whole: list[tuple[str, tuple[str, ...]]] = []
    for key, name, n, text in TEXTS:
        parts = pieces(text)
        ids = [known.setdefault(p, f"{key}-{i}") for i, p in enumerate(parts, 1)]
        whole.append((name, tuple(ids[:n])))
        for i in range(len(parts) - 1):
            if parts[i].endswith(":"):
                joined = known.setdefault(f"{parts[i]} {parts[i + 1]}", f"{ids[i]}+")
                if i < n:
                    whole.append((name, (*ids[:i], joined, *ids[i + 2 : n])))
    notices = []
    for key, name, sentence in NOTICES:
        known[sentence] = key
        if name:
            notices.append((name, (key,)))
    commons = [(f"CC-{c}-4.0", (f"cc {c.lower()} 4.0", f"cc-{c.lower()}-4.0", f"a creative commons {long} 4.0 international license", f"the creative commons {long} 4.0 license")) for c, long in COMMONS]
    for name, called in (*NAMES, *commons):
        key = f"{name.lower()}-under"
        for verb in VERBS:
            for c in called:
                known.setdefault(f"{verb} {c}", key)
        notices.append((name, (key,)))
    # Longer sequences first, so that a shorter rule doesn't take a part of theirs.
    rules = sorted(dict.fromkeys(whole), key=lambda r: -len(r[1])) + [("Apache-2.0", (first, "apache2-use")) for first in ("apache2-notice", "apache2-line")] + notices
    return known, tuple(rules)


KNOWN, RULES = dictionary()


def normalised(text: Column) -> Column:
    """Lower case, marks and decoration dropped, single spaces; line breaks stay and null is empty."""
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\t\r\f\x0B]+", " ")
    t = F.regexp_replace(t, " +", " ")
    t = F.regexp_replace(F.regexp_replace(t, BEGIN_ONCE, "$1"), CLOSE_ONCE, "$1")
    t = F.regexp_replace(F.regexp_replace(t, NOISE, ""), " +", " ")
    return F.regexp_replace(t, r" ?\n ?", "\n")


def sentence_ids(text: Column, known: dict[str, str] = KNOWN) -> Column:
    """Identifiers of the known sentences of a text, in its order.

    A sentence ends at a full stop or an empty line. One that is known as a whole may be wrapped over
    several lines; otherwise each of its lines is looked up. A notice may have a lead-in before its verb.
    """
    by_length: list[dict[str, str] | None] = [None] * (max(map(len, known), default=0) + 1)
    for sentence, key in known.items():
        by_length[len(sentence)] = {**(by_length[len(sentence)] or {}), sentence: key}
    # Folded into one literal: the maps of the sentences of each length.
    table = F.from_json(F.lit(json.dumps(by_length)), "array<map<string,string>>")

    def found(s: Column) -> Column:
        return F.try_element_at(F.get(table, F.length(s)), s)

    def named(s: Column) -> Column:
        return F.coalesce(found(s), F.when(F.length(s).between(12, 200) & s.rlike(LEAD), found(F.regexp_replace(s, LEAD, ""))))

    def of(piece: Column) -> Column:
        whole = named(F.trim(F.translate(piece, "\n", " ")))
        lines = F.filter(F.transform(F.split(piece, "\n"), lambda x: named(F.trim(x))), lambda x: x.isNotNull())
        return F.when(whole.isNotNull(), F.array(whole)).when(F.contains(piece, F.lit("\n")), lines)

    each = F.transform(F.split(normalised(text), END), of)
    return F.flatten(F.filter(each, lambda x: x.isNotNull()))


def match_rules(ids: Column, rules=RULES) -> Column:
    """Licences of a sequence of identifiers: rules in order, each taking every place where it matches."""
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"|{x}|" for x in needed)).alias("needed")) for name, needed in rules])
    start = F.struct(F.array_join(F.transform(ids, lambda x: F.concat(F.lit("|"), x, F.lit("|"))), "").alias("left"), F.array().cast("array<string>").alias("found"))

    def step(acc: Column, rule: Column) -> Column:
        taken = F.struct(F.replace(acc["left"], rule["needed"], F.lit("#")).alias("left"), F.array_append(acc["found"], rule["name"]).alias("found"))
        return F.when(F.contains(acc["left"], rule["needed"]), taken).otherwise(acc)

    return F.array_distinct(F.aggregate(table, start, step, lambda acc: acc["found"]))


def license_scan(docs: DataFrame, known: dict[str, str] = KNOWN, rules=RULES) -> DataFrame:
    """doc_id, n_sentences, sentence_ids, licenses for every row of docs (doc_id, text).

    sentence_ids: identifiers in the text's order, comma-joined; licenses: in the rules' order. Texts
    that are null, empty or without a known sentence have 0, '' and ''. Repeated rows are each
    returned, ids may be null, and an empty table gives no rows. Other columns aren't read.
    """
    rows = own_columns(docs, doc_id=F.col("doc_id"), ids=sentence_ids(F.col("text"), known))
    found = F.when(F.size("ids") > 0, F.array_join(match_rules(F.col("ids"), rules), ",")).otherwise("")
    return rows.select("doc_id", F.size("ids").alias("n_sentences"), F.array_join("ids", ",").alias("sentence_ids"), found.alias("licenses"))


def oracle_sql() -> str:
    """The same over documents in DuckDB."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = "MAP {" + ", ".join(f"{q(s)}: {q(k)}" for s, k in KNOWN.items()) + "}"
    steps, left, found = [], "left0", []
    for k, (name, needed) in enumerate(RULES, 1):
        pattern = q("".join(f"|{x}|" for x in needed))
        steps.append(f"r{k} as (select * exclude ({left}), replace({left}, {pattern}, '#') as left{k}, if(contains({left}, {pattern}), {q(name)}, null) as f{k} from r{k - 1})")
        left, found = f"left{k}", [*found, f"f{k}"]
    noise, begin = (p.replace("'", "''").replace("\\n", "\n") for p in (NOISE, BEGIN))
    named = lambda s: f"coalesce(known[{s}], case when length({s}) between 12 and 200 and regexp_matches({s}, '{LEAD}') then known[regexp_replace({s}, '{LEAD}', '')] end)"
    return f"""
with t0 as (select doc_id, regexp_replace(lower(coalesce(text, '')), '[\t\r\f\x0B]+', ' ', 'g') as t from documents),
t1 as (select doc_id, regexp_replace(regexp_replace(t, '{begin}', '\\1', 'g'), '{CLOSE}', '\\1', 'g') as t from t0),
t2 as (select doc_id, regexp_replace(regexp_replace(regexp_replace(t, '{noise}', '', 'g'), ' +', ' ', 'g'), ' ?\n ?', chr(10), 'g') as t from t1),
k as (select {known} as known),
p as (select doc_id, regexp_split_to_array(t, '{END}') as pieces from t2),
w as (select doc_id, list_transform(pieces, lambda x: {{'x': x, 'w': trim(replace(x, chr(10), ' '))}}) as ps from p),
s as (select doc_id, flatten(list_transform(ps, lambda y: case when {named("y.w")} is not null then [{named("y.w")}]
  when contains(y.x, chr(10)) then list_filter(list_transform(string_split(y.x, chr(10)), lambda z: {named("trim(z)")}), lambda z: z is not null) else [] end)) as ids from w, k),
r0 as (select doc_id, ids, array_to_string(list_transform(ids, lambda x: '|' || x || '|'), '') as left0 from s),
{", ".join(steps)}
select doc_id, cast(len(ids) as integer) as n_sentences, coalesce(array_to_string(ids, ','), '') as sentence_ids,
  coalesce(array_to_string(list_distinct_in_order, ','), '') as licenses
from (select *, list_filter(list_transform(list_zip(found, range(1, len(found) + 1)), lambda x: if(x[1] is not null and list_position(found, x[1]) = x[2], x[1], null)), lambda y: y is not null) as list_distinct_in_order
  from (select *, [{", ".join(found)}] as found from r{len(RULES)}))
"""
