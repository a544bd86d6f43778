"""License scans by sentence-rule recognition, in DataFrame functions only.

A text is normalised (small letters, runs of other characters than letters and
digits are one space, or one new line where a sentence may end), and sentences of
known licence texts become identifiers.  A known sentence begins and ends where
sentences may end; between its words any space, new line or sign may stand, so
that texts wrapped at a line width, comment marks and the semicolons and points
within official wordings don't matter.  Ordered rules name sequences of identifiers; a rule
takes each place where its sequence stands, without other identifiers between,
and what it has taken is out of reach of later rules.  So whole licence texts come
before the notices that are parts of them.  Notices ("licensed under ...") and tags
(SPDX-License-Identifier) give identifiers by the names of licences.  Reserved rights
count only where nothing is granted.

Edge cases.  Null and empty texts have no identifiers and no licences.  Texts are
taken whole, in time that grows with their length.  Repeated rows are scanned
alike.  All columns are kept; those named like a result are replaced.  An empty
table gives an empty result.  There is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences end at . ! ? before white space or the end, and at new lines and semicolons.
SENTENCE_END = r"[.!?]+(?:[\x20\x09-\x0D]+|$)|[\n;]"
OTHER = r"[^a-z0-9]+"
#: The ends above, and colons: some official texts go on after one where others end.
MAY_END = SENTENCE_END.replace("[\\n;]", "[\\n;:]")

# Sentences of licence texts, normalised, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0 the license": "apache-2.0-notice",
    "you may not use this file except in compliance with the license": "apache-2-compliance",
    "you may obtain a copy of the license at": "apache-2-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-2-as-is",
    "see the license for the specific language governing permissions and limitations under the license": "apache-2-limits",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so": "mit-0-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice-kept",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": "mit-notice-kept",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-as-is",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bsl-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": "bsd-advertising",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "this software is provided as is without any express or implied warranty": "zlib-as-is",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib-liability",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies": "postgresql-grant",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "gnu-merchantability",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2-form",
    "if a copy of the mpl was not distributed with this file you can obtain one at": "mpl-2-copy",
    "the contents of this file are subject to the mozilla public license version 1 1 the license": "mpl-1-contents",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at": "epl-2-materials",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at": "epl-2-materials",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at": "epl-1-materials",
    "the contents of this file are subject to the terms of the common development and distribution license the license": "cddl-contents",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "cc0-waiver",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0-waiver",
    "this is free and unencumbered software released into the public domain": "unlicense-free",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-anyone",
    "this font software is licensed under the sil open font license version 1 1": "ofl-font",
    "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed": "wtfpl-copies",
    "all rights reserved": "all-rights-reserved",
}
# The GNU licences' names and versions; their sentences follow by rule.
GNU = {"GPL": ("", ("1", "2", "3")), "LGPL": ("lesser ", ("2.1", "3")), "AGPL": ("affero ", ("3",))}
GNU_THINGS = ("program", "library", "software", "file", "package")
for _thing in GNU_THINGS:
    SENTENCES[f"this {_thing} is free software"] = "gnu-free"
    SENTENCES[f"this {_thing} is distributed in the hope that it will be useful but without any warranty"] = "gnu-warranty"
for _name, (_kind, _versions) in GNU.items():
    _full = f"gnu {_kind}general public license"
    SENTENCES[f"see the {_full} for more details"] = "gnu-details"
    for _v in _versions:
        _said, _id = _v.replace(".", " "), f"{_name.lower()}-{_v if '.' in _v else _v + '.0'}"
        SENTENCES[f"you can redistribute it and or modify it under the terms of the {_full} as published by the free software foundation either version {_said} of the license or at your option any later version"] = f"{_id}-or-later-grant"
        SENTENCES[f"you can redistribute it and or modify it under the terms of the {_full} as published by the free software foundation version {_said} of the license"] = f"{_id}-only-grant"
        SENTENCES[f"you can redistribute it and or modify it under the terms of the {_full} version {_said} as published by the free software foundation"] = f"{_id}-only-grant"

# Names by which notices call licences ("licensed under ..."), normalised.
NAMES = {
    "mit": "MIT", "mit license": "MIT", "apache 2 0": "Apache-2.0", "apache license version 2 0": "Apache-2.0", "apache license 2 0": "Apache-2.0", "apache 2 0 license": "Apache-2.0", "apache license v2 0": "Apache-2.0",
    "bsd 2 clause license": "BSD-2-Clause", "simplified bsd license": "BSD-2-Clause", "freebsd license": "BSD-2-Clause", "bsd 3 clause license": "BSD-3-Clause", "new bsd license": "BSD-3-Clause", "modified bsd license": "BSD-3-Clause", "revised bsd license": "BSD-3-Clause",
    "isc license": "ISC", "zlib license": "Zlib", "boost software license": "BSL-1.0", "boost software license version 1 0": "BSL-1.0", "unlicense": "Unlicense", "wtfpl": "WTFPL", "postgresql license": "PostgreSQL", "artistic license 2 0": "Artistic-2.0",
    "mozilla public license version 2 0": "MPL-2.0", "mozilla public license 2 0": "MPL-2.0", "mpl 2 0": "MPL-2.0", "mozilla public license version 1 1": "MPL-1.1",
    "eclipse public license 2 0": "EPL-2.0", "eclipse public license version 2 0": "EPL-2.0", "eclipse public license 1 0": "EPL-1.0", "eclipse public license version 1 0": "EPL-1.0",
    "common development and distribution license version 1 0": "CDDL-1.0", "european union public licence version 1 2": "EUPL-1.2", "eupl version 1 2": "EUPL-1.2", "sil open font license version 1 1": "OFL-1.1",
    "cc0": "CC0-1.0", "cc0 1 0": "CC0-1.0", "cc0 1 0 universal": "CC0-1.0", "creative commons zero v1 0 universal": "CC0-1.0", "microsoft public license": "MS-PL", "university of illinois ncsa open source license": "NCSA",
}
# What the letters of Creative Commons licences stand for, and their versions.
COMMONS = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
for _code in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
    for _v in ("2.0", "2.5", "3.0", "4.0"):
        _said, _id = _v.replace(".", " "), f"CC-{_code.upper()}-{_v}"
        NAMES[f"cc {_code.replace('-', ' ')} {_said}"] = _id
        for _end in ("license", "international license", "unported license"):
            NAMES[f"creative commons {' '.join(COMMONS[c] for c in _code.split('-'))} {_said} {_end}"] = _id
for _name, (_kind, _versions) in GNU.items():
    for _v in _versions:
        _said, _id = _v.replace(".", " "), f"{_name}-{_v if '.' in _v else _v + '.0'}-only"
        for _called in (f"gnu {_kind}general public license version {_said}", f"gnu {_kind}general public license v{_said}", f"gnu {_name.lower()} v{_said}", f"{_name.lower()}v{_said}", f"{_name.lower()} v{_said}", f"{_name.lower()} {_said} 0", f"gnu {_name.lower()} version {_said}"):
            NAMES[_called] = _id
#: How a notice begins.
LEAD = "(?:this (?:work|project|software|program|library|file|article|content|document|code|package|page) is )?(?:licensed|released|distributed|published|available) under (?:the terms of the |the |a )?"

# Rules in order, whole texts before their parts. Rules of GNU grants, notices and tags follow by rule.
_GNU_GRANTS = sorted({i for i in SENTENCES.values() if i.endswith(("-only-grant", "-or-later-grant"))})
_SPDX = {i.lower(): i for i in [*NAMES.values(), "0BSD", "BSD-1-Clause", "BSD-4-Clause", "MIT-0", *(f"{i}{end}" for i in ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for end in ("-only", "-or-later"))]}
RULES = (
    ("Apache-2.0", ("apache-2.0-notice", "apache-2-compliance", "apache-2-copy", "apache-2-as-is", "apache-2-limits")),
    ("MIT", ("mit-grant", "mit-notice-kept", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice-kept", "mit-as-is")),
    ("MIT-0", ("mit-0-grant", "mit-as-is", "mit-liability")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-1-Clause", ("bsd-grant", "bsd-source")),
    ("Zlib", ("zlib-as-is", "zlib-liability", "zlib-grant")),
    *((_SPDX[g.removesuffix("-grant")], (*before, g, *after)) for before, after in ((("gnu-free",), ("gnu-warranty", "gnu-merchantability", "gnu-details")), (("gnu-free",), ()), ((), ())) for g in _GNU_GRANTS),
    ("Unlicense", ("unlicense-free", "unlicense-anyone")),
    ("MPL-2.0", ("mpl-2-form", "mpl-2-copy")),
    ("MIT", ("mit-grant",)), ("MIT-0", ("mit-0-grant",)), ("ISC", ("isc-grant",)), ("0BSD", ("0bsd-grant",)), ("BSL-1.0", ("bsl-grant",)), ("Zlib", ("zlib-grant",)), ("PostgreSQL", ("postgresql-grant",)),
    ("MPL-2.0", ("mpl-2-form",)), ("MPL-1.1", ("mpl-1-contents",)), ("EPL-2.0", ("epl-2-materials",)), ("EPL-1.0", ("epl-1-materials",)), ("CDDL-1.0", ("cddl-contents",)), ("CC0-1.0", ("cc0-waiver",)),
    ("Unlicense", ("unlicense-free",)), ("OFL-1.1", ("ofl-font",)), ("WTFPL", ("wtfpl-copies",)),
    *((i, (f"{low}-notice",)) for low, i in sorted(_SPDX.items())),
    *((i, (f"{low}-tag",)) for low, i in sorted(_SPDX.items())),
    ("LicenseRef-Proprietary", ("all-rights-reserved",)),
)
#: Counts only where nothing grants anything.
RESERVED = "LicenseRef-Proprietary"
#: A tag names licences in an expression, to the end of its line; older names stand for later ones.
TAG = r"(?i)SPDX-License-Identifier:[\x20\x09]*([^\n]*)"
# Deprecated identifiers of tags.
OLD_TAGS = {f"{n}{plus}": f"{n}-{'or-later' if plus else 'only'}" for n in ("gpl-1.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0") for plus in ("", "+")}
#: Holders' names vary within one sentence.
HOLDER, HELD = r"^neither the names? of [a-z0-9\x20]{1,120} nor the names of", "neither the name of the copyright holder nor the names of"
#: Every known sentence holds one of these; a text without any isn't split.
ANCHORS = ("licen[cs]", " under", "permission", "permitted", "advertising materials", "anyone is free", "possible under law", "the mpl", "held liable", "copyright", "redistribut", "warrant", "free software", "unencumbered", "rights reserved", "in no event shall", "neither the name")
HAS_ANCHOR = "(?i)" + "|".join(a.replace(" ", "[^a-z0-9]+") for a in ANCHORS)


def _sequence(names: tuple[str, ...]) -> str:
    return "".join(f"<{n}>" for n in names)


def _any_sentence() -> str:
    """Pattern of every known sentence and notice in a normalised text, the longest first. An address may follow."""
    held, names = (sorted(x, key=len, reverse=True) for x in (SENTENCES, NAMES))
    names_of = HOLDER[1:] + SENTENCES_OF_NAMES
    said = "|".join([*held, names_of, f"{LEAD}(?:{'|'.join(names)})(?: license)?"])
    return r"(?<![a-z0-9\x20])(?:" + said.replace(" ", r"[\x20\n]").replace(r"0-9\x20]{", r"0-9\x20\n]{") + r")(?![a-z0-9])(?!\x20(?!http))"


SENTENCES_OF_NAMES = next(s for s in SENTENCES if s.startswith(HELD)).removeprefix(HELD)


def _notices() -> dict[str, str]:
    """Names in notices to identifiers."""
    return {n: f"{i.lower()}-notice" for n, i in NAMES.items()}


def _tags() -> dict[str, str]:
    return {low: f"{low}-tag" for low in _SPDX} | {old: f"{new}-tag" for old, new in OLD_TAGS.items()}


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def sentence_ids(text: Column) -> Column:
    """Identifiers of a text's known sentences and notices, in order, and then of its tags."""
    known, notices, tags = _map(SENTENCES), _map(_notices()), _map(_tags())
    lines = F.regexp_replace(F.regexp_replace(F.lower(text), MAY_END, "\n"), r"[^a-z0-9\n]+", " ")
    lines = F.regexp_replace(lines, r"^[\x20\n]+|[\x20\n]+$|\x20*\n[\x20\n]*", "\n")
    said = F.regexp_extract_all(lines, F.lit(_any_sentence()), F.lit(0))

    def identify(s: Column) -> Column:
        s = F.regexp_replace(F.translate(s, "\n", " "), HOLDER, HELD)
        name = F.regexp_replace(s, f"^{LEAD}", "")
        return F.coalesce(F.try_element_at(known, s), F.try_element_at(notices, name), F.try_element_at(notices, F.regexp_replace(name, " license$", "")))

    tagged = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(TAG), F.lit(1)), lambda t: F.regexp_extract_all(F.lower(t), F.lit(r"[a-z0-9.+-]+"), F.lit(0))))
    both = F.concat(F.transform(said, identify), F.transform(tagged, lambda t: F.try_element_at(tags, t)))
    return F.when(text.rlike(HAS_ANCHOR), F.filter(both, lambda i: i.isNotNull())).otherwise(F.array().cast("array<string>"))


def licenses(ids: Column) -> Column:
    """Licences of a text by its identifiers, in the order of the rules, each once."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_sequence(ids)).alias("ids")) for name, ids in RULES])
    start = F.struct(F.concat(F.lit(""), F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")).alias("rest"), F.array().cast("array<string>").alias("found"))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["ids"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["ids"], F.lit("|"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.concat(state["found"], F.array(rule["name"]))).otherwise(state["found"]).alias("found"),
        )

    def finish(state: Column) -> Column:
        granted = F.filter(state["found"], lambda f: f != RESERVED)
        return F.array_distinct(F.when(F.size(granted) > 0, granted).otherwise(state["found"]))

    none = F.array().cast("array<string>")
    return F.when(F.size(ids) > 0, F.aggregate(rules, start, apply, finish)).otherwise(none)


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds sentence_ids and licenses (arrays of strings)."""
    kept = [c for c in (keep or docs.columns) if c.lower() not in ("sentence_ids", "licenses")]
    made = docs.select(*kept, sentence_ids(F.coalesce(F.col(text), F.lit(""))).alias("sentence_ids"))
    return made.withColumn("licenses", licenses(F.col("sentence_ids")))


def oracle() -> str:
    """The same for documents whose sentences are no wrapped texts, in DuckDB SQL, with sentence_ids and licenses joined by commas: sentences are split off and looked up one by one."""
    known, notices, tags = (", ".join(f"'{k}': '{v}'" for k, v in pairs.items()) for pairs in (SENTENCES, _notices(), _tags()))
    rules = ", ".join(f"{{'name': '{name}', 'seq': '{_sequence(ids)}'}}" for name, ids in RULES)
    return f"""
WITH RECURSIVE k AS (SELECT MAP {{{known}}} AS known, MAP {{{notices}}} AS notices, MAP {{{tags}}} AS tags, [{rules}] AS rules),
s AS (SELECT doc_id, coalesce(text, '') AS text, list_transform(regexp_split_to_array(coalesce(text, ''), '{SENTENCE_END}'), lambda x: regexp_replace(trim(regexp_replace(lower(x), '{OTHER}', ' ', 'g')), '{HOLDER}', '{HELD}')) AS said FROM documents),
n AS (SELECT doc_id, said, list_transform(said, lambda x: CASE WHEN regexp_matches(x, '^{LEAD}') THEN regexp_replace(x, '^{LEAD}', '') END) AS named,
  flatten(list_transform(regexp_extract_all(text, '{TAG}', 1), lambda t: regexp_extract_all(lower(t), '[a-z0-9.+-]+'))) AS tagged FROM s),
i AS (SELECT doc_id, list_filter(list_transform(said, lambda x, j: coalesce(known[x], notices[named[j]], notices[regexp_replace(named[j], ' license$', '')])) || list_transform(tagged, lambda t: tags[t]), lambda x: x IS NOT NULL) AS ids FROM n, k),
found(doc_id, ids, rest, found, step) AS (
  SELECT doc_id, ids, list_aggregate(list_transform(ids, lambda i: '<' || i || '>'), 'string_agg', ''), [] :: VARCHAR[], 1 FROM i WHERE len(ids) > 0
  UNION ALL
  SELECT doc_id, ids, replace(rest, rules[step].seq, '|'), CASE WHEN contains(rest, rules[step].seq) AND NOT list_contains(found, rules[step].name) THEN list_append(found, rules[step].name) ELSE found END, step + 1
  FROM found, k WHERE step <= len(rules))
SELECT i.doc_id, coalesce(array_to_string(i.ids, ','), '') AS sentence_ids,
  CASE WHEN len(list_filter(found, lambda f: f <> '{RESERVED}')) > 0 THEN array_to_string(list_filter(found, lambda f: f <> '{RESERVED}'), ',') ELSE coalesce(array_to_string(found, ','), '') END AS licenses
FROM i LEFT JOIN found ON found.doc_id = i.doc_id AND found.step = {len(RULES) + 1}
"""
