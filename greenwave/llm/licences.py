"""Licence recognition from sentences: normalised sentences -> identifiers -> ordered rules on identifier sequences."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from greenwave.llm.decontaminate import LOWER, UPPER

# Key sentences of public licences, normalised (lower case; everything but letters, digits,
# dots and plus signs is one space).
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "MitGrant",
    "released under the mit license": "MitName",
    "licensed under the mit license": "MitName",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied": "AsIs",
    "licensed under the apache license version 2.0": "Apache2Name",
    "licensed under the apache license version 2.0 the license": "Apache2Name",
    "you may not use this file except in compliance with the license": "Apache2Comply",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "Apache2Where",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "Apache2Disclaim",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdEndorse",
    "this work is licensed under the gnu general public license version 3": "Gpl3Name",
    "licensed under the gnu general public license version 2": "Gpl2Name",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "Gpl2Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Gpl3Later",
    "you should have received a copy of the gnu general public license along with this program": "GplCopy",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "Mpl2Name",
    "licensed under cc by 4.0": "CcByName",
    "licensed under cc by sa 4.0": "CcBySaName",
    "licensed under cc by nc 4.0": "CcByNcName",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "all rights reserved": "AllRights",
}
# The same for sentences whose standard text runs on, or has another wording, in the licence or its usual notice.
STANDARD = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "AsIs",
    "you may obtain a copy of the license at https www.apache.org licenses license 2.0": "Apache2Where",
    "this work is licensed under a creative commons attribution 4.0 international license": "CcByName",
    "this work is licensed under a creative commons attribution sharealike 4.0 international license": "CcBySaName",
    "this work is licensed under a creative commons attribution noncommercial 4.0 international license": "CcByNcName",
}
# Rules in the order in which they are tried; what a rule has matched is used up.
RULES = [
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"]),
    ("MIT", ["MitGrant", "MitNotice", "AsIs"]),
    ("MIT", ["MitGrant", "MitNotice"]),
    ("Apache-2.0", ["Apache2Name", "Apache2Comply", "Apache2Where", "Apache2Disclaim"]),
    ("Apache-2.0", ["Apache2Name", "Apache2Comply"]),
    ("GPL-3.0-or-later", ["Gpl3Later", "GplCopy"]),
    ("GPL-2.0-or-later", ["Gpl2Later", "GplCopy"]),
    ("GPL-3.0-or-later", ["Gpl3Later"]),
    ("GPL-2.0-or-later", ["Gpl2Later"]),
    ("GPL-3.0", ["Gpl3Name"]),
    ("GPL-2.0", ["Gpl2Name"]),
    ("Apache-2.0", ["Apache2Name"]),
    ("MIT", ["MitName"]),
    ("MIT", ["MitGrant"]),
    ("MPL-2.0", ["Mpl2Name"]),
    ("CC-BY-NC-4.0", ["CcByNcName"]),
    ("CC-BY-SA-4.0", ["CcBySaName"]),
    ("CC-BY-4.0", ["CcByName"]),
    ("Unlicense", ["Unlicense"]),
]
COPYRIGHT = "Copyright"
#: Every known sentence has one of these, so other texts need no further look; a sentence that has one but is not known counts as unknown.
HINT = "licen|copyright|permission|warrant|redistribut|free software|public domain|rights reserved|apache"
_JOINED = 4  # in the SQL, a sentence may be wrapped over so many lines


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), "[^a-z0-9.+]+", " "), F.lit(" ."))


def _bare(text: str) -> str:
    """A sentence without the dots at the ends of its words: a text is cut behind these, and the parts lose them."""
    return re.sub(r"\.(?= |$)", "", text)


def _matcher(sentences: Iterable[str]) -> tuple[list[str], str, int]:
    """What the first part of a sentence can be, a pattern for all sentences with parts between line ends (the shortest
    that ends with a part is found), and the most parts a sentence can have: one for each word.  The sentences have no dots
    at the ends of words; a text may have them where no cut was made."""
    words = [s.split(" ") for s in sorted(sentences, key=len)]
    begins = sorted({" ".join(w[:n]) for w in words for n in range(1, len(w) + 1)})
    return begins, "^(?:" + "|".join(r"(?:\.? |\n)".join(map(re.escape, w)) for w in words) + r")(?![^\n])", max(map(len, words))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, sentences, licences, n_known, n_unknown, n_unused of every row.

    A text is cut at line ends and after . ! ? ; or : with white space behind; any number of consecutive parts may make
    one sentence, the shortest known one counts.  ``sentences`` are the identifiers in their order, ``licences`` what the ordered
    rules make of them (each once, sorted).  Nothing leaves the row, so copies and hot sources do not matter.  Null
    and empty texts have neither; rows that share a doc_id are scanned one by one; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # between two words of a hint, a text may have whatever becomes a space or falls at a cut
    has_hint = F.translate(text, UPPER, LOWER).rlike(HINT.replace(" ", "[^a-z0-9+]+"))
    parts = F.split(F.regexp_replace(text, r"([.!?;:])\s+", "$1\n"), "\n")
    units = F.filter(F.transform(F.when(has_hint, parts).otherwise(F.array().cast("array<string>")), normalised), lambda u: u != "")
    sentences = {_bare(s): i for s, i in (SENTENCES | STANDARD).items()}
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    begins, pattern, most = _matcher(sentences)

    def bare(part: Column) -> Column:
        return F.replace(part, F.lit(". "), F.lit(" "))

    def named(unit: Column, i: Column) -> Column:
        found = F.regexp_extract(F.array_join(F.slice("__units", i + 1, most), "\n"), pattern, 0)
        sentence = F.when(bare(unit).isin(begins), F.try_element_at(known, bare(F.translate(found, "\n", " "))))
        return F.coalesce(sentence, F.when(F.get("__units", i).rlike("^copyright (c )?[0-9]{4}"), F.lit(COPYRIGHT)), F.lit(""))

    # the first character of ``__left`` is a bar, and each identifier has one after it
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("|" + "|".join(ids) + "|").alias("ids")) for name, ids in RULES])

    def tried(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["ids"])
        return F.struct(
            F.when(hit, F.replace(state["left"], rule["ids"], F.lit("|"))).otherwise(state["left"]).alias("left"),
            F.when(hit, F.concat(state["found"], F.array(rule["name"]))).otherwise(state["found"]).alias("found"))

    begin = F.struct(F.concat(F.lit("|"), F.array_join("__ids", "|"), F.when(F.size("__ids") > 0, F.lit("|")).otherwise(F.lit(""))).alias("left"),
                     F.array().cast("array<string>").alias("found"))
    df = docs.select("doc_id", units.alias("__units"))
    df = df.withColumn("__names", F.transform("__units", named))
    df = df.withColumn("__ids", F.filter("__names", lambda x: x != ""))
    df = df.withColumn("__end", F.aggregate(rules, begin, tried))
    unknown = F.filter("__units", lambda u, i: u.rlike(HINT) & (F.get("__names", i) == ""))
    unused = F.filter(F.split(F.col("__end.left"), r"\|"), lambda x: (x != "") & (x != COPYRIGHT))
    return df.select("doc_id", F.array_join("__ids", ",").alias("sentences"), F.array_join(F.array_sort(F.array_distinct("__end.found")), ",").alias("licences"),
                     F.size("__ids").cast("long").alias("n_known"), F.size(unknown).cast("long").alias("n_unknown"), F.size(unused).cast("long").alias("n_unused"))


def sql() -> str:
    """The same question in SQL; rules become nested replacements."""
    known = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    steps = []
    for k, (name, ids) in enumerate(RULES):
        mark = "|" + "|".join(ids) + "|"
        steps.append(f"r{k + 1} AS (SELECT d, replace(seq, '{mark}', '|') AS seq, CASE WHEN contains(seq, '{mark}') THEN list_append(found, '{name}') ELSE found END AS found FROM r{k})")
    clean = r"trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9.+]+', ' ', 'g'), ' .')"
    tries = ", ".join(f"(SELECT i FROM known WHERE s = array_to_string(u[p:p + {n}], ' '))" for n in range(_JOINED))
    return rf"""
WITH known(s, i) AS (VALUES {known}),
t AS (SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS t FROM documents),
u AS (SELECT d, doc_id, CASE WHEN regexp_matches(lower(t), '{HINT}') THEN
        list_filter(list_transform(string_split(regexp_replace(t, '([.!?;:])\s+', '\1' || chr(10), 'g'), chr(10)), lambda x: {clean}), lambda x: x <> '')
        ELSE [] END AS u FROM t),
n AS (SELECT d, p, u[p] AS s, coalesce({tries}, CASE WHEN regexp_matches(u[p], '^copyright (c )?[0-9]{{4}}') THEN '{COPYRIGHT}' END, '') AS i
      FROM (SELECT d, u, unnest(range(1, len(u) + 1)) AS p FROM u)),
q AS (SELECT d, string_agg(i, ',' ORDER BY p) FILTER (i <> '') AS ids, count(*) FILTER (i <> '') AS n_known,
             count(*) FILTER (i = '' AND regexp_matches(s, '{HINT}')) AS n_unknown FROM n GROUP BY d),
r0 AS (SELECT d, '|' || replace(ids, ',', '|') || '|' AS seq, []::VARCHAR[] AS found FROM q WHERE ids IS NOT NULL),
{", ".join(steps)}
SELECT doc_id, coalesce(ids, '') AS sentences, coalesce(array_to_string(list_sort(list_distinct(found)), ','), '') AS licences,
       coalesce(n_known, 0) AS n_known, coalesce(n_unknown, 0) AS n_unknown,
       coalesce(len(list_filter(string_split(seq, '|'), lambda x: x <> '' AND x <> '{COPYRIGHT}')), 0) AS n_unused
FROM u LEFT JOIN q ON q.d = u.d LEFT JOIN r{len(RULES)} r ON r.d = u.d
"""
