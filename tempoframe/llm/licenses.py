"""License scans: normalised sentences become identifiers of known licence sentences, whose sequences match ordered rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm.workspace import table

# Sentences of public licence texts and notices, by identifier of three characters. They are compared
# in lower case with everything but letters and digits as one space, and end where BREAKS ends them.
SENTENCES = {
    "mt0": "Released under the MIT License",
    "mt1": "MIT License",
    "mt2": "Licensed under the MIT License",
    "mt6": "The MIT License",
    "mt7": "The MIT License (MIT)",
    "mt3": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mt4": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mt5": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "ap0": "Licensed under the Apache License, Version 2.0",
    "ap1": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "ap2": "you may not use this file except in compliance with the License",
    "ap3": "You may obtain a copy of the License at",
    "ap4": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "ap5": "See the License for the specific language governing permissions and limitations under the License",
    "ap6": "Apache License, Version 2.0",
    "gp0": "This work is licensed under the GNU General Public License, version 3",
    "gp1": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gp2": "either version 2 of the License, or (at your option) any later version",
    "gp3": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gp4": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gp5": "See the GNU General Public License for more details",
    "gp6": "GNU General Public License, version 3",
    "gp7": "GNU General Public License, version 2",
    "lg0": "GNU Lesser General Public License, version 3",
    "lg1": "GNU Lesser General Public License, version 2.1",
    "lg2": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lg3": "either version 2.1 of the License, or (at your option) any later version",
    "lg4": "See the GNU Lesser General Public License for more details",
    "ag0": "GNU Affero General Public License, version 3",
    "ag1": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "ag2": "See the GNU Affero General Public License for more details",
    "bs0": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bs1": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bs2": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bs3": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc0": "Licensed under CC BY-NC 4.0",
    "cc1": "Licensed under CC BY 4.0",
    "cc2": "Licensed under CC BY-SA 4.0",
    "cc3": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc4": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc5": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "mp0": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "mp1": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "is0": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "is1": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "zl0": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "un0": "This is free and unencumbered software released into the public domain",
}
# Rules, as licence and the sentences that must follow one another.
RULES = {
    "mit-notice": ("MIT", ("mt0",)),
    "mit-title": ("MIT", ("mt1",)),
    "mit-licensed": ("MIT", ("mt2",)),
    "mit-the-title": ("MIT", ("mt6",)),
    "mit-the-title-short": ("MIT", ("mt7",)),
    "mit-text": ("MIT", ("mt3", "mt4", "mt5")),
    "mit-full": ("MIT", ("mt1", "mt3", "mt4", "mt5")),
    "apache-2.0-notice": ("Apache-2.0", ("ap0",)),
    "apache-2.0-title": ("Apache-2.0", ("ap6",)),
    "apache-2.0-header": ("Apache-2.0", ("ap1", "ap2", "ap3", "ap4", "ap5")),
    "apache-2.0-header-plain": ("Apache-2.0", ("ap0", "ap4", "ap5")),
    "gpl-3.0-notice": ("GPL-3.0-only", ("gp0",)),
    "gpl-3.0-title": ("GPL-3.0-only", ("gp6",)),
    "gpl-2.0-title": ("GPL-2.0-only", ("gp7",)),
    "gpl-3.0-or-later-header": ("GPL-3.0-or-later", ("gp1", "gp3", "gp4", "gp5")),
    "gpl-2.0-or-later-header": ("GPL-2.0-or-later", ("gp2", "gp3", "gp4", "gp5")),
    "lgpl-3.0-title": ("LGPL-3.0-only", ("lg0",)),
    "lgpl-2.1-title": ("LGPL-2.1-only", ("lg1",)),
    "lgpl-3.0-or-later-header": ("LGPL-3.0-or-later", ("lg2", "gp3", "gp4", "lg4")),
    "lgpl-2.1-or-later-header": ("LGPL-2.1-or-later", ("lg3", "gp3", "gp4", "lg4")),
    "agpl-3.0-title": ("AGPL-3.0-only", ("ag0",)),
    "agpl-3.0-or-later-header": ("AGPL-3.0-or-later", ("ag1", "gp3", "gp4", "ag2")),
    "bsd-2-clause-text": ("BSD-2-Clause", ("bs0", "bs1", "bs2")),
    "bsd-3-clause-text": ("BSD-3-Clause", ("bs0", "bs1", "bs2", "bs3")),
    "cc-by-nc-4.0-notice": ("CC-BY-NC-4.0", ("cc0",)),
    "cc-by-nc-4.0-long": ("CC-BY-NC-4.0", ("cc4",)),
    "cc-by-4.0-notice": ("CC-BY-4.0", ("cc1",)),
    "cc-by-4.0-long": ("CC-BY-4.0", ("cc3",)),
    "cc-by-sa-4.0-notice": ("CC-BY-SA-4.0", ("cc2",)),
    "cc-by-sa-4.0-long": ("CC-BY-SA-4.0", ("cc5",)),
    "mpl-2.0-header": ("MPL-2.0", ("mp0", "mp1")),
    "isc-text": ("ISC", ("is0",)),
    "isc-text-and": ("ISC", ("is1",)),
    "zlib-text": ("Zlib", ("zl0",)),
    "unlicense-text": ("Unlicense", ("un0",)),
}
#: Every rule has a sentence with one of these words, which neither white space nor a line's end can part; other documents need no further look.
ANCHORS = ("licens", "permission", "redistribution", "unencumbered")
#: Sentences end at their marks before white space and at line ends; the second reading joins lines first, for wrapped
#: notices, and ends at lines of nothing but white space and marks of comments.
BREAKS = (r"[.!?;:]+(?:\s+|$)|\n+", r"[.!?;:]+(?:\s+|$)|\n[\s#*/;%-]*\n")
#: Unknown sentences that may stand between two sentences of a rule.
GAP = 2


def _normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _known() -> dict[str, str]:
    """Identifiers by normalised sentence."""
    return {re.sub("[^a-z0-9]+", " ", s.lower()).strip(): i for i, s in SENTENCES.items()}


def _sequence(text: Column, breaks: str) -> Column:
    """Recognised sentences of a text as structs of position (from 0) and identifier."""
    known = F.create_map(*(F.lit(x) for pair in _known().items() for x in pair))
    spoken = F.transform(F.split(text, breaks), lambda s, i: F.struct(i.cast("long").alias("pos"), known[_normal(s)].alias("id")))
    return F.filter(spoken, lambda x: x["id"].isNotNull())


def _coded(found: str) -> Column:
    """Identifiers as text of four characters each: a blank, or a mark after too many unknown sentences, and the identifier."""

    def code(x: Column, i: Column) -> Column:
        far = x["pos"] - F.get(found, i - 1)["pos"] > GAP + 1
        return F.concat(F.when(far, F.lit("!")).otherwise(F.lit(" ")), x["id"])

    return F.array_join(F.transform(found, code), "")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licences that documents state.

    Returns one row per document and licence: ``doc_id``, ``license``, ``rule`` (of the matching rules that with the most
    sentences), ``n_matches`` (places where that rule matches) and ``first_sentence`` (position of its first sentence,
    from 0). A rule matches where its sentences are recognised one after another with at most ``GAP`` unknown sentences
    between two. Whole texts are read line by line and again with lines joined; among rules of equal length the reading
    by lines counts, then more matches, the earliest place and the rule's name. Rows that share a doc_id are one
    document, of which the best match is reported. Null and empty texts state nothing; rows without an id are left out;
    other columns are ignored; an empty table gives no rows. Nothing is shuffled but the matches.
    """
    low = F.lower("text")
    likely = low.contains(ANCHORS[0])
    for word in ANCHORS[1:]:
        likely = likely | low.contains(word)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull() & likely)
    readings = F.array(*(_sequence(F.col("text"), b) for b in BREAKS))
    read = rows.select("doc_id", F.posexplode(readings).alias("reading", "found")).where(F.size("found") > 0)
    coded = read.select("doc_id", "reading", "found", F.inline(F.array(F.struct(_coded("found").alias("code")))))
    rules = [
        F.struct(F.lit(name).alias("rule"), F.lit(spdx).alias("license"), F.lit(len(ids)).alias("length"), F.lit(" ".join(ids)).alias("want"))
        for name, (spdx, ids) in RULES.items()
    ]
    hits = coded.select("doc_id", "reading", "found", "code", F.inline(F.array(*rules))).where(F.col("code").contains(F.col("want")))
    cut = F.length("code") - F.length(F.replace("code", "want", F.lit("")))
    at = F.floor((F.position("want", "code") - 2) / 4).cast("int")
    best = F.min_by(F.struct("rule", "n_matches", "first_sentence"), F.struct(-F.col("length"), "reading", -F.col("n_matches"), "first_sentence", "rule"))
    return (
        hits.withColumn("n_matches", (cut / F.length("want")).cast("long"))
        .withColumn("first_sentence", F.get("found", at)["pos"])
        .groupBy("doc_id", "license")
        .agg(best.alias("b"))
        .select("doc_id", "license", "b.rule", "b.n_matches", "b.first_sentence")
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences stated in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    known = ", ".join(f"('{k}', '{i}')" for k, i in _known().items())
    rules = ", ".join(f"('{name}', '{spdx}', {len(ids)}, '{' '.join(ids)}')" for name, (spdx, ids) in RULES.items())
    readings = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS reading, string_split_regex(text, '{b}') AS parts FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL"
        for k, b in enumerate(BREAKS)
    )
    return rf"""
WITH known(sentence, id) AS (VALUES {known}),
rules(rule, license, length, want) AS (VALUES {rules}),
readings AS ({readings}),
spoken AS (SELECT doc_id, reading, unnest(parts) AS s, unnest(range(0, len(parts))) AS pos FROM readings),
found AS (
  SELECT doc_id, reading, pos, id, row_number() OVER w AS k, pos - lag(pos) OVER w > {GAP + 1} AS far
  FROM spoken JOIN known ON trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) = sentence
  WINDOW w AS (PARTITION BY doc_id, reading ORDER BY pos)),
coded AS (
  SELECT doc_id, reading, string_agg(CASE WHEN far THEN '!' ELSE ' ' END || id, '' ORDER BY pos) AS code
  FROM found GROUP BY doc_id, reading),
hits AS (
  SELECT doc_id, reading, license, rule, rules.length AS length, ((length(code) - length(replace(code, want, ''))) // length(want))::BIGINT AS n_matches,
         (instr(code, want) - 2) // 4 + 1 AS k
  FROM coded JOIN rules ON contains(code, want)),
ranked AS (
  SELECT h.doc_id, h.license, h.rule, h.n_matches, f.pos AS first_sentence,
         row_number() OVER (PARTITION BY h.doc_id, h.license ORDER BY h.length DESC, h.reading, h.n_matches DESC, f.pos, h.rule) AS r
  FROM hits h JOIN found f ON f.doc_id = h.doc_id AND f.reading = h.reading AND f.k = h.k)
SELECT doc_id, license, rule, n_matches, first_sentence FROM ranked WHERE r = 1"""


ORACLE = {"op3_license_scan": _oracle()}
