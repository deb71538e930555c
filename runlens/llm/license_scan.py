"""Operator 9 — licence recognition by sentence identifiers (built-in functions only).

A text is cut into sentences, each sentence is normalised (lower case, only
letters and digits, one blank between words) and looked up among known licence
sentences. The identifiers found, in text order, are matched against ordered
rules: a rule holds if its identifiers follow one another in that sequence
(sentences that are not licence sentences may stand between). Sentences are cut
twice, once also at line ends (notices on lines of their own) and once only at
sentence ends and blank lines (texts wrapped over lines); a rule may hold in either.
The longest rules come first and take the sentences they match, so a licence whose
sentences are the beginning of another's is not found in it; "all rights reserved" counts
only where no licence is recognised.

One projection per row: no shuffle, no join, no UDF. Rows without any word that
every known sentence must hold one of are answered without cutting; the names in SPDX lines,
which hold none, are looked for as words before a sentence or line end.

Defined results: a null or empty text has no licence (empty strings); every
input row gives one output row, repeated rows included; texts of any length are scanned whole; rules
of equal length go by licence, then by their sentences; an empty table gives no rows; columns of the added names are
replaced, other columns are carried along.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import table

# Sentences of public licence texts and notices. Name -> sentence as written.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-this": "This project is licensed under the MIT License",
    "mit-spdx": "SPDX-License-Identifier: MIT",
    "apache-you-may-not": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apache-licensed": "Licensed under the Apache License, Version 2.0",
    "apache-released": "Released under the Apache License, Version 2.0",
    "apache-head": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "apache-spdx": "SPDX-License-Identifier: Apache-2.0",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-licensed": "Licensed under the GNU General Public License, version 3",
    "gpl3-spdx": "SPDX-License-Identifier: GPL-3.0-only",
    "gpl3-spdx-later": "SPDX-License-Identifier: GPL-3.0-or-later",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2",
    "gpl2-spdx": "SPDX-License-Identifier: GPL-2.0-only",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-see": "See the GNU General Public License for more details",
    "lgpl-work": "This work is licensed under the GNU Lesser General Public License, version 3",
    "agpl-work": "This work is licensed under the GNU Affero General Public License, version 3",
    "agpl-spdx": "SPDX-License-Identifier: AGPL-3.0-only",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd3-spdx": "SPDX-License-Identifier: BSD-3-Clause",
    "bsd2-spdx": "SPDX-License-Identifier: BSD-2-Clause",
    "mpl-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-spdx": "SPDX-License-Identifier: MPL-2.0",
    "isc-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nd": "Licensed under CC BY-ND 4.0",
    "cc0": "Licensed under CC0 1.0",
    "cc-by-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "reserved": "All rights reserved",
}

# Ordered rules. Licence -> sequences of sentence names, any of which recognises it.
RULES = {
    "AGPL-3.0": [["agpl-work"], ["agpl-spdx"]],
    "Apache-2.0": [["apache-licensed"], ["apache-released"], ["apache-spdx"], ["apache-you-may-not"],
                   ["apache-head", "apache-comply"], ["apache-as-is", "apache-see"]],
    "BSD-2-Clause": [["bsd-redistribution", "bsd-source", "bsd-binary"], ["bsd2-spdx"]],
    "BSD-3-Clause": [["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"], ["bsd3-spdx"]],
    "CC-BY-4.0": [["cc-by"], ["cc-by-long"]],
    "CC-BY-NC-4.0": [["cc-by-nc"], ["cc-by-nc-long"]],
    "CC-BY-NC-SA-4.0": [["cc-by-nc-sa"]],
    "CC-BY-ND-4.0": [["cc-by-nd"]],
    "CC-BY-SA-4.0": [["cc-by-sa"]],
    "CC0-1.0": [["cc0"]],
    "GPL-2.0": [["gpl2-work"], ["gpl2-spdx"], ["gpl2-free"]],
    "GPL-3.0": [["gpl3-work"], ["gpl3-licensed"], ["gpl3-spdx"], ["gpl3-spdx-later"], ["gpl-free"]],
    "ISC": [["isc-permission"]],
    "LGPL-3.0": [["lgpl-work"]],
    "MIT": [["mit-released"], ["mit-licensed"], ["mit-this"], ["mit-spdx"], ["mit-grant", "mit-notice", "mit-as-is"]],
    "MPL-2.0": [["mpl-terms"], ["mpl-spdx"]],
    "Proprietary": [["reserved"]],
    "Unlicense": [["unlicense"]],
}

ANCHORS = ["licen", "reserved", "permission", "warrant", "liab", "redistribut", "copyright", "domain"]

LINE_CUT = r"[\r\n]+|[.!?;:]+(?:[ \t\f\r\n]+|$)"
BLOCK_CUT = r"[ \t\f\r]*\n[ \t\f\r]*\n[ \t\f\r\n]*|[.!?;:]+(?:[ \t\f\r\n]+|$)"


def normalised(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def _cut(sentence: str) -> list[str]:
    """A known sentence may itself hold sentence ends ("v. 2.0", "software; you"): its parts, as the scan
    cuts them. Only parts with an anchor word identify a sentence, but for SPDX lines."""
    spdx = sentence.startswith("SPDX")  # its second part names the licence
    parts = [n for n in (normalised(x) for x in re.split(LINE_CUT, sentence)) if n and (spdx or any(a in n for a in ANCHORS))]
    assert parts, sentence
    return parts


def sentence_ids() -> dict[str, int]:
    """Normalised sentence -> identifier (parts of one sentence have identifiers of their own)."""
    out: dict[str, int] = {}
    for sentence in SENTENCES.values():
        for part in _cut(sentence):
            out.setdefault(part, len(out) + 1)
    return out


def _unanchored() -> str:
    """What a text without anchor words must hold to have an identified sentence: one without such a word, up to where a cut may follow."""
    bare = ["[^a-z0-9]+".join(s.split()) for s in sentence_ids() if not any(a in s for a in ANCHORS)]
    return rf"(?<![a-z0-9])(?:{'|'.join(bare)})[^a-z0-9.!?;:\r\n]*+(?:[.!?;:\r\n]|$)"


LAST_RESORT = "Proprietary"  # only where nothing else is recognised


def rules() -> list[tuple[str, str]]:
    """(licence, identifier sequence as ' 4 7 '), the longest first."""
    ids = sentence_ids()
    found = [(licence, " " + " ".join(str(ids[p]) for name in seq for p in _cut(SENTENCES[name])) + " ")
             for licence, seqs in RULES.items() for seq in seqs]
    return sorted(found, key=lambda r: (-len(r[1].split()), r))


def _sequence(text: Column, cut: str, ids: dict[str, int]) -> Column:
    known = F.create_map(*[x for s, i in ids.items() for x in (F.lit(s), F.lit(str(i)))])
    sentences = F.split(text, cut, -1)
    found = F.transform(sentences, lambda s: F.try_element_at(known, F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))))
    return F.concat_ws(" ", F.filter(found, lambda x: x.isNotNull()))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``line_sentences`` and ``block_sentences`` (identifier sequences) and ``licenses``
    (recognised licences, sorted, comma separated). Columns of these names are replaced."""
    ids = sentence_ids()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    low = F.lower(text)
    # every identified sentence holds an anchor or is a bare name, so a row without any has no sentence to find
    anchored = F.lit(False)
    for a in ANCHORS:
        anchored = anchored | low.contains(a)
    anchored = anchored | low.rlike(_unanchored())
    out = docs.withColumn("line_sentences", F.when(anchored, _sequence(text, LINE_CUT, ids)).otherwise(""))
    out = out.withColumn("block_sentences", F.when(anchored, _sequence(text, BLOCK_CUT, ids)).otherwise(""))
    padded = F.concat(F.lit(" "), F.col("line_sentences"), F.lit(" | "), F.col("block_sentences"), F.lit(" "))
    ordered = F.array(*[F.struct(F.lit(licence).alias("licence"), F.lit(seq).alias("seq")) for licence, seq in rules()])
    start = F.struct(padded.alias("left"), F.array().cast("array<string>").alias("names"))
    # a rule that matches takes its sentences out of what the next ones see
    matched = F.aggregate(ordered, start, lambda a, r: F.when(a["left"].contains(r["seq"]), F.struct(
        F.replace(a["left"], r["seq"], F.lit(" ~ ")).alias("left"), F.array_append(a["names"], r["licence"]).alias("names"))).otherwise(a), lambda a: a["names"])
    names = F.array_sort(F.array_distinct(matched))
    others = F.array_remove(names, LAST_RESORT)
    any_found = (F.col("line_sentences") != "") | (F.col("block_sentences") != "")
    return out.withColumn("licenses", F.when(any_found, F.concat_ws(",", F.when(F.size(others) > 0, others).otherwise(names))).otherwise(""))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).select("doc_id", "licenses", "line_sentences", "block_sentences")


def oracle() -> str:
    """Another route: sentences as rows, joined with the known ones, sequences rebuilt by position."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({q(s)}, {i})" for s, i in sentence_ids().items())
    ruled = ", ".join(f"({i}, {q(licence)}, {q(seq)})" for i, (licence, seq) in enumerate(rules()))

    def sequence(cut: str) -> str:
        return f"""SELECT r, string_agg(CAST(k.id AS VARCHAR), ' ' ORDER BY p) AS ids FROM (
            SELECT r, unnest(parts) AS s, generate_subscripts(parts, 1) AS p FROM (
              SELECT r, string_split_regex(t, {q(cut)}) AS parts FROM d)) x
          JOIN known k ON k.s = trim(regexp_replace(lower(x.s), '[^a-z0-9]+', ' ', 'g')) GROUP BY r"""

    return f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
      known(s, id) AS (VALUES {known}), ruled(i, licence, seq) AS (VALUES {ruled}),
      a AS ({sequence(LINE_CUT)}), b AS ({sequence(BLOCK_CUT)}),
      f AS (SELECT d.r, doc_id, coalesce(a.ids, '') AS line_sentences, coalesce(b.ids, '') AS block_sentences
            FROM d LEFT JOIN a USING (r) LEFT JOIN b USING (r)),
      m AS (SELECT r, 0 AS i, ' ' || line_sentences || ' | ' || block_sentences || ' ' AS x, CAST(NULL AS VARCHAR) AS hit FROM f
              WHERE line_sentences <> '' OR block_sentences <> ''
            UNION ALL SELECT m.r, m.i + 1, replace(m.x, u.seq, ' ~ '), CASE WHEN contains(m.x, u.seq) THEN u.licence END FROM m JOIN ruled u ON u.i = m.i),
      h AS (SELECT DISTINCT r, hit FROM m WHERE hit IS NOT NULL),
      l AS (SELECT r, coalesce(string_agg(hit, ',' ORDER BY hit) FILTER (hit <> '{LAST_RESORT}'), '{LAST_RESORT}') AS licenses FROM h GROUP BY r)
      SELECT doc_id, coalesce(licenses, '') AS licenses, line_sentences, block_sentences FROM f LEFT JOIN l USING (r)"""
