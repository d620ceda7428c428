"""Licence scans by sentence rules.

A text is cut into sentences (at ``.!?:;`` before white space, at blank lines,
and before a line that opens a licence statement; a wrapped line goes on).
Sentences are normalised to their lower-case words and mapped to known licence
sentences; a document's sequence of sentence ids is then matched against
ordered rules. A rule names a run of neighbouring ids; the first rule takes its
ids away, later rules see what is left, so a full text wins over its parts.
Everything is a projection over whole texts: no row leaves its partition.

Defined results: a null or empty text has no sentences; null ids are carried
through; repeated rows give equal rows; copyright lines between sentences do
not break a run; known sentences that no rule takes are counted as unmatched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import LOWER, UPPER, WORD, let

# Sentences of public licence texts and notices, by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "MitGrant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                 "to permit persons to whom the Software is furnished to do so, subject to the following conditions",),
    "MitNotice": ("The above copyright notice and this permission notice shall be included in all copies or substantial portions "
                  "of the Software",),
    "MitAsIs": ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
                "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",),
    "MitLiability": ("IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
                     "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
                     "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",),
    "MitShort": ("Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT"),
    "ApacheShort": ("Licensed under the Apache License, Version 2.0", "Released under the Apache License, Version 2.0",
                    "SPDX-License-Identifier: Apache-2.0"),
    "ApacheUnder": ("Licensed under the Apache License, Version 2.0 (the \"License\")",),
    "ApacheComply": ("you may not use this file except in compliance with the License",),
    "ApacheCopy": ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "You may obtain a copy of the License at"),
    "ApacheAsIs": ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
                   "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",),
    "ApacheSee": ("See the License for the specific language governing permissions and limitations under the License",),
    "GplShort": ("This work is licensed under the GNU General Public License, version 3",
                 "Licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only"),
    "GplFree": ("This program is free software",),
    "GplRedistribute": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version",),
    "GplHope": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",),
    "CcByNcShort": ("Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CcByShort": ("Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    "BsdRedistribute": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                        "that the following conditions are met",),
    "BsdSource": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                  "disclaimer",),
    "BsdBinary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution",),
    "BsdEndorse": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission",),
    "BsdShort": ("SPDX-License-Identifier: BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    "Bsd2Short": ("SPDX-License-Identifier: BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    "MplShort": ("Licensed under the Mozilla Public License, version 2.0", "SPDX-License-Identifier: MPL-2.0"),
    "MplForm": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "Gpl2Short": ("Licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0-only"),
    "LgplShort": ("Licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0-only"),
    "AgplShort": ("Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0-only"),
    "IscShort": ("SPDX-License-Identifier: ISC", "Licensed under the ISC License"),
    "IscGrant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies",),
    "CcBySaShort": ("CC BY-SA 4.0", "Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0",
                    "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CcZeroShort": ("CC0 1.0", "Licensed under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"),
    "UnlicenseFree": ("This is free and unencumbered software released into the public domain", "SPDX-License-Identifier: Unlicense"),
}
# Ordered rules, a licence and the run of sentences that shows it.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("MitGrant", "MitNotice", "MitAsIs", "MitLiability")),
    ("Apache-2.0", ("ApacheUnder", "ApacheComply", "ApacheCopy", "ApacheAsIs", "ApacheSee")),
    ("GPL-3.0-or-later", ("GplFree", "GplRedistribute", "GplHope")),
    ("GPL-3.0-or-later", ("GplFree", "GplRedistribute")),
    ("BSD-3-Clause", ("BsdRedistribute", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdRedistribute", "BsdSource", "BsdBinary")),
    ("MIT", ("MitGrant",)),
    ("Apache-2.0", ("ApacheUnder",)),
    ("MIT", ("MitShort",)),
    ("Apache-2.0", ("ApacheShort",)),
    ("GPL-3.0-only", ("GplShort",)),
    ("CC-BY-NC-4.0", ("CcByNcShort",)),
    ("CC-BY-4.0", ("CcByShort",)),
    ("BSD-3-Clause", ("BsdShort",)),
    ("BSD-2-Clause", ("Bsd2Short",)),
    ("MPL-2.0", ("MplForm",)),
    ("MPL-2.0", ("MplShort",)),
    ("GPL-2.0-only", ("Gpl2Short",)),
    ("LGPL-3.0-only", ("LgplShort",)),
    ("AGPL-3.0-only", ("AgplShort",)),
    ("ISC", ("IscGrant",)),
    ("ISC", ("IscShort",)),
    ("CC-BY-SA-4.0", ("CcBySaShort",)),
    ("CC0-1.0", ("CcZeroShort",)),
    ("Unlicense", ("UnlicenseFree",)),
)
# Every known sentence has one of these; a text without any needs no cutting.
ANCHOR = "(?i)licen[cs]e|copyright|warrant|permission|redistribut|free software|cc by|cc0|unencumbered"
OPENERS = "\\n([^A-Za-z0-9\\n]*)(Licensed under|Released under|This work is|This program is|Permission is|Redistribution|SPDX|Copyright)"
SPDX = "SPDX-License-Identifier:([^\\n]*)"  # a line of its own
SENTENCE_END, BLANK_LINE = "[.!?:;]+([ \\t\\n\\r\\f\\x0B]+|$)", "\\n[^A-Za-z0-9\\n]*\\n"
MARK = "\x1e"


def normal(sentence: str) -> str:
    import re
    return " ".join(re.findall(WORD, sentence.translate(str.maketrans(UPPER, LOWER))))


Sentences, Rules = dict[str, tuple[str, ...]], tuple[tuple[str, tuple[str, ...]], ...]


def known(sentences: Sentences = SENTENCES) -> dict[str, str]:
    """normalised sentence -> identifier; a sentence the splitter would cut
    (at a colon) is known by its last part as well as whole."""
    return {normal(s): name for name, forms in sentences.items() for s in forms}


def sentence_ids(text: Column, sentences: Sentences = SENTENCES, anchor: str = ANCHOR) -> Column:
    """The known sentences of a text, in order, as '<A><B>..'."""
    t = F.regexp_replace(F.concat(F.lit("\n"), text), OPENERS, f"{MARK}$1$2")
    t = F.regexp_replace(F.regexp_replace(t, SPDX, f"SPDX-License-Identifier $1{MARK}"), BLANK_LINE, MARK)
    t = F.translate(F.regexp_replace(t, SENTENCE_END, MARK), UPPER, LOWER)
    ids = F.create_map(*[F.lit(x) for kv in known(sentences).items() for x in kv])
    names = F.transform(F.split(t, MARK), lambda s: F.try_element_at(
        ids, F.array_join(F.regexp_extract_all(s, F.lit(WORD), F.lit(0)), " ")))
    seq = F.array_join(F.transform(F.filter(names, lambda x: x.isNotNull()), lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    return F.when(text.rlike(anchor), seq).otherwise(F.lit(""))


def _count(s: Column, part: str) -> Column:
    return ((F.length(s) - F.length(F.replace(s, F.lit(part)))) / F.lit(len(part))).cast("long")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: Sentences = SENTENCES,
         rules: Rules = RULES, anchor: str = ANCHOR) -> DataFrame:
    """Per row: id, sentence_ids, n_sentences (known ones), licenses (in rule
    order, distinct), n_matches, n_unmatched. ``sentences`` (identifier ->
    forms) and ordered ``rules`` (licence, run of identifiers) may be given;
    every sentence must match ``anchor``, which tells texts worth cutting."""
    import re
    for s in (s for forms in sentences.values() for s in forms):
        if not re.search(anchor, s):
            raise ValueError(f"the anchor does not match the sentence {s!r}")
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(sentence_ids(F.col(text_col), sentences, anchor), F.lit("")).alias("sentence_ids"))
    left, found = F.col("sentence_ids"), []
    for name, run in rules:
        part = "".join(f"<{x}>" for x in run)
        found.append(F.when(F.contains(left, F.lit(part)), F.struct(F.lit(name).alias("name"), _count(left, part).alias("n"))))
        left = F.replace(left, F.lit(part), F.lit("|"))
    hits = F.filter(F.array(*found), lambda x: x.isNotNull())
    d = d.withColumn("r", F.when(F.col("sentence_ids") != "", F.struct(
        hits.alias("hits"), _count(left, "<").alias("left"))))
    return d.select("id", "sentence_ids", _count(F.col("sentence_ids"), "<").alias("n_sentences"),
                    F.coalesce(F.array_join(F.array_distinct(F.transform("r.hits", lambda x: x["name"])), ","), F.lit("")).alias("licenses"),
                    F.coalesce(F.aggregate("r.hits", F.lit(0).cast("long"), lambda a, x: a + x["n"]), F.lit(0).cast("long")).alias("n_matches"),
                    F.coalesce("r.left", F.lit(0).cast("long")).alias("n_unmatched"))


def oracle_sql() -> str:
    """DuckDB SQL of the scan over ``documents``."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    re_ = lambda s: s.replace("(?i)", "")
    ids = ", ".join(f"{q(k)}: {q(v)}" for k, v in known().items())
    steps, prev = [], "seq"
    for i, (name, run) in enumerate(RULES):
        part = "".join(f"<{x}>" for x in run)
        steps.append((name, f"replace({prev}, {q(part)}, '|')", f"(len({prev}) - len(replace({prev}, {q(part)}, ''))) // {len(part)}"))
        prev = f"s{i}"
    ctes = ",\n".join(f"r{i} AS (SELECT *, {st[1]} AS s{i}, {st[2]} AS c{i} FROM {'a' if i == 0 else f'r{i - 1}'})" for i, st in enumerate(steps))
    n = len(RULES)
    pick = ", ".join(f"CASE WHEN c{i} > 0 THEN {q(RULES[i][0])} END" for i in range(n))
    lists = f"list_filter([{pick}], lambda x: x IS NOT NULL)"
    first = f"list_filter({lists}, lambda x, i: list_position({lists}, x) = i)"
    return f"""
WITH t AS (SELECT doc_id, regexp_matches(coalesce(text, ''), {q(re_(ANCHOR))}, 'i') AS has,
  regexp_replace(chr(10) || coalesce(text, ''), {q(OPENERS)}, chr(30) || '\\1\\2', 'g') AS x FROM documents),
u AS (SELECT doc_id, has, regexp_replace(regexp_replace(x, {q(SPDX)}, 'SPDX-License-Identifier \\1' || chr(30), 'g'), {q(BLANK_LINE)}, chr(30), 'g') AS x FROM t),
v AS (SELECT doc_id, has, translate(regexp_replace(x, {q(SENTENCE_END)}, chr(30), 'g'), '{UPPER}', '{LOWER}') AS x FROM u),
n AS (SELECT doc_id, has, list_transform(string_split(x, chr(30)), lambda s: array_to_string(regexp_extract_all(s, {q(WORD)}), ' ')) AS k FROM v),
a AS (SELECT doc_id, CASE WHEN has THEN coalesce(array_to_string(list_transform(list_filter(list_transform(k, lambda s:
  MAP {{{ids}}}[s]), lambda s: s IS NOT NULL), lambda s: '<' || s || '>'), ''), '') ELSE '' END AS seq FROM n),
{ctes}
SELECT doc_id, seq AS sentence_ids, CAST(len(seq) - len(replace(seq, '<', '')) AS BIGINT) AS n_sentences,
  coalesce(array_to_string({first}, ','), '') AS licenses, CAST({' + '.join(f'c{i}' for i in range(n))} AS BIGINT) AS n_matches,
  CAST(len({prev}) - len(replace({prev}, '<', '')) AS BIGINT) AS n_unmatched
FROM r{n - 1}
"""
