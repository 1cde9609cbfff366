"""License scans by sentence rules.

A text is cut into sentences, each sentence is normalised and looked up among the
sentences known from licences and notices; wordings of one sentence share an identifier. The recognised
identifiers, in order, are matched against licence rules: lists of identifiers that occur in
this order with at most ``max_gap`` other sentences, known or not, between two. A match inside a
longer match is dropped.

Texts are cut twice: at sentence ends and blank lines (licences wrap lines), and at every
line end (notices without a full stop). A rule counts if it matches in either. Comment leaders at line
starts go first, so a comment's empty line is blank and a leader like ``;`` ends no sentence.

Scale: no Python, and no shuffle but for recognised sentences. The known sentences are a
fixed table in code (``license_families`` has the notices by family and version), so the lookup
is a broadcast join by nature. Texts without one of the anchor words, which every known sentence contains,
are not cut.

Defined cases: null, empty and unlicensed texts have a row without licences; the same licence
twice counts once; rows equal in id and text have equal results.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm import license_families
from changeflow.llm.common import settle

MAX_GAP = 2
ANCHORS = ("licen", "copyright", "permission", "redistribut", "warrant", "liab", "public domain", "notice", "spdx",
           "unless required", "endorse", "free software", "merchantab", "creative commons", "cc by", "cc0",
           "reserved", "released under", "distributed under", "available under")

# Sentences of public licences and common notices, as published.
SENTENCES = {
    "mit.grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                 "furnished to do so, subject to the following conditions:",
    "mit.notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software.",
    "mit.warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
                    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
                    "NONINFRINGEMENT.",
    "mit.liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
                     "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
                     "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd.redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
                          "permitted provided that the following conditions are met:",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                  "and the following disclaimer.",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                  "and the following disclaimer in the documentation and/or other materials provided with the "
                  "distribution.",
    "bsd.endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                   "or promote products derived from this software without specific prior written permission.",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                 "in all copies.",
    "apache.header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache.comply": "you may not use this file except in compliance with the License.",
    "apache.copy": "You may obtain a copy of the License at",
    "apache.unless": "Unless required by applicable law or agreed to in writing, software distributed under the "
                     "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                     "either express or implied.",
    "apache.see": "See the License for the specific language governing permissions and limitations under the License.",
    "apache.short": "Licensed under the Apache License, Version 2.0.",
    "gpl.free2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "General Public License as published by the Free Software Foundation; either version 2 of the "
                 "License, or (at your option) any later version.",
    "gpl.free3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version.",
    "gpl.warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                    "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl.copy": "You should have received a copy of the GNU General Public License along with this program.",
    "gpl.short3": "This work is licensed under the GNU General Public License, version 3.",
    "mpl.header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mit.short": "Released under the MIT License.",
    "mit.title": "MIT License",
    "mit.under": "Licensed under the MIT License.",
    "ccbync.short": "Licensed under CC BY-NC 4.0.",
    "ccby.long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "ccbysa.long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "ccbync.long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "unlicense.domain": "This is free and unencumbered software released into the public domain.",
    "spdx.mit": "SPDX-License-Identifier: MIT",
    "spdx.apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx.gpl3": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx.bsd3": "SPDX-License-Identifier: BSD-3-Clause",
}

# Rule, licence, the identifiers in order.
RULES = (
    ("mit-text", "MIT", ("mit.grant", "mit.notice", "mit.warranty", "mit.liability")),
    ("mit-notice", "MIT", ("mit.short",)),
    ("mit-notice-licensed", "MIT", ("mit.under",)),
    ("mit-spdx", "MIT", ("spdx.mit",)),
    ("bsd-3-text", "BSD-3-Clause", ("bsd.redistribution", "bsd.source", "bsd.binary", "bsd.endorse")),
    ("bsd-2-text", "BSD-2-Clause", ("bsd.redistribution", "bsd.source", "bsd.binary")),
    ("bsd-3-spdx", "BSD-3-Clause", ("spdx.bsd3",)),
    ("isc-text", "ISC", ("isc.grant",)),
    ("apache-2-header", "Apache-2.0", ("apache.header", "apache.comply", "apache.copy", "apache.unless", "apache.see")),
    ("apache-2-notice", "Apache-2.0", ("apache.short",)),
    ("apache-2-spdx", "Apache-2.0", ("spdx.apache",)),
    ("gpl-2-header", "GPL-2.0-or-later", ("gpl.free2", "gpl.warranty", "gpl.copy")),
    ("gpl-3-header", "GPL-3.0-or-later", ("gpl.free3", "gpl.warranty", "gpl.copy")),
    ("gpl-3-notice", "GPL-3.0-only", ("gpl.short3",)),
    ("gpl-3-spdx", "GPL-3.0-or-later", ("spdx.gpl3",)),
    ("mpl-2-header", "MPL-2.0", ("mpl.header",)),
    ("cc-by-nc-notice", "CC-BY-NC-4.0", ("ccbync.short",)),
    ("cc-by-nc-notice-long", "CC-BY-NC-4.0", ("ccbync.long",)),
    ("cc-by-notice", "CC-BY-4.0", ("ccby.long",)),
    ("cc-by-sa-notice", "CC-BY-SA-4.0", ("ccbysa.long",)),
    ("unlicense-text", "Unlicense", ("unlicense.domain",)),
)

# A sentence ends at a mark before a blank or the end, or at a blank line.
SENTENCE_END = "[.!?;:]+(?:[ \\t-\\r]+|$)|\\r?\\n[ \\t]*\\r?\\n[ \\t-\\r]*"
LINE_END = "[.!?;:]+(?:[ \\t-\\r]+|$)|[\\r\\n]+"
# Comment marks at a line's start, also those of boxes, and the indent after them. Normalising drops them anyway.
LEADERS = "(?m)^[ \\t/*#;%!|<>='\"-]+"

# "GPLv2+" is another licence than "GPLv2".
PLUS = "([0-9])\\+"
# Whose name a BSD text protects differs from project to project.
OWNER = "^neither the names? of .{1,200}? nor the names? of (its|their|any|other) contributors may"
# Notices say in many ways what is granted; the verb stays, as rules differ in it.
GRANT = "^(?:this [a-z]+ is )?(?:made )?(licensed|released|distributed|available) under (?:the terms of )?(?:the |an? )?"


def plain(sentence: str) -> str:
    """A normalised sentence as it is looked up."""
    return re.sub(GRANT, r"\1 under ", sentence)


def normalised(sentence: str) -> str:
    """Lower case, everything but letters and digits as one blank; a plus after a version is spelled out."""
    return re.sub("[^a-z0-9]+", " ", re.sub(PLUS, r"\1 or later ", sentence.lower())).strip()


def known_sentences(cut: str) -> dict[str, list[str]]:
    """Normalised pieces of each known sentence, as the cut makes them (a sentence may hold a semicolon)."""
    return {k: [p for p in map(normalised, re.split(cut, s)) if p] for k, s in SENTENCES.items()}


def _tables() -> tuple[list[tuple[str, str]], list[tuple[str, str, list[str]]]]:
    """(piece id, normalised piece) and (rule, licence, piece ids in order)."""
    pieces: dict[str, str] = {}
    of: dict[str, list[str]] = {}
    for name, parts in known_sentences(SENTENCE_END).items():
        of[name] = [pieces.setdefault(p, name if len(parts) == 1 else f"{name}.{k}") for k, p in enumerate(parts)]
    more, more_rules = license_families.families()
    taken = {plain(p) for p in pieces}
    for name, wordings in (license_families.WORDINGS | more).items():
        for wording in wordings:
            parts = [p for p in map(normalised, re.split(SENTENCE_END, wording)) if p]
            if name.startswith("notice.") and plain(parts[0]) in taken:
                continue                                                 # a rule of its own has it
            ids = of.setdefault(name, [pieces.setdefault(p, name if len(parts) == 1 else f"{name}.{k}")
                                       for k, p in enumerate(parts)])
            if len(ids) != len(parts):
                raise ValueError(f"wordings of {name} differ in their pieces")
            for p, sid in zip(parts, ids):
                pieces.setdefault(p, sid)
    rules = [(rule, licence, [p for s in sentences for p in of[s]]) for rule, licence, sentences in RULES]
    for rule, licence, sentences in more_rules:
        want = [p for s in sentences for p in of.get(s, [])]
        if want and all(want != ids for _, _, ids in rules):
            rules.append((rule, licence, want))
    return sorted((k, p) for p, k in pieces.items()), rules


PIECES, PIECE_RULES = _tables()
_FOUND_BY = [normalised(a) for a in ANCHORS]
_EVERY = [*SENTENCES.values(), *(w for more in (license_families.WORDINGS, license_families.families()[0])
                                 for ws in more.values() for w in ws)]
if any(not any(a in normalised(w) for a in _FOUND_BY) for w in _EVERY):
    raise ValueError("a known sentence holds no anchor word")


def _sentences(text: Column, cut: str) -> Column:
    def norm(s: Column) -> Column:
        s = F.trim(F.regexp_replace(F.regexp_replace(F.lower(s), PLUS, "$1 or later "), "[^a-z0-9]+", " "))
        s = F.regexp_replace(s, GRANT, "$1 under ")
        return F.regexp_replace(s, OWNER, "neither the name of the copyright holder nor the names of $1 contributors may")
    parts = F.transform(F.split(text, cut), norm)
    return F.filter(parts, lambda s: s != "")


def rule_matches(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 max_gap: int = MAX_GAP) -> DataFrame:
    """(doc, th, cut, rule, license, first, last): rule matches by sentence number, longest only."""
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    anchors = "(?i)" + "|".join(a.replace(" ", "[^a-z0-9]+") for a in ANCHORS)
    some = docs.where(F.rlike(text, F.lit(anchors))).select(
        F.col(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("th"), text.alias("raw"))
    some = settle(some, t=F.regexp_replace("raw", LEADERS, ""))
    cuts = F.array(F.struct(F.lit("sentence").alias("cut"), _sentences(F.col("t"), SENTENCE_END).alias("s")),
                   F.struct(F.lit("line").alias("cut"), _sentences(F.col("t"), LINE_END).alias("s")))
    cut = some.select("doc", "th", F.inline(cuts))
    rows = cut.select("doc", "th", "cut", F.posexplode("s").alias("pos", "sentence"))
    known = spark.createDataFrame([(sid, plain(p)) for sid, p in PIECES], "sid string, sentence string")
    seen = rows.join(F.broadcast(known), "sentence").select("doc", "th", "cut", "pos", "sid").distinct()

    longest = max(len(ids) for _, _, ids in PIECE_RULES)
    text_order = Window.partitionBy("doc", "th", "cut").orderBy("pos")
    ahead = text_order.rangeBetween(0, (longest - 1) * (max_gap + 1))
    seen = seen.withColumns({"ids": F.collect_list("sid").over(ahead), "at": F.collect_list("pos").over(ahead)})
    rules = spark.createDataFrame([(r, lic, ids, ids[0]) for r, lic, ids in PIECE_RULES],
                                  "rule string, license string, want array<string>, sid string")
    n = F.size("want")
    # The places where the identifiers so far can end.
    ends = F.aggregate(F.slice("want", F.lit(2), n), F.array("pos"), lambda ends, sid: F.filter(
        F.col("at"), lambda p, j: (F.get("ids", j) == sid) & F.exists(ends, lambda e: (e < p) & (p - e <= max_gap + 1))))
    found = seen.join(F.broadcast(rules), "sid").withColumn("last", F.array_min(ends)).where("last is not null")
    found = found.select("doc", "th", "cut", "rule", "license", F.col("pos").alias("first"), "last", n.alias("n"))
    # By start, longest first: a match is inside an earlier one if that one reaches as far.
    earlier = Window.partitionBy("doc", "th", "cut").orderBy("first", F.desc("last"), F.desc("n"), "rule").rowsBetween(
        Window.unboundedPreceding, -1)
    reached = F.max("last").over(earlier)
    return found.withColumn("reached", reached).where(F.col("reached").isNull() | (F.col("reached") < F.col("last"))).drop(
        "reached", "n")


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 max_gap: int = MAX_GAP) -> DataFrame:
    """One row per document: ``id_col``, ``n_rules`` (different rules matched), ``rules`` and ``licenses`` (sorted,
    comma-joined, empty if none)."""
    found = rule_matches(docs, id_col=id_col, text_col=text_col, max_gap=max_gap).groupBy("doc", "th").agg(
        F.array_sort(F.collect_set("rule")).alias("rules"), F.array_sort(F.collect_set("license")).alias("licenses"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("own"))
    out = rows.join(found, (F.col("own") == F.col("th")) & F.col("id").eqNullSafe(F.col("doc")), "left")
    return out.select(F.col("id").alias(id_col), F.greatest(F.coalesce(F.size("rules"), F.lit(0)), F.lit(0)).cast(
        "long").alias("n_rules"), F.coalesce(F.array_join("rules", ","), F.lit("")).alias("rules"),
        F.coalesce(F.array_join("licenses", ","), F.lit("")).alias("licenses"))
