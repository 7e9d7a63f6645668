"""Licence scans: canonical texts looked up by digest."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import TEXTS

# Equivalent spellings (left) and the one kept (right), after the public
# list of the SPDX licence matching guidelines.
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "wilfull"), ("noncommercial", "non commercial"), ("copyright holder", "copyright owner"),
    ("per cent", "percent"), ("sub license", "sublicense"), ("https", "http"),
]

# Public licence texts and notices that must be matched.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_3 = _BSD_2.replace("\n\nTHIS SOFTWARE", "\n\n3. Neither the name of the {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE")
#: Names of the licences in headings and notices.
_NAMES = {
    "MIT": ["MIT License", "MIT License (MIT)"], "ISC": ["ISC License"], "Zlib": ["zlib License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License", "3-Clause BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GPL v2", "GPLv2"],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GPL v3", "GPLv3"],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPL v2.1", "LGPLv2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPL v3", "LGPLv3"],
    "AGPL-3.0-only": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPL v3", "AGPLv3"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"], "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    **{f"CC-{k}-4.0": [f"CC {k} 4.0", f"Creative Commons {v} 4.0 International License", f"Creative Commons {v} 4.0 License"]
       for k, v in {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
                    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}.items()},
}
_NOTICES = ["Licensed under {}.", "Released under {}.", "Distributed under {}.", "This work is licensed under {}.", "This project is licensed under {}.",
            "This software is licensed under {}.", "This software is released under {}.", "This file is licensed under {}.", "This content is licensed under {}.",
            "Available under {}.", "License: {}."]


def _unwrapped(text: str) -> str:
    return "\n\n".join(" ".join(p.split()) for p in re.split(r"\n[ \t]*\n", text))


def _full_texts() -> list[tuple[str, str]]:
    """Each licence's text, plain and under its usual headings; those with an appendix also without it;
    those whose lines break before "copyright", which reads as a copyright statement, also unwrapped."""
    texts = [("MIT", _MIT), ("ISC", _ISC), ("Zlib", _ZLIB), ("BSD-2-Clause", _BSD_2),
             *[("BSD-3-Clause", _BSD_3.format(who)) for who in ("copyright holder", "author", "project", "organization")], *TEXTS.items()]
    # bullets are signs and fall away, but numbers do not
    texts += [(i, re.sub(r"(?m)^\d\. ", "", t)) for i, t in texts if i.startswith("BSD-") and t != TEXTS.get(i)]
    for i, t in list(texts):
        for mark in ("END OF TERMS AND CONDITIONS", "How to Apply These Terms to Your New"):
            if mark in t:
                texts.append((i, t[:t.rindex(mark)] + (mark if mark.startswith("END") else "")))
        if re.search(r"(?mi)^[^\n]*\S[^\n]*\n[ \t]*(copyright[ \t]|\(c\)|©)", t):
            texts.append((i, _unwrapped(t)))
    out = []
    for i, t in texts:
        out.append((i, t))
        if len(t) < 5000:
            rights = "All rights reserved.\n\n"
            for name in _NAMES.get(i, []):
                out += [(i, f"{head}\n\n{r}{t}") for head in (name, f"The {name}") for r in ("", rights)]
            out.append((i, rights + t))
    return out


KNOWN = [
    *_full_texts(), ("LicenseRef-all-rights-reserved", "All rights reserved."),
    *[(i, notice.format(x)) for i, names in _NAMES.items() for name in names for x in (name, f"the {name}") for notice in _NOTICES],
    *[(i, f"SPDX-License-Identifier: {i}") for i in dict.fromkeys([*_NAMES, *TEXTS])],
]

#: A line that opens with a copyright statement and a year or holder is left out.
COPYRIGHT_LINE = r"(?dm)^[ \t]*(copyright[ \t]|\(c\)|©)[^\n]*"
NOT_WORD = r"[^\p{L}\p{N}\n]+"


def canonical(text: Column) -> Column:
    """Lower case, copyright lines out, everything but letters, digits and line ends to a
    space, one spelling of equivalent words.  Lines stay apart; words stand between double
    spaces at most, so ``tidy`` of a line or of the whole gives the canonical text."""
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    t = F.regexp_replace(F.concat(F.lit(" "), t, F.lit(" ")), NOT_WORD, "  ")
    t = F.replace(t, F.lit("\n"), F.lit("  \n  "))
    for a, b in EQUIVALENT:
        t = F.replace(t, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    return t


def tidy(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, " +", " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(license_id, digest) of the known licences: as many rows as the list has, a fixed size."""
    # an Arrow table becomes a local relation: a list of rows would start Python workers in the executors
    ids, texts = (pa.array([x[i] for x in known], pa.string()) for i in (0, 1))
    df = spark.createDataFrame(pa.table({"license_id": ids, "text": texts}))
    whole = tidy(F.replace(canonical(F.col("text")), F.lit("\n"), F.lit(" ")))
    # an exchange-free aggregate over a local list; a digest under two ids keeps the first
    return df.select("license_id", F.sha2(whole, 256).alias("digest")).groupBy("digest").agg(
        F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, known: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text_digest, license_id, n_license_lines, line_licenses of every row.

    ``text_digest`` is the SHA-256 of the canonical whole text and ``license_id`` the known
    licence with that digest (else null).  Each non-empty line is looked up in the same way:
    ``n_license_lines`` counts the lines that are a known licence notice in full and
    ``line_licenses`` lists their ids, distinct, in order, joined by commas.  The known
    digests are a list of fixed size and are broadcast; every document's digests meet them
    in a hash join.  A null text counts as empty; the empty text has a digest and no
    licence.  Rows that repeat an id and a text give as many rows.
    """
    lookup = F.broadcast(known.select(F.col("digest").alias("known_digest"), "license_id"))
    body = canonical(F.col(f"`{text}`"))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("key"), body.alias("body"))
    whole = F.sha2(tidy(F.replace(F.col("body"), F.lit("\n"), F.lit(" "))), 256)
    lines = F.filter(F.transform(F.split("body", "\n"), tidy), lambda x: x != "")
    units = F.concat(F.array(F.struct(F.lit(True).alias("whole"), whole.alias("digest"))),
                     F.transform(lines, lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(x, 256).alias("digest"))))
    unit = rows.select("doc_id", "key", F.explode(units).alias("u")).select("doc_id", "key", "u.whole", "u.digest")
    hit = unit.join(lookup, unit["digest"] == F.col("known_digest"), "left")
    out = hit.groupBy("doc_id", "key").agg(
        F.count(F.when(F.col("whole"), 1)).alias("rows"),
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("text_digest"),
        F.max(F.when(F.col("whole"), F.col("license_id"))).alias("license_id"),
        F.count(F.when(~F.col("whole"), F.col("license_id"))).alias("n"),
        F.collect_set(F.when(~F.col("whole"), F.col("license_id"))).alias("ids"))
    out = out.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return out.select("doc_id", "text_digest", "license_id", (F.col("n") / F.col("rows")).cast("long").alias("n_license_lines"),
                      F.array_join(F.array_sort("ids"), ",").alias("line_licenses"))
