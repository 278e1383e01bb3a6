"""Licence scan by canonical digest lookup, on DataFrame functions alone.

A text is normalised (case, punctuation, copyright lines, equivalent
spellings, blanks), hashed as a whole and hash-joined to the digests of known
licence texts; its lines are looked up in the same way against known notices.
The known table is a fixed list, so it is broadcast; a table of the caller only
below a row bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, text_of

# Published licence texts and notices, by SPDX identifier.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {who} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:"""
_BSD_TERMS = ["""Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.""", """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.""",
              """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""]


def _bsd(terms: int) -> list[str]:
    """A BSD text with numbered and with bulleted terms, by each word for the holder."""
    marks = [[f"{k + 1}. " for k in range(terms)], ["* "] * terms]
    return ["\n\n".join([_BSD_HEAD, *(m + t for m, t in zip(mark, _BSD_TERMS)), _BSD_AS_IS.format(who=who)])
            for mark in marks for who in ("HOLDER", "HOLDERS", "OWNER")]


#: Whole texts: identifier, titles, texts.
TEXTS = [
    ("MIT", ["MIT License", "The MIT License", "The MIT License (MIT)"], [_MIT]),
    ("ISC", ["ISC License", "The ISC License"], [_ISC]),
    ("Zlib", ["zlib License", "The zlib License"],
     [_ZLIB, _ZLIB.replace("\n1. ", "\n").replace("\n2. ", "\n").replace("\n3. ", "\n")]),
    ("BSD-2-Clause", ["BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'], _bsd(2)),
    ("BSD-3-Clause", ["BSD 3-Clause License", "The 3-Clause BSD License",
                      'BSD 3-Clause "New" or "Revised" License'], _bsd(3)),
]
_CC = "Creative Commons Attribution"
#: Names used in notices, by identifier; OPENINGS stand before them.
NAMES = {
    "MIT": ["MIT License"], "ISC": ["ISC License"], "Zlib": ["zlib License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License"],
    "GPL-2.0": ["GNU General Public License, version 2"],
    "GPL-3.0": ["GNU General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License 2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    **{f"CC-{short}-4.0": [f"CC {short} 4.0", f"CC {short} 4.0 License",
                           *(f"{_CC}{name} 4.0{kind}" for name in names
                             for kind in ("", " License", " International", " International License"))]
       for short, names in {"BY": [""], "BY-SA": ["-ShareAlike"], "BY-ND": ["-NoDerivatives", "-NoDerivs"],
                            "BY-NC": ["-NonCommercial", "-Non-Commercial"],
                            "BY-NC-SA": ["-NonCommercial-ShareAlike", "-Non-Commercial-ShareAlike"],
                            "BY-NC-ND": ["-NonCommercial-NoDerivatives", "-NonCommercial-NoDerivs"]}.items()},
}
OPENINGS = ["Licensed", "Released", "This work is licensed", "This project is licensed", "This software is licensed"]
KNOWN: list[tuple[str, str]] = [
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    *((k, f"{title}\n\n{text}".strip()) for k, titles, texts in TEXTS for text in texts for title in ("", *titles)),
    *((k, f"{opening} under {article}{name}.") for k, names in NAMES.items() for name in names
      for opening in OPENINGS for article in ("", "the ", "a ")),
    *((k, f"SPDX-License-Identifier: {k}") for k in NAMES),
    *((k, title) for k, titles, _ in TEXTS for title in titles),
    *((k, f"SPDX-License-Identifier: {k}{how}") for k in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
      for how in ("", "-only", "-or-later")),
    *(("MIT OR Apache-2.0", f"SPDX-License-Identifier: {choice}") for choice in ("MIT OR Apache-2.0", "Apache-2.0 OR MIT")),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
]
# Spellings that licence matching treats as equal.
SPELLINGS = [("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"),
             ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorise", "authorize"),
             ("favour", "favor"), ("fulfil", "fulfill"), ("judgement", "judgment"), ("labour", "labor"),
             ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"),
             ("recognise", "recognize"), ("version", "v"), ("ver", "v")]
#: Patterns valid in both Java and RE2; lines are kept apart until the last step.
#: A copyright notice is a line that begins with the word and a sign, a year or a
#: placeholder; at the head of a paragraph also one where a name follows, that is
#: not holder, owner or notice.  Other lines that wrapping makes begin so are text.
_MARK = r"(?:\(c\)|©|&copy;|[0-9]{4}|[<\[{])"
_NAME = r"(?:[^hon \t\r\n,;.)]|h[^o\n]|ho[^l\n]|hol[^d\n]|o[^w\n]|ow[^n\n]|n[^o\n]|no[^t\n]|not[^i\n])"
COPYRIGHT_LINE = (rf"(?:\A|\n)[ \t]*(?:copyright[ \t:,]*(?:by[ \t]+)?{_MARK}|\(c\)[ \t]*(?:copyright\b|{_MARK})|©|&copy;)"
                  rf"[^\n]*|(?:\A|\n[ \t\r]*\n)[ \t]*copyright[ \t]+{_NAME}[^\n]*")
RIGHTS_LINE = r"(?m)^[ \t]*all rights reserved\.?[ \t]*$"
NOT_WORD = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """Normalised text, lines still apart; words are separated by one space and
    every line begins and ends with one."""
    c = F.lower(text)
    marked = c.contains("copyright") | c.contains("(c)") | c.contains("©") | c.contains("&copy;")
    c = F.when(marked, F.regexp_replace(c, COPYRIGHT_LINE, "")).otherwise(c)     # the pattern is dear
    c = F.regexp_replace(F.regexp_replace(c, RIGHTS_LINE, ""), NOT_WORD, " ")
    c = F.concat(F.lit(" "), F.regexp_replace(c, " ?\n ?", " \n "), F.lit(" "))
    for other, usual in SPELLINGS:
        c = F.replace(c, F.lit(f" {other} "), F.lit(f" {usual} "))
    return c


def canonical(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_digests(spark: SparkSession) -> DataFrame:
    """``(digest, license, chars)`` of the fixed list; ``chars`` is the length of
    the normalised text."""
    known = spark.createDataFrame(KNOWN, "license string, text string")
    norm = canonical(canonical_lines(F.col("text")))
    return known.select(F.sha2(norm, 256).alias("digest"), "license", F.length(norm).alias("chars")).distinct()


def _line_lookup(known: DataFrame) -> tuple[dict[str, list[str]], set[int]]:
    """Licences by digest and the lengths of their texts (none where the table does
    not tell), of a table with a proven bound on its rows."""
    chars = F.col("chars") if "chars" in known.columns else F.lit(None).cast("int")
    names: dict[str, set[str]] = {}
    sizes = set()
    for r in known.select("digest", "license", chars.alias("chars")).collect():
        names.setdefault(r["digest"], set()).add(r["license"])
        sizes.add(r["chars"])
    return {d: sorted(n) for d, n in names.items()}, set() if None in sizes else sizes


def _licences_of(lines: Column, names: dict[str, list[str]], sizes: set[int]) -> Column:
    """Licences of the lines of a normalised text, row by row: a line is hashed where its length may match."""
    if not names:
        return F.lit("")
    items = F.transform(F.split(lines, "\n"), lambda x: F.trim(x))
    items = F.filter(items, lambda x: F.length(x).isin(*sizes) if sizes else x != "")
    found = F.filter(F.transform(items, lambda x: F.sha2(x, 256)), lambda d: d.isin(*names))
    table = F.create_map(*[F.lit(x) for d, n in names.items() for x in (d, ",".join(n))])
    each = F.flatten(F.transform(found, lambda d: F.split(F.element_at(table, d), ",")))
    return F.array_join(F.array_sort(F.array_distinct(each)), ",")


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  known: DataFrame | None = None) -> DataFrame:
    """Per row: ``doc_id, canonical_sha256, license`` (of the entire text, else
    null) and ``line_licenses`` (distinct licences of its lines, sorted and
    comma-separated; empty without any).  Every text is normalised once, and no
    row is shuffled: the fixed list is broadcast to the join of entire texts and
    looked up line by line.  ``known(digest, license)`` replaces the list;
    beyond ``BROADCAST_ROWS`` rows its lines are joined instead.

    Null text is empty and matches nothing; repeated rows get the same result;
    an empty table gives an empty result; other columns are ignored."""
    spark = docs.sparkSession
    given = known
    known = known_digests(spark) if given is None else given
    rows = docs.select(docs[id_col].alias("doc_id"), canonical_lines(text_of(docs, text_col)).alias("_lines"))
    digest = F.sha2(canonical(F.col("_lines")), 256).alias("canonical_sha256")
    if given is not None and given.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return _scan_by_joins(rows.select("doc_id", "_lines", digest), given)
    slim = rows.select("doc_id", digest, _licences_of(F.col("_lines"), *_line_lookup(known)).alias("line_licenses"))
    whole = F.broadcast(_one_row_a_digest(known))
    return slim.join(whole, "canonical_sha256", "left").select("doc_id", "canonical_sha256", "license", "line_licenses")


def _one_row_a_digest(known: DataFrame) -> DataFrame:
    """A digest that stands for several licences names them all, sorted and comma-separated."""
    return known.groupBy(F.col("digest").alias("canonical_sha256")).agg(
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("license"))


def _scan_by_joins(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The same against a table of any size."""
    line = F.explode(F.array_distinct(F.transform(F.split("_lines", "\n"), lambda x: F.trim(x))))
    lines = (rows.select("doc_id", "canonical_sha256", line.alias("_line")).where("_line <> ''")
             .select("doc_id", "canonical_sha256", F.sha2("_line", 256).alias("digest"))
             .join(known, "digest").groupBy("doc_id", "canonical_sha256")
             .agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("line_licenses"))
             .select(F.col("doc_id").alias("_id"), F.col("canonical_sha256").alias("_sha"), "line_licenses"))
    whole = _one_row_a_digest(known)
    slim = rows.select("doc_id", "canonical_sha256").join(whole, "canonical_sha256", "left")
    return slim.join(lines, slim["doc_id"].eqNullSafe(lines["_id"]) & (slim["canonical_sha256"] == lines["_sha"]),
                     "left").select("doc_id", "canonical_sha256", "license",
                                    F.coalesce("line_licenses", F.lit("")).alias("line_licenses"))


def _sql_lines(expr: str) -> str:
    def quote(p):
        return "'" + p.replace("'", "''") + "'"
    c = f"lower({expr})"
    for pattern, to in ((COPYRIGHT_LINE, "''"), (RIGHTS_LINE, "''"), (NOT_WORD, "' '")):
        c = f"regexp_replace({c}, {quote(pattern)}, {to}, 'g')"
    c = f"' ' || regexp_replace({c}, ' ?\\n ?', ' ' || chr(10) || ' ', 'g') || ' '"
    for other, usual in SPELLINGS:
        c = f"replace({c}, ' {other} ', ' {usual} ')"
    return c


def oracle() -> str:
    values = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in KNOWN)
    whole = "sha256(trim(regexp_replace({}, '[ \\n]+', ' ', 'g')))"
    return f"""
WITH known AS (
  SELECT DISTINCT {whole.format('l')} AS digest, license
  FROM (SELECT license, {_sql_lines('text')} AS l FROM (VALUES {values}) AS k(license, text))),
rows AS (SELECT doc_id, {_sql_lines("coalesce(text, '')")} AS l FROM documents),
hashed AS (SELECT doc_id, l, {whole.format('l')} AS canonical_sha256 FROM rows),
lines AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses
  FROM (SELECT doc_id, unnest(string_split(l, chr(10))) AS line FROM rows) s
  JOIN known ON sha256(trim(line)) = known.digest
  WHERE trim(line) <> '' GROUP BY doc_id)
SELECT h.doc_id, h.canonical_sha256, k.license, coalesce(s.line_licenses, '') AS line_licenses
FROM hashed h LEFT JOIN known k ON k.digest = h.canonical_sha256 LEFT JOIN lines s ON s.doc_id = h.doc_id
"""
