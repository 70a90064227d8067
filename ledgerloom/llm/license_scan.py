"""Licence scans: whole texts in canonical form, looked up by digest among known licences.

The canonical form lower-cases, unifies quotes, dashes and equivalent spellings, drops copyright lines and comment
marks, and leaves words with single spaces. A copyright line is one that starts with a copyright mark and a year, a mark
or `by`, or says that all rights are reserved; prose that goes on from a line break with "copyright" or "(c)" stays, so the width
a licence is wrapped at does not matter. Texts and known licences are normalised alike and joined on the SHA-256 of
the form. All work is in DataFrame functions. One digest is one licence: of equal forms the smallest name counts.

Defined results: a null text is an empty one; a text whose form is empty matches nothing. Long texts are taken
whole. Repeated rows are each looked up. An empty table, or none of known licences, gives no match. Extra columns stay, but
`license` and `canonical_sha256` are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings, in the order they are applied to words of lower case.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "catalogue": "catalog", "centre": "center", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite",
    "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment",
    "labelling": "labeling", "labour": "labor", "licence": "license", "maximise": "maximize", "modelled": "modeled",
    "modelling": "modeling", "offence": "offense", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
    "noncommercial": "non commercial", "sublicence": "sublicense",
}
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN
NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS;
OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
# Short notices and licences that are known without a table of one's own.
NOTICES = {
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "MIT": """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": f"""Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
{BSD_DISCLAIMER}""",
    "BSD-3-Clause": f"""Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
{BSD_DISCLAIMER}""",
}

# Fixed values: (pattern, replacement) in the order of application; the patterns mean the same in Java and RE2.
STEPS = (
    # copyright lines
    ("(?m)^[^\\p{L}\\n(©]*(?:(?:copyright|©)[ \\t]*(?:\\(c\\)|©|[12][0-9]{3}|<|\\[|by )|\\(c\\)[ \\t]*(?:copyright|[12][0-9]{3}))[^\\n]*$", " "),
    ("(?m)^[^\\p{L}\\n]*all rights reserved[^\\n]*$", " "),
    ("[^\\p{L}\\p{N}]+", " "),  # punctuation, comment marks, line ends
)


def canonical(text: Column) -> Column:
    """The canonical form of a text without nulls."""
    out = F.lower(text)
    for pattern, to in STEPS:
        out = F.regexp_replace(out, pattern, to)
    words = "|".join(SPELLINGS)
    # Most texts have none of the spellings, and a replacement for each would read them many times over.
    spaced = F.concat(F.lit(" "), F.trim(out), F.lit(" "))
    return F.trim(F.transform(F.array(spaced), lambda s: F.when(s.rlike(f" (?:{words}) "), respelt_of(s)).otherwise(s))[0])


def respelt_of(spaced: Column) -> Column:
    """Each word has spaces of its own while words are replaced, so that of two in a row the second is found too."""
    doubled = F.replace(spaced, F.lit(" "), F.lit("  "))
    return F.replace(respelt(doubled), F.lit("  "), F.lit(" "))


def respelt(spaced: Column) -> Column:
    return reduce(lambda t, s: F.replace(t, F.lit(f" {s[0]} "), F.lit(f" {s[1]} ")), SPELLINGS.items(), spaced)


def digest(text: str = "text") -> Column:
    """SHA-256 of the canonical form, null where it is empty."""
    form = canonical(F.coalesce(F.col(text), F.lit("")))
    return F.transform(F.array(form), lambda f: F.when(f != "", F.sha2(f, 256)))[0]


def known_licenses(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in NOTICES.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def licenses_in(spark: SparkSession, folder: str) -> DataFrame:
    """(license, text) from a folder of whole licence texts, each named by its file without `.txt`."""
    texts = spark.read.text(folder, wholetext=True)
    name = F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), r"\.txt$", "")
    return texts.select(name.alias("license"), F.col("value").alias("text"))


def scan(docs: DataFrame, licenses: DataFrame, text: str = "text") -> DataFrame:
    """Add `canonical_sha256` and `license`, null where the whole text is no known licence. `licenses` has (license, text);
    whether it is broadcast is left to its measured size."""
    known = licenses.select(digest("text").alias("canonical_sha256"), "license").filter("canonical_sha256 IS NOT NULL")
    known = known.groupBy("canonical_sha256").agg(F.min("license").alias("license"))
    return docs.drop("license", "canonical_sha256").withColumn("canonical_sha256", digest(text)).join(known, "canonical_sha256", "left")


def sql() -> str:
    """The query of `scan` over the notices as DuckDB SQL."""
    def form(t: str) -> str:
        out = f"lower({t})"
        for pattern, to in STEPS:
            out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
        out = f"' ' || trim({out}, ' ') || ' '"
        out = f"replace({out}, ' ', '  ')"
        for a, b in SPELLINGS.items():
            out = f"replace({out}, ' {a} ', ' {b} ')"
        out = f"replace({out}, '  ', ' ')"
        return f"trim({out}, ' ')"

    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in NOTICES.items())
    return f"""
    WITH known AS (SELECT sha256(f) AS h, min(license) AS license FROM
        (SELECT license, {form('text')} AS f FROM (VALUES {rows}) l(license, text)) GROUP BY 1),
    d AS (SELECT doc_id, {form("coalesce(text, '')")} AS f FROM documents),
    e AS (SELECT doc_id, CASE WHEN f <> '' THEN sha256(f) END AS canonical_sha256 FROM d)
    SELECT doc_id, canonical_sha256, license FROM e LEFT JOIN known ON h = canonical_sha256"""
