"""Licence scan by canonical digests. DataFrame functions only.

The canonical form of a line: A-Z in lower case, runs of anything but letters and digits (all beyond
ASCII count as letters) as one space, equivalent spellings as one. A text is its non-empty canonical
lines, joined by a space, so its form doesn't depend on where it is wrapped. Which lines are copyright
statements is judged by shape and place, and a text has up to five forms:

- without marked statements: lines that begin with copyright (or portions copyright) and a year,
  (c) or sign, or with (c) and a year, and an "All rights reserved." that follows one;
- without the statements of its head: the head is what stands before the first line of text, with at
  most one title of up to ten words in it; every line of it that begins with the word goes;
- without those of them that stand before the title;
- without the marked and those of the head, and as it is.

The SHA-256 of each is joined with the digests of known licences, in the order both, head, before the title,
marked, as it is; so a line that is wrongly taken for a statement loses nothing. Not found is a statement wrapped
into several lines, of which only the first is seen, unless the known text has it too. Whole texts find licences, and
single lines, each taken as an entire text, find licence notices. ``text_digest`` is that of the first form.

Known are: the texts in ``TEXTS``; notices and tags of the families in ``FAMILIES`` and ``CC``, built
by rule; and the longer licences in ``DIGESTS``, each as it is and without its own statements.

Defined cases: null and empty texts have the digest of the empty text, which is no licence; a
repeated row is reported as often as it occurs, null ids too; columns other than ``doc_id`` and
``text`` are not read. The table of known digests is small or Spark shuffles it: nothing is forced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm.shared import stored

# Spellings that licence matching treats as equal.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "authorisation": "authorization",
    "authorised": "authorized",
    "behaviour": "behavior",
    "colour": "color",
    "favour": "favor",
    "honour": "honor",
    "judgement": "judgment",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "organisation": "organization",
    "recognised": "recognized",
    "unauthorised": "unauthorized",
    "whilst": "while",
    "http": "https",
}

# Short licences, as published.
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
    "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
    "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies."
ISC_WARRANTY = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
BSD_NAMES = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission."
)
BSD_WARRANTY = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
    "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be "
    "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
    "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
    "misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
)
BSL = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
    'covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare '
    "derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The "
    "copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following "
    "disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such "
    "copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE "
    'IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE "
    "LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
    "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
    "means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in "
    "the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
    "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
    'under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
    "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
WHOLE = [
    ("MIT", ["MIT License", "The MIT License", "The MIT License (MIT)"], MIT),
    ("ISC", ["ISC License", "The ISC License"], ISC_GRANT + ISC_NOTICE + ISC_WARRANTY),
    ("0BSD", ["BSD Zero Clause License", "Zero-Clause BSD"], ISC_GRANT + "." + ISC_WARRANTY),
    ("BSD-2-Clause", ["BSD 2-Clause License"], BSD_GRANT + BSD_WARRANTY),
    ("BSD-3-Clause", ["BSD 3-Clause License"], BSD_GRANT + BSD_NAMES + BSD_WARRANTY),
    ("Zlib", ["zlib License", "The zlib License"], ZLIB),
    ("BSL-1.0", ["Boost Software License - Version 1.0 - August 17th, 2003"], BSL),
    ("Unlicense", [], UNLICENSE),
    ("Unlicense", [], UNLICENSE + " For more information, please refer to <https://unlicense.org/>"),
]
# Name in running text, identifier; {} stands for each of the versions.
FAMILIES = [
    ("MIT License", "MIT", [""]),
    ("ISC License", "ISC", [""]),
    ("BSD 2-Clause License", "BSD-2-Clause", [""]),
    ("BSD 3-Clause License", "BSD-3-Clause", [""]),
    ("zlib License", "Zlib", [""]),
    ("Unlicense", "Unlicense", [""]),
    ("Apache License, Version {}", "Apache-{}", ["1.1", "2.0"]),
    ("Boost Software License, Version {}", "BSL-{}", ["1.0"]),
    ("Mozilla Public License, version {}", "MPL-{}", ["1.0", "1.1", "2.0"]),
    ("Eclipse Public License, version {}", "EPL-{}", ["1.0", "2.0"]),
    ("GNU General Public License, version {}", "GPL-{}", ["1.0", "2.0", "3.0"]),
    ("GNU Lesser General Public License, version {}", "LGPL-{}", ["2.1", "3.0"]),
    ("GNU Library General Public License, version {}", "LGPL-{}", ["2.0"]),
    ("GNU Affero General Public License, version {}", "AGPL-{}", ["1.0", "3.0"]),
    ("GNU Free Documentation License, version {}", "GFDL-{}", ["1.1", "1.2", "1.3"]),
]
NOTICES = ["Released under the {}.", "Licensed under the {}.", "This work is licensed under the {}."]
CC = ["BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]


def _texts() -> list[tuple[str, str]]:
    """(license, text) of the known short texts, tags and notices."""
    found = [("all-rights-reserved", "All rights reserved.")]
    for tag, titles, text in WHOLE:
        found += [(tag, text), *((tag, f"{title} {text}") for title in titles)]
    named = [(name.format(v), tag.format(v), v) for name, tag, versions in FAMILIES for v in versions]
    named += [(f"CC {kind} {v}", f"CC-{kind}-{v}", v) for kind in CC for v in CC_VERSIONS] + [("CC0 1.0", "CC0-1.0", "1.0")]
    for name, tag, version in named:
        # versions of the GNU licences are also written without the nought
        names = {name, name.removesuffix(".0")} if name.startswith("GNU") else {name}
        found += [(tag, notice.format(n)) for n in sorted(names) for notice in NOTICES]
        suffixes = ["", "-only", "-or-later"] if name.startswith("GNU") else [""]
        found += [(tag, f"SPDX-License-Identifier: {tag}{suffix}") for suffix in suffixes]
        if name.startswith("CC"):
            found += [(tag, f"Licensed under {name}."), (tag, f"This work is licensed under {name}.")]
    return found


TEXTS = _texts()
# Digests of the canonical forms of longer licences, as published: as they are and without their own statements.
DIGESTS = [
    ("Apache-2.0", "769f6cd740fe13ac62c8d735e4f75a44231f944dc392325d819290d7fb6b07e1"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("BSD-3-Clause", "ede163f2edeebd1d089aa16b5c070d0cb609da9e4b54694c28813a0d4b3cbb7a"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.2", "61501da4fb94cceda16cd9affa2c77a91451ac2041c3baac644d4090c86855de"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GFDL-1.3", "cdf3d9ad52a468f1e3a38b3cd70b6b38978b4acbb41cceee134bf4e2e6168fe4"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "d408d9dad6e4560274412e743ec3ba01007197655029f60544c308bc54f80499"),
    ("GPL-2.0", "0bfb659bf7eeb9921df1446a6a93beba70e0dc947eec10a42d26bb310dccd498"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "7d478223d8fcde6480339b8bbaadacf6b93d7007d04a13fbd30f71a80fd981a0"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "9ccbf81e2fd78db81966e466a22ed39318d0a4b4550cd69d1144dcf09722ff10"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "a9cc8dda4023821e198a2e1bee36afc3e68fce90828780c7bac37ffe33565e15"),
    ("LGPL-3.0", "3ce770135de37fc153de7af30789ebf6cf1e9ad54eb9b487647ea8aa9ccae9c2"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "9eab7902f21bef0326dee4ed0cae1402c781cbf1f8e3dbeed6fbe176d641bb13"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"a-z0-9\x{80}-\x{10FFFF}"
OTHER = f"[^{LETTERS}]+"
_START = f"^[^{LETTERS}]*(portions[^{LETTERS}]+)?"
#: A statement by its shape, wherever it stands: (c), a sign or a year follows.
MARKED = _START + rf"(copyright[^{LETTERS}]*(©|\(c\)|[0-9]{{4}}([^{LETTERS}]|$))|\(c\)[^{LETTERS}]*(copyright|©|[0-9]{{4}}([^{LETTERS}]|$))|©)"
#: A statement if it stands in the head.
BEGUN = _START + f"copyright([^{LETTERS}]|$)"
RIGHTS = "all rights reserved"
TITLE_WORDS = 10
#: The place of a digest of a line; those of a text's forms are 1 to 5.
LINE = 6
#: Kinds of the lines from the first on: s marked, c begun, r rights, t title, x text.
HEAD = "^[scr]*t?[scr]*"
LEAD = "^[scr]*"


def canonical_line(line: Column) -> Column:
    """The canonical form of a line in lower case."""
    spaced = F.regexp_replace(line, OTHER, " ")
    # two spaces between words, so that neighbours that are both replaced don't share one
    padded = F.concat(F.lit(" "), F.replace(F.btrim(spaced), F.lit(" "), F.lit("  ")), F.lit(" "))
    known = reduce(lambda c, pair: F.replace(c, F.lit(f" {pair[0]} "), F.lit(f" {pair[1]} ")), SPELLINGS.items(), padded)
    return F.btrim(F.replace(known, F.lit("  "), F.lit(" ")))


def line_kind(line: Column, canonical: Column) -> Column:
    """The kind of a line in lower case, of which the canonical form is given."""
    short = F.length(canonical) - F.length(F.replace(canonical, F.lit(" "), F.lit(""))) < TITLE_WORDS
    return (
        F.when(F.rlike(line, F.lit(MARKED)), F.lit("s"))
        .when(F.rlike(line, F.lit(BEGUN)), F.lit("c"))
        .when(canonical == RIGHTS, F.lit("r"))
        .when(short, F.lit("t"))
        .otherwise(F.lit("x"))
    )


def with_forms(texts: DataFrame) -> DataFrame:
    """``texts`` with lines (canonical, not empty) and forms: digests without both, head, lead, marked, nothing."""
    keep = texts.columns
    low = F.split(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), "\n")
    pairs = F.transform(low, lambda line: F.struct(line.alias("low"), canonical_line(line).alias("line")))
    cut = texts.withColumn("pairs", F.filter(pairs, lambda p: p["line"] != ""))
    kinds = F.transform("pairs", lambda p: line_kind(p["low"], p["line"]))
    cut = cut.select(*keep, F.transform("pairs", lambda p: p["line"]).alias("lines"), kinds.alias("kinds"))
    size = lambda pattern: F.length(F.regexp_extract(F.array_join("kinds", ""), pattern, 0))
    cut = cut.withColumns({"head": size(HEAD), "lead": size(LEAD)})

    def kind(i: Column) -> Column:
        return F.get("kinds", i)

    def in_head(i: Column) -> Column:
        return (i < F.col("head")) & kind(i).isin("s", "c", "r")

    def marked(i: Column) -> Column:
        return (kind(i) == "s") | ((kind(i) == "r") & F.coalesce(kind(i - 1) == "s", F.lit(False)))

    def digest(dropped: Column | None) -> Column:
        return F.sha2(F.array_join("lines" if dropped is None else dropped, " "), 256)

    forms = [
        digest(F.filter("lines", lambda _, i: ~(in_head(i) | marked(i)))),
        digest(F.filter("lines", lambda _, i: ~in_head(i))),
        digest(F.filter("lines", lambda _, i: i >= F.col("lead"))),
        digest(F.filter("lines", lambda _, i: ~marked(i))),
        digest(None),
    ]
    return cut.select(*keep, "lines", F.array(*forms).alias("forms"))


def known_licenses(spark: SparkSession) -> DataFrame:
    """license, digest: one row per digest."""
    texts = with_forms(spark.createDataFrame(TEXTS, "license string, text string"))
    digests = texts.select("license", F.explode("forms").alias("digest"))
    digests = digests.union(spark.createDataFrame(DIGESTS, "license string, digest string"))
    # what is a statement and nothing else is no licence
    return digests.where(F.col("digest") != F.sha2(F.lit(""), 256)).groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(documents: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, text_digest, license (of the whole text, or null), n_notices, notices (distinct, sorted)."""
    rows = with_forms(documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    digests = stored(
        rows.select(
            "row",
            "doc_id",
            F.col("forms")[0].alias("text_digest"),
            F.concat(
                F.transform(F.array_distinct("forms"), lambda d: F.struct(F.array_position("forms", d).cast("int").alias("place"), F.unhex(d).alias("digest"))),
                F.transform("lines", lambda line: F.struct(F.lit(LINE).alias("place"), F.unhex(F.sha2(line, 256)).alias("digest"))),
            ).alias("digests"),
        ),
        "license-digests",
    )
    lookup = known.select(F.unhex("digest").alias("digest"), "license")
    line = F.col("place") == LINE
    found = (
        digests.select("row", F.inline("digests"))
        .join(lookup, "digest")
        .groupBy("row")
        .agg(
            F.min(F.when(~line, F.struct("place", "license"))).alias("whole"),
            F.count(F.when(line, 1)).alias("n_notices"),
            F.array_sort(F.collect_set(F.when(line, F.col("license")))).alias("notices"),
        )
    )
    return (
        digests.select("row", "doc_id", "text_digest")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "text_digest",
            F.col("whole.license").alias("license"),
            F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
            F.coalesce(F.array_join("notices", ","), F.lit("")).alias("notices"),
        )
    )
