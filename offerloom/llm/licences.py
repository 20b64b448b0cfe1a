"""License scans: whole texts looked up by the digest of their canonical form.

A text is lower-cased, its copyright lines go, equivalent spellings become one, and
punctuation and white space shrink to single spaces; what remains is hashed and
joined to the digests of known licences. An entire document is looked up, and so
is each of its lines, since a notice such as "Released under the MIT License."
is an entire text of one line. Digests are SHA-256, so equal ones are equal texts.

Line breaks do not matter for an entire text, apart from those around copyright lines.

The registry is a written table, so Spark knows its size before it plans: it is
broadcast if small, and else only ids and digests are shuffled. Of a document only
its matches move on, which are no more than the known licences.

Defined results: null and empty texts, and texts that are copyright lines only,
match nothing; a document may hold several licences and lists each once, sorted;
rows that repeat an id are one document and list the licences of all of them, one
row each; a null id matches nothing; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.session import staged

# Public licence notices and short licence texts by SPDX identifier.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted.",
    ),
)
# Fixed values: (SPDX identifier, titles it may begin with, entire text as published).
TEXTS = (
    (
        "MIT",
        ('MIT License', 'The MIT License', 'The MIT License (MIT)'),
        """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    ),
    (
        "BSD-2-Clause",
        ('BSD 2-Clause License',),
        """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "BSD-3-Clause",
        ('BSD 3-Clause License',),
        """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "ISC",
        ('ISC License',),
        """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "0BSD",
        ('BSD Zero Clause License', 'Zero-Clause BSD'),
        """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "Apache-2.0",
        (),
        """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    ),
    (
        "GPL-3.0-or-later",
        (),
        """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    ),
    (
        "GPL-2.0-or-later",
        (),
        """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License along
with this program; if not, write to the Free Software Foundation, Inc.,
51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.""",
    ),
    (
        "MPL-2.0",
        (),
        """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
)


def _variants() -> tuple[tuple[str, str], ...]:
    """Each entire text with and without a title and the line of rights, as published and on one line.

    A title or line of rights may stand before the text or not, on lines of its own or not.
    """
    out = []
    for licence, titles, text in TEXTS:
        for title in ("", *titles):
            for rights in ("", "All rights reserved."):
                head = "".join(f"{x}\n" for x in (title, rights) if x)
                out += [(licence, head + text), (licence, head + " ".join(text.split()))]
    return tuple(out)


KNOWN = NOTICES + _variants()
# SHA-256 of the canonical form of long public texts, entire and as published.
DIGESTS = (
    ("Apache-2.0", "30f252879a369658fc224e8227e895b73379d4925f9a2e6ca76cd07f39c6a303"),
    ("GPL-2.0-only", "8ceef37851021afc07e4d5138e4c1c58b285e876796ca1a6cfa5eaa9ffaea599"),
    ("GPL-3.0-only", "b4c42912d85182abb09e39f33b791d93201ac133838d0f9972b735a3e52acbff"),
    ("LGPL-2.1-only", "06f44ebf9515e6c412985cf8f2c6b133e91f457a1f520a900164472a54c1dc58"),
    ("LGPL-3.0-only", "99c1a85dc9c673acfd6a330c4a68bd319185c3d6b8f4888157bf159e2ee60285"),
    ("MPL-2.0", "d967acc6ac57ac0410b353c5ae5266cdc1affe6b50883a3da362e3028c5c1f19"),
    ("CC0-1.0", "92f195ae84ff559b03177551e6c1166f57d3cc30f5a7d806b4039e24906bd8de"),
)
# A copyright line, and (spelling, equal spelling) pairs before and after punctuation goes.
# The word needs a sign, a year or the place of one behind it; a line of a sentence that begins with it stays.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:(?:copyright|copr\.)[ \t]*(?:\(c\)|©|[\[<{(]?(?:[0-9]{4}|yyyy|year))|©|\(c\)[ \t]*[0-9]{4})[^\n]*$"
)
SPELLINGS = (("licence", "license"), ("https://", "http://"), ("&", " and "))
WORD_SPELLINGS = ((" sub license", " sublicense"), ("non commercial", "noncommercial"), (" version ", " v "))
NOT_WORD = r"[^\p{L}\p{N}\n]+"


def word_lines(text: Column) -> Column:
    """The lines of a text as words with a space between, without copyright lines and empty ones."""
    out = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(F.regexp_replace(out, COPYRIGHT_LINE, ""), NOT_WORD, " ")
    return F.filter(F.transform(F.split(out, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def spelled(words: Column) -> Column:
    """Words in their one spelling; of a whole text it does not depend on where its lines break."""
    out = F.concat(F.lit(" "), words, F.lit(" "))
    for old, new in WORD_SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out)


def whole_text(lines: Column) -> Column:
    return spelled(F.array_join(lines, " "))


def digest(canon: Column) -> Column:
    return F.sha2(canon, 256)


def known_licences(spark: SparkSession) -> DataFrame:
    """The registry of the built-in texts and digests."""
    texts = registry(spark.createDataFrame(KNOWN, "licence string, text string"))
    long = spark.createDataFrame(DIGESTS, "licence string, digest string")
    return texts.unionByName(long.withColumn("canon", F.lit(None).cast("string")))


def registry(texts: DataFrame) -> DataFrame:
    """(digest, canon, licence) of licence texts (licence, text); equal texts name the smallest licence."""
    canon = texts.select("licence", whole_text(word_lines(F.col("text"))).alias("canon"))
    known = canon.filter("canon <> ''").groupBy("canon").agg(F.min("licence").alias("licence"))
    return known.select(digest(F.col("canon")).alias("digest"), "canon", "licence")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, licences (sorted, distinct), whole (the licence that the entire text is), one row per document."""
    lines = docs.select("doc_id", word_lines(F.col("text")).alias("lines"))
    whole = whole_text(F.col("lines"))
    # an entire text of one line is listed once, as entire
    units = F.concat(
        F.array(F.struct(whole.alias("canon"), F.lit(True).alias("entire"))),
        F.transform(
            F.filter(F.array_distinct("lines"), lambda line: F.size("lines") > 1),
            lambda line: F.struct(spelled(line).alias("canon"), F.lit(False).alias("entire")),
        ),
    )
    exploded = lines.select("doc_id", F.inline(units)).filter("canon <> ''")
    exploded = exploded.select("doc_id", "entire", digest(F.col("canon")).alias("digest"))  # no text moves
    found = (
        exploded.join(staged(known.select("digest", "licence"), "licences"), "digest")
        .groupBy("doc_id")
        .agg(
            F.array_sort(F.collect_set("licence")).alias("licences"),
            F.min(F.when(F.col("entire"), F.col("licence"))).alias("whole"),
        )
    )
    none = F.array().cast("array<string>")
    return (
        docs.select("doc_id")
        .join(found, "doc_id", "left")
        .select("doc_id", F.coalesce("licences", none).alias("licences"), "whole")
    )


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_licences, licences as one comma-joined string, whole."""
    return found.select(
        "doc_id",
        F.size("licences").cast("long").alias("n_licences"),
        F.array_join("licences", ",").alias("licences"),
        "whole",
    )
