"""License scans by canonical digest: whole texts, and their lines, looked up among known ones.

Everything is a column expression or a join: case, punctuation, copyright lines
and equivalent spellings are made alike, the rest of the text is digested, and
the digest is joined with those of known texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as equal, first the one that is kept.
SPELLINGS = (
    ("acknowledgment", "acknowledgement"), ("analog", "analogue"), ("analyze", "analyse"), ("artifact", "artefact"),
    ("authorization", "authorisation"), ("authorized", "authorised"), ("cataloged", "catalogued"), ("center", "centre"),
    ("copyright holder", "copyright owner"), ("customize", "customise"), ("favor", "favour"),
    ("favorite", "favourite"), ("fulfill", "fulfil"), ("initialize", "initialise"), ("judgment", "judgement"),
    ("labeling", "labelling"), ("license", "licence"), ("licensed", "licenced"), ("merchantability", "merchantibility"),
    ("noncommercial", "non commercial"), ("optimize", "optimise"), ("organization", "organisation"),
    ("organize", "organise"), ("percent", "per cent"), ("program", "programme"), ("realize", "realise"),
    ("recognize", "recognise"), ("sublicense", "sub license"), ("utilize", "utilise"), ("while", "whilst"),
    ("willful", "wilful"),
)
# A line that only says whose the copyright is, and the sentence that may stand beside it.
COPYRIGHT_LINE = (r"\n[^\p{L}\p{N}\n]*(?:copyright[ \t]*(?:\(c\)|©|by |:|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|©)[^\n]*"
                  r"|\n[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*")

# Names that notices use, by SPDX identifier.
NAMES = {
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "Apache 2.0"),
    "MIT": ("the MIT License", "MIT"),
    "ISC": ("the ISC License",),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the Simplified BSD License"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the New BSD License"),
    "GPL-2.0-only": ("the GNU General Public License, version 2", "GPL v2"),
    "GPL-3.0-only": ("the GNU General Public License, version 3", "GPL v3"),
    "LGPL-3.0-only": ("the GNU Lesser General Public License, version 3", "LGPL v3"),
    "AGPL-3.0-only": ("the GNU Affero General Public License, version 3", "AGPL v3"),
    "MPL-2.0": ("the Mozilla Public License, Version 2.0", "the Mozilla Public License 2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
}
CREATIVE_COMMONS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
                    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
                    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
NOTICES = ("Licensed under {}", "Released under {}", "This work is licensed under {}", "Distributed under {}",
           "This software is released under {}", "This project is licensed under {}",
           "This program is licensed under {}", "Available under {}")

# Digests that a registry may hold: they are part of the plan.
MAX_KNOWN = 20_000

# Whole texts of short licences, without their copyright lines.
TEXTS = {
    "MIT": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "0BSD": """BSD Zero Clause License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "MIT-0": """MIT No Attribution

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause": """BSD 2-Clause License

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """BSD 3-Clause License

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity
of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""",
}


def known_texts() -> list[tuple[str, str]]:
    """(identifier, text) of all known texts: whole licences, and notices of one line made by rule."""
    names = [(key, name) for key, found in NAMES.items() for name in found]
    for short, long in CREATIVE_COMMONS.items():
        for version in ("3.0", "4.0"):
            key = f"CC-{short}-{version}"
            names += [(key, f"CC {short} {version}"), (key, f"Creative Commons {long} {version} International")]
    notices = [(key, notice.format(name)) for key, name in names for notice in NOTICES]
    tags = [(key, f"SPDX-License-Identifier: {key}") for key in sorted({key for key, _ in names})]
    return [*TEXTS.items(), *notices, *tags]


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation, one spelling; two spaces between words, lines stay apart.

    Each word has a space of its own on either side, so a spelling is found
    however often it follows itself.
    """
    lowered = F.lower(F.concat(F.lit("\n"), text))
    words = F.regexp_replace(F.regexp_replace(lowered, COPYRIGHT_LINE, "\n"), r"[^\p{L}\p{N}\n]+", "  ")
    spread = F.concat(F.lit("  "), F.replace(words, F.lit("\n"), F.lit("  \n  ")), F.lit("  "))
    for kept, other in SPELLINGS:
        spread = F.replace(spread, F.lit(apart(other)), F.lit(apart(kept)))
    return F.trim(F.regexp_replace(spread, r" *\n *", "\n"))


def apart(words: str) -> str:
    """A spelling as it stands in a canonical text, with a space on either side."""
    return f" {words.replace(' ', '  ')} "


def whole_digest(lines: Column) -> Column:
    """Digest of a canonical text, its lines joined by single spaces."""
    return F.md5(F.trim(F.regexp_replace(lines, r"[ \n]+", " ")))


def line_digests(lines: Column) -> Column:
    return F.transform(F.split(lines, "\n"), lambda line: F.md5(F.replace(line, F.lit("  "), F.lit(" "))))


def registry(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license) of known texts; equal texts keep the first identifier in order."""
    rows = spark.createDataFrame(texts or known_texts(), "license string, text string")
    return rows.groupBy(whole_digest(canonical(F.col("text"))).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, digest, license, notices): what the whole text is, and what its lines are.

    `known` is a registry of at most `MAX_KNOWN` rows: it is joined by
    broadcast, and its digests are looked up line by line. `license` is null
    if the whole text is not known; `notices` are the sorted identifiers of
    known lines, joined by commas. A null text has a null digest and no
    notices; an empty one has the digest of nothing. Rows that repeat a doc_id
    are looked up each. Other columns of `docs` are not used. A text is made
    canonical once and never moved. Runs a job when called, over the registry.
    """
    held = known.select("digest", "license").limit(MAX_KNOWN + 1).collect()
    if len(held) > MAX_KNOWN:
        raise ValueError(f"a registry has {MAX_KNOWN} digests at most")
    lines = docs.select("doc_id", canonical(F.col("text")).alias("lines"))
    listed = [row["digest"] for row in held]
    hits = F.filter(line_digests(F.col("lines")), lambda digest: digest.isin(listed))
    found = lines.select("doc_id", whole_digest(F.col("lines")).alias("digest"), hits.alias("hits"))
    names = F.create_map(*[F.lit(x) for row in held for x in (row["digest"], row["license"])]) if held else None
    named = F.transform("hits", lambda digest: names[digest]) if held else F.array().cast("array<string>")
    notices = F.coalesce(F.array_join(F.array_sort(F.array_distinct(named)), ","), F.lit(""))
    return found.join(F.broadcast(known), "digest", "left").select("doc_id", "digest", "license", notices.alias("notices"))
