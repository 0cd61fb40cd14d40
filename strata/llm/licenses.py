"""Licence scans: canonical digests of entire texts, joined with those of known licences.

A text is made canonical (case, equivalent spellings, copyright lines, punctuation, blanks) and
digested. What is looked up are entire texts: the document's, and that of each of its lines, as a
licence is mostly declared by a notice on a line of its own. The digests meet those of the known
texts in a hash join against a table whose size is the list's, not the data's. Built-in functions
only.

Defined results: a null text is empty; an empty canonical text matches nothing; repeated rows are
scanned each for itself; other columns pass through unread, and one named as the result is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Known texts by licence: short licences in full, and the notices in common use (fixed values).
KNOWN = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "Released under the Apache License 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This work is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE "
        "AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
        "Released under the ISC License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License v3.0.",
    ),
    "GPL-2.0": ("Licensed under the GNU General Public License, version 2.",),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT "
        "HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
        "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.",
        "Licensed under the BSD 2-Clause License.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. Neither the name of the copyright holder nor "
        "the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY "
        "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR "
        "A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
        "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
        "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        "Released under the 3-Clause BSD License.",
        "Licensed under the BSD 3-Clause License.",
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
        "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
        "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. "
        "Altered source versions must be plainly marked as such, and must not be misrepresented as "
        "being the original software. This notice may not be removed or altered from any source "
        "distribution.",
        "Licensed under the zlib License.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means. In jurisdictions that recognize copyright laws, the author or authors of this "
        "software dedicate any and all copyright interest in the software to the public domain. We "
        "make this dedication for the benefit of the public at large and to the detriment of our "
        "heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more "
        "information, please refer to <https://unlicense.org>",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.",),
}

#: Titles that a licence's full text may stand under (fixed values).
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "Zlib": ("zlib License", "The zlib License"),
    "Unlicense": ("The Unlicense",),
}
#: A known text of more characters is a full text.
FULL = 300

#: Spellings that count as one, for lower-case text; a phrase may be wrapped over lines.
SPELLINGS = (
    (r"licen[cs]e", "license"),
    (r"licencing", "licensing"),
    (r"copyright[ \t\n]+(?:owner|holder)s?", "copyright holder"),
    (r"neither[ \t\n]+the[ \t\n]+name[ \t\n]+of[^.;]{1,100}nor[ \t\n]+the[ \t\n]+names[ \t\n]+of[ \t\n]+its",
     "neither the name of the copyright holder nor the names of its"),
    (r"creative[ \t\n]+commons[ \t\n]+attribution", "cc by"),
    (r"https://", "http://"),
    (r"(^|[^\p{L}\p{N}])(?:version|v\.)[ \t\n]*([0-9])", "$1v$2"),
)
#: A line that names the holder of the rights or a year, or reserves all; not one that only goes on
#: about "the above copyright notice".
COPYRIGHT_LINE = (
    r"(^|\n)[ \t*#/-]*(?:copyright[ \t:]*(?:\(c\)|©|[0-9])|copyright[^\n]*[0-9]{4}|\(c\)|©|all rights reserved)[^\n]*"
)
#: What a listed condition begins with.
LIST_MARK = r"(^|\n)[ \t]*(?:\(?[0-9a-z][.)]|[*-])[ \t]+"
PUNCTUATION = r"[^\p{L}\p{N}\n]+"


def canonical(text: Column) -> Column:
    """Lower-case words with single blanks, lines kept apart."""
    made = F.lower(F.coalesce(text, F.lit("")))
    made = F.regexp_replace(made, COPYRIGHT_LINE, "$1")
    made = F.regexp_replace(made, LIST_MARK, "$1")
    for pattern, spelling in SPELLINGS:
        made = F.regexp_replace(made, pattern, spelling)
    return F.regexp_replace(made, PUNCTUATION, " ")


def whole(canon: Column) -> Column:
    """The canonical text on one line."""
    return F.btrim(F.regexp_replace(canon, "[ \n]+", " "))


def listed_texts(texts: dict[str, tuple[str, ...]] = KNOWN) -> list[tuple[str, str]]:
    """(license, text) of the known texts, full ones also under their titles."""
    plain = [(name, text) for name, several in texts.items() for text in several]
    titled = [
        (name, f"{title}\n{text}")
        for name, text in plain
        if len(text) > FULL
        for title in TITLES.get(name, ())
    ]
    return plain + titled


def known(spark: SparkSession, texts: dict[str, tuple[str, ...]] = KNOWN) -> DataFrame:
    """(known_digest, license) of the known texts, each digest once."""
    rows = listed_texts(texts)
    listed = spark.createDataFrame(rows, "license string, text string")
    digest = F.md5(whole(canonical(F.col("text"))))
    return listed.groupBy(digest.alias("known_digest")).agg(F.min("license").alias("license"))


def scan(
    docs: DataFrame,
    text: str = "text",
    into: str = "licenses",
    texts: dict[str, tuple[str, ...]] = KNOWN,
) -> DataFrame:
    """Add a struct `into`: digest of the entire canonical text; license, that text's if it is
    known; notices, the licences of its known lines in order."""
    canon, digest, lines = (f"{into}__{name}" for name in ("canon", "digest", "lines"))
    if into in docs.columns:
        raise ValueError(f"there is a column {into!r} already")
    listed = known(docs.sparkSession, texts)
    # As many entries as the list has texts.
    by_digest = {row.known_digest: row.license for row in listed.collect()}
    look = F.create_map(*(F.lit(x) for entry in by_digest.items() for x in entry))
    made = docs.withColumn(canon, canonical(F.col(text)))
    made = made.withColumns(
        {
            digest: F.md5(whole(F.col(canon))),
            lines: F.transform(F.split(canon, "\n"), lambda line: F.md5(F.btrim(line))),
        }
    )
    table = listed.toDF(f"{into}__known", f"{into}__license")
    joined = made.join(F.broadcast(table), F.col(digest) == F.col(f"{into}__known"), "left")
    notices = F.filter(
        F.transform(lines, lambda line: F.element_at(look, line)), lambda name: name.isNotNull()
    )
    packed = F.struct(
        F.col(digest).alias("digest"), F.col(f"{into}__license").alias("license"), notices.alias("notices")
    )
    return joined.withColumn(into, packed).drop(
        canon, digest, lines, f"{into}__known", f"{into}__license"
    )
