"""Operator 5: license scans by sparse TF-IDF cosine and nearest-ancestor inheritance (native)."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table, written

#: What licenses say of themselves in titles and headers, and the short licenses' own texts.
#: (license, terms that a text must have, text)
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_AS_IS = "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_ENDORSE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_APACHE = "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
_APACHE_END = "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_END = "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_GNU = "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
_GNU_ONLY = "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} version {version} as published by the Free Software Foundation."
_GNU_END = "This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details. You should have received a copy of the GNU {kind} along with this {what}. If not, see http://www.gnu.org/licenses/"
_ZLIB = "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
_BOOST = "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"
_UNLICENSE = "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
#: (license, version, what the header calls the work, the license's kind, its title's date)
_GNUS = (
    ("GPL-2.0", "2", "program", "General Public License", "June 1991"), ("GPL-3.0", "3", "program", "General Public License", "29 June 2007"), ("LGPL-2.1", "2.1", "library", "Lesser General Public License", "February 1999"),
    ("LGPL-3.0", "3", "library", "Lesser General Public License", "29 June 2007"), ("AGPL-3.0", "3", "program", "Affero General Public License", "19 November 2007"),
)
TEMPLATES = (
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "apache 2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "apache 2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "apache 2.0", _APACHE),
    ("Apache-2.0", "apache 2.0", f"{_APACHE} {_APACHE_END}"),
    ("MIT", "mit", "Released under the MIT License"),
    ("MIT", "mit", "Licensed under the MIT License"),
    ("MIT", "mit", "MIT License, Copyright (c)"),
    ("MIT", "", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "sublicense", _MIT),
    ("MIT", "sublicense", f"{_MIT} {_AS_IS}"),
    *((name, f"{version} {kind.split()[0].lower()}", text.format(what=what, kind=kind, version=version)) for name, version, what, kind, _ in _GNUS for text in (_GNU, _GNU_ONLY, f"{_GNU} {_GNU_END}", "Licensed under the GNU {kind}, version {version}", "Licensed under the GNU {kind} v{version}")),
    *((name, f"{version} {kind.split()[0].lower()}", f"GNU {kind} Version {version}, {date}") for name, version, _, kind, date in _GNUS),
    ("BSD-2-Clause", "", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-2-Clause", "disclaimer", _BSD),
    ("BSD-2-Clause", "disclaimer", f"{_BSD} {_BSD_END}"),
    ("BSD-3-Clause", "endorse", f"{_BSD} {_ENDORSE}"),
    ("BSD-3-Clause", "endorse", f"{_BSD} {_ENDORSE} {_BSD_END}"),
    ("BSD-3-Clause", "bsd 3", "Licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "bsd 2", "Licensed under the BSD 2-Clause License"),
    ("ISC", "permission notice", _ISC),
    ("ISC", "permission notice", f"{_ISC} {_ISC_END}"),
    ("0BSD", "fee", f"{_ISC.split(', provided')[0]}. {_ISC_END}"),
    ("Zlib", "misrepresented", _ZLIB),
    ("BSL-1.0", "boost", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("BSL-1.0", "boost", "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt"),
    ("BSL-1.0", "derivative", _BOOST),
    ("MPL-2.0", "mozilla 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "mozilla 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "mozilla 2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "eclipse 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("EPL-2.0", "eclipse 2.0", "Eclipse Public License - v 2.0"),
    ("CC0-1.0", "cc0", "CC0 1.0 Universal public domain dedication"),
    ("CC-BY-NC-4.0", "by nc 4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "by 4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "by sa 4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "attribution 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("Unlicense", "unencumbered", "This is free and unencumbered software released into the public domain"),
    ("Unlicense", "unencumbered", _UNLICENSE),
    # what stands in most other notices too: speaks only where nothing else does
    ("Proprietary", "reserved", "All rights reserved"),
    # the identifier itself is read from the line
    ("SPDX", "spdx identifier", "SPDX-License-Identifier:"),
)
#: An SPDX line's expression.
EXPRESSION = r"(?i:SPDX-License-Identifier):[\x20\t]*(\(?[A-Za-z0-9.+-]+\)?(?:[\x20\t]+(?:OR|AND|WITH)[\x20\t]+\(?[A-Za-z0-9.+-]+\)?)*)"
#: A term, the pattern's group: a word, or a number with its points. A version's v is left out.
TERM = r"(?:(?<![a-z0-9])v(?=[0-9]))?([a-z0-9]+(?:\.[0-9]+)*)"
#: Where a text falls into units: line ends and sentence ends.
UNIT = r"\r\n|\n|\r|(?<=[.!?;:])[\x20\t]+"
#: Where it falls into paragraphs: lines with nothing but signs (of comments, or rules) or nothing at all.
PARAGRAPH = r"(?:\r\n|\n|\r)[^a-z0-9\r\n]*(?:\r\n|\n|\r)"
#: A file with such a name is compared as a whole too.
NAMED = r"(?i)(^|/)(un)?(licen[sc]e|copying|notice)([._-][^/]*)?$"
#: Lengths in terms of the windows that a unit too long to be a header is cut into; paragraphs in a row that are compared together; terms beyond which no window is a header.
WINDOWS, PARAGRAPHS, MOST = (6, 12, 24), 8, 1000


def bags() -> list[tuple[str, list[str], list[str]]]:
    """(license, terms that a text must have, terms) of each template."""
    return [(name, must.split(), re.findall(TERM, text.lower())) for name, must, text in TEMPLATES]


class Weights:
    """Terms' idf over the files and the templates' normalised vectors. A term of no template weighs as the templates' median term.

    A text's cosine with a template is at most the length of the template's vector over the terms that the text has. For
    that bound terms in more than one of eight files count as there: common, by template, holds the squared length over these, rare the squares of the others.
    """

    def __init__(self, n: int, seen: dict[str, int]):
        own = bags()
        self.idf = {t: math.log((1 + n) / (1 + seen.get(t, 0))) + 1 for _, _, b in own for t in b}
        self.other = sorted(self.idf.values())[len(self.idf) // 2]
        self.templates, self.common, self.rare = [], [], []
        for name, must, b in own:
            v = {t: b.count(t) * self.idf[t] for t in sorted(set(b))}
            norm = math.sqrt(sum(x * x for x in v.values()))
            v = {t: x / norm for t, x in v.items()}
            self.templates.append((name, must, v))
            self.rare.append({t: x * x for t, x in v.items() if 8 * seen.get(t, 0) <= n})
            self.common.append(max(0.0, 1 - sum(self.rare[-1].values())) + 1e-9)


def weigh(files: DataFrame) -> Weights:
    """Counts in how many files each template term is: one pass, of which at most the templates' terms reach the driver."""
    vocabulary = sorted({t for _, _, b in bags() for t in b})
    terms = F.array_intersect(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(1)), F.array(*map(F.lit, vocabulary)))
    seen = files.where("text is not null").select(F.explode(F.concat(F.array(F.lit("")), terms)).alias("t")).groupBy("t").count()
    counts = {r.t: r["count"] for r in seen.collect()}
    return Weights(counts.pop("", 0), counts)


def windows(path: str, weights: Weights, least: float) -> Column:
    """The term lists of a text that can reach `least` by what they share with a template: one expression over `text` and path.

    First the whole text's, then each window's rare template terms are held against the bound of Weights.
    """

    def quoted(pattern):
        return "'" + pattern.replace("\\", "\\\\") + "'"

    def let(name, value, body):
        return f"transform(array({value}), {name} -> {body})[0]"

    def vector(v):
        return "map(" + ", ".join(f"'{t}', {x!r}D" for t, x in v.items()) + ")" if v else "cast(map() as map<string, double>)"

    bounds = "array(" + ", ".join(f"named_struct('low', {c!r}D, 'squares', {vector(r)})" for c, r in zip(weights.common, weights.rare)) + ")"
    rare = "array(" + ", ".join(f"'{t}'" for t in sorted({t for r in weights.rare for t in r})) + ")"
    always = str(max(weights.common) >= least**2).lower()

    def may(terms):
        reach = f"exists(bounds, b -> aggregate(here, b.low, (s, x) -> s + coalesce(b.squares[x], 0D)) >= {least**2!r}D)"
        return let("here", f"array_intersect({terms}, rare)", f"({always} or size(here) > 0) and {reach}")

    def in_a_row(parts, k):
        return f"transform(sequence(0, size({parts}) - 1), i -> flatten(slice({parts}, i + 1, {k})))"

    def terms(parts, pattern):
        return f"filter(transform(split({parts}, {quoted(pattern)}), x -> regexp_extract_all(x, {quoted(TERM)}, 1)), x -> size(x) > 0)"

    long_ = 2 * max(WINDOWS)
    cut = [f"flatten(transform(filter(u, x -> size(x) > {long_}), x -> transform(sequence(0, size(x) - 1, {k // 3}), i -> slice(x, i + 1, {k}))))" for k in WINDOWS]
    whole = f"if({path} is not null and regexp_like({path}, {quoted(NAMED)}), array(flatten(u)), array())"
    every = [in_a_row("u", k) for k in (1, 2, 3)] + [f"if(size(p) >= {k}, {in_a_row('p', k)}, array())" for k in range(1, PARAGRAPHS + 1)]
    found = f"array_distinct(filter(concat({', '.join(every + cut + [whole])}), x -> size(x) > 0 and size(x) <= {MOST} and {may('x')}))"
    paragraphs = f"filter({terms('low', PARAGRAPH)}, x -> size(x) <= {MOST})"
    body = let("u", terms("low", UNIT), f"if(size(u) > 0, {let('p', paragraphs, found)}, null)")
    # most texts are ruled out by their terms alone, before they are cut up
    body = f"if({may(f'regexp_extract_all(low, {quoted(TERM)}, 1)')}, {body}, null)"
    body = let("bounds", bounds, let("rare", rare, body))
    return F.expr(let("low", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')", body))


def own_licenses(rows: DataFrame, weights: Weights, least: float) -> DataFrame:
    """Licenses of rows (id, windows): id, own struct(score, license).

    Windows' terms meet the templates' in a join by term, and sums by (row, window, template) give the dot products. The
    templates' terms are some thousands whatever the files: they are broadcast.
    """
    spark = rows.sparkSession
    vocabulary = spark.createDataFrame([(t, x) for t, x in sorted(weights.idf.items())], "term string, idf double")
    known = spark.createDataFrame([(t, k, x, int(t in must)) for k, (_, must, v) in enumerate(weights.templates) for t, x in sorted(v.items())], "term string, template int, x double, own int")
    named = spark.createDataFrame([(k, name, len(must)) for k, (name, must, _) in enumerate(weights.templates)], "template int, license string, must int")
    each = rows.where("windows is not null").select("id", F.posexplode("windows").alias("window", "terms"))
    counts = each.select("id", "window", F.explode("terms").alias("term")).groupBy("id", "window", "term").agg(F.count("*").alias("n"))
    weighed = counts.join(F.broadcast(vocabulary), "term", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(weights.other)))
    norms = weighed.groupBy("id", "window").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.where("idf is not null").join(F.broadcast(known), "term").groupBy("id", "window", "template").agg(F.sum(F.col("w") * F.col("x")).alias("dot"), F.sum("own").alias("own"))
    met = dots.join(norms, ["id", "window"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= least)
    met = met.join(F.broadcast(named), "template").where("own = must")
    # SPDX first, all rights reserved last; then what covers most of its text: the window's length along the template
    rank = F.struct((F.col("license") == "SPDX").alias("spdx"), (F.col("license") != "Proprietary").alias("named"), F.round("dot", 6).alias("covers"), "score", "license")
    return met.groupBy("id").agg(F.max(rank).alias("best")).select("id", F.struct("best.score", "best.license").alias("own"))


def scan(files: DataFrame, least: float = 0.6) -> DataFrame:
    """Finds files' (path, text) licenses: path, license, score, origin, inherited_from, and files' other columns but text.

    A text's units are its lines and sentences, its paragraphs end at blank lines or such of comment signs alone. Compared
    with the templates, by cosine over terms weighted by their idf over all the files, are one to three units in a row,
    one to PARAGRAPHS paragraphs in a row, windows of units too long to be a header, and whole files with the name of a license file, all of at most
    MOST terms. Of what reaches `least` and has the template's own terms (its version, say) that which covers most of its text wins;
    an SPDX line goes before it and gives its expression as it is written, "All rights reserved" after it. What can't reach `least`
    by its template terms (see Weights) is not compared. A directory's license is that of its license files, or of its other files, with the best
    score, ties to the smallest path; a file without one inherits from
    the nearest directory above it that has one, up to the root, ''. origin: header, directory or none. Null or empty texts
    have no header; null paths inherit nothing; rows alike are each a row of their own; an empty table gives none. Columns named like the results are left out.
    """
    weights = weigh(files)
    kept = [c for c in files.columns if c not in ("text", "path", "license", "score", "origin", "inherited_from", "own", "above", "dir", "given", "id", "windows", "spdx")]
    # the texts are compared once; what follows reads paths and windows
    spdx = F.nullif(F.regexp_extract("text", EXPRESSION, 1), F.lit(""))
    rows = written(files.select(*kept, "path", F.monotonically_increasing_id().alias("id"), windows("path", weights, least).alias("windows"), spdx.alias("spdx")), "windows")
    own = own_licenses(rows.select("id", "windows"), weights, least)
    told = F.when((F.col("own.license") != "SPDX") | F.col("spdx").isNotNull(), F.struct("own.score", F.when(F.col("own.license") == "SPDX", F.col("spdx")).otherwise(F.col("own.license")).alias("license")))
    return inherit(written(rows.drop("windows").join(own, "id", "left").select(*kept, "path", told.alias("own")), "own"))


def inherit(rows: DataFrame) -> DataFrame:
    """Licenses of rows (path, own): own ones, or those of the nearest directory above."""
    kept = [c for c in rows.columns if c not in ("path", "own")]
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    rows = rows.withColumn("above", F.when(F.col("path").isNotNull(), above))
    parent = F.element_at("above", -1)
    first = F.struct(~F.regexp_like("path", F.lit(NAMED)), -F.col("own.score"), "path", "own.license")
    dirs = rows.where("own is not null and above is not null").groupBy(parent.alias("from")).agg(F.min_by("own", first).alias("own"))
    # a directory asks itself and the directories above it, one row a directory
    asked = rows.where("above is not null").select("above").distinct().select(F.element_at("above", -1).alias("dir"), F.posexplode("above").alias("depth", "from"))
    nearest = asked.join(dirs, "from").groupBy("dir").agg(F.max(F.struct("depth", "from", "own")).alias("given"))
    out = rows.withColumn("dir", parent).join(nearest, "dir", "left")
    own = F.col("own").isNotNull()
    return out.select(
        *kept, "path",
        F.when(own, F.col("own.license")).otherwise(F.col("given.own.license")).alias("license"),
        F.when(own, F.col("own.score")).otherwise(F.col("given.own.score")).alias("score"),
        F.when(own, "header").when(F.col("given").isNotNull(), "directory").otherwise("none").alias("origin"),
        F.when(~own, F.col("given.from")).alias("inherited_from"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: each hundred of a source is a directory, whose first files stand one level higher."""
    docs = table(spark, sf_dir, "documents")
    hundred = F.when(F.col("doc_id") % 100 >= 20, F.floor(F.col("doc_id") / 100).cast("string"))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 1000).cast("string"), hundred, F.col("doc_id").cast("string"))
    return scan(docs.select("doc_id", path.alias("path"), "text")).withColumn("score", F.round("score", 6))
