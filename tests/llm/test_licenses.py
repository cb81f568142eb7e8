"""License scans on notices as they stand in the wild, with hand-written expectations, and against brute force."""

import math
import re
from collections import Counter, defaultdict

import pytest
from marketloom.llm import licenses
from pyspark.sql import functions as F


def commented(text, mark=" * "):
    return "/*\n" + "\n".join(f"{mark}{line}".rstrip() for line in text.split("\n")) + "\n */\nint main(void) { return 0; }\n\nstatic int reserved = 2;\n"


DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT OWNER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD2 = """Copyright (c) 2011-2014, Some Body <some@body.org>
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
BSD3 = BSD2 + """3. Neither the name of the Example University nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
MIT = """Copyright 2019 Example Corp. All rights reserved.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
APACHE = """Copyright 2015 The Example Authors. All rights reserved.

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""


def gnu(kind, version, what):
    return f"""Copyright (C) 2001 Some One. All rights reserved.

This {what} is free software; you can redistribute it and/or
modify it under the terms of the GNU {kind}
License as published by the Free Software Foundation; either
version {version} of the License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
{kind} License for more details.
"""


NOTICES = {
    "BSD-3-Clause": [BSD3 + DISCLAIMER, "# " + "\n# ".join((BSD3 + DISCLAIMER).split("\n")) + "\nimport os\n"],
    "BSD-2-Clause": [BSD2 + DISCLAIMER, commented(BSD2 + DISCLAIMER)],
    "MIT": [MIT, commented(MIT), "// Use of this source code is governed by the rules below.\n// Released under the MIT License.\n"],
    "Apache-2.0": [APACHE, commented(APACHE), "Copyright 2020 X\n\nLicensed under the Apache License v2.0\n"],
    "GPL-2.0": [commented(gnu("General Public", "2", "program")), "GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.\n Everyone is permitted to copy and distribute verbatim copies\n"],
    "GPL-3.0": [commented(gnu("General Public", "3", "program")), "Licensed under the GNU General Public License v3\n"],
    "LGPL-2.1": [commented(gnu("Lesser General Public", "2.1", "library"), " ** ")],
    "LGPL-3.0": [gnu("Lesser General Public", "3", "library")],
    "AGPL-3.0": [gnu("Affero General Public", "3", "program")],
    "MPL-2.0": ["/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\nvar x = 1;\n"],
    "ISC": ["Copyright (c) 2004 by A B\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n"],
    "Zlib": ["This software is provided 'as-is', without any express or implied\nwarranty.  In no event will the authors be held liable for any damages\narising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not\n   claim that you wrote the original software. If you use this software\n   in a product, an acknowledgment in the product documentation would be\n   appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be\n   misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution.\n"],
    "BSL-1.0": ["//          Copyright Joe Coder 2004 - 2006.\n// Distributed under the Boost Software License, Version 1.0.\n//    (See accompanying file LICENSE_1_0.txt or copy at\n//          https://www.boost.org/LICENSE_1_0.txt)\n"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial or non-commercial, and by any\nmeans.\n"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.\n"],
    "LGPL-2.1-only": ["/* SPDX-License-Identifier: LGPL-2.1-only */\nint x;\n"],
    "LicenseRef-Own-1.2": ["# SPDX-License-Identifier: LicenseRef-Own-1.2\nx = 1\n"],
    "MIT OR Apache-2.0": ["// SPDX-License-Identifier: MIT OR Apache-2.0\n\n" + commented(APACHE)],
    "GPL-2.0 WITH Linux-syscall-note": ["/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */\n"],
    "Proprietary": ["Copyright 2020 Example Corp. All rights reserved.\n"],
    None: [
        "", "int main() { return 0; }\n", "We hold that all rights of the people were reserved for a later day, and no license was granted to anyone who came by.\n",
        "The software is free, and the public may modify it. Apache tribes lived here; version 2.0 of the story follows.\n", "Permission to enter was granted to the persons in the hall, and notice of it was given.\n",
        "This program is a free evening of music at the Foundation, published either in June or later.\n",
    ],
}


def test_real_notices(spark):
    rows = [(f"d{k}-{n}/f", text, name) for k, (name, texts) in enumerate(NOTICES.items()) for n, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "path string, text string, want string").withColumn("windows", F.lit("clash"))
    got = {r.path: (r.license, r.want) for r in licenses.scan(df).collect()}
    assert len(got) == len(rows) and {p: v for p, v in got.items() if v[0] != v[1]} == {}
    # among many files of prose, where license terms are rare, and among copies of the notices, where they are not
    prose = [(f"p{k}/x", f"some words {k} of the day and the night that nobody has read in a file of number {k % 7}", None) for k in range(300)]
    for more in (prose, [(f"{p}{n}", t, w) for p, t, w in rows for n in range(3)]):
        wide = spark.createDataFrame([*rows, *more], "path string, text string, want string")
        assert {(r.path, r.license, r.want) for r in licenses.scan(wide).where("not license <=> want").collect()} == set()


@pytest.mark.parametrize("which", ["real", "notices"])
def test_scores_match_brute_force(spark, request, which):
    if which == "real":
        df = request.getfixturevalue("real").withColumn("path", F.concat_ws("/", F.lit("d"), F.coalesce(F.col("doc_id").cast("string"), F.lit("LICENSE"))))
    else:
        texts = [t for ts in NOTICES.values() for t in ts] + [None, "x" * 30_000, " ".join(f"w{k}" for k in range(3000)) + " released under the MIT license"]
        df = spark.createDataFrame([(f"{k}/LICENSE" if k % 3 else f"{k}/a.c", t) for k, t in enumerate(texts)], "path string, text string")
    rows = [(r.path, r.text) for r in df.select("path", "text").collect()]
    terms = lambda t: re.findall(licenses.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), t))
    n, seen = 0, Counter()
    for _, t in rows:
        if t is not None:
            n += 1
            seen.update(set(terms(t)))
    w = licenses.Weights(n, seen)
    want, spdx = Counter(), re.compile(licenses.EXPRESSION)
    for path, t in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        units, paragraphs = ([x for x in (re.findall(licenses.TERM, u) for u in re.split(p, low)) if x] for p in (licenses.UNIT, licenses.PARAGRAPH))
        paragraphs = [p for p in paragraphs if len(p) <= licenses.MOST]
        bags = [sum(units[i : i + k], []) for k in (1, 2, 3) for i in range(len(units))]
        bags += [sum(paragraphs[i : i + k], []) for k in range(1, licenses.PARAGRAPHS + 1) for i in range(len(paragraphs)) if len(paragraphs) >= k]
        bags += [u[i : i + k] for u in units if len(u) > 2 * max(licenses.WINDOWS) for k in licenses.WINDOWS for i in range(0, len(u), k // 3)]
        bags += [sum(units, [])] * path.endswith("LICENSE")
        best = None
        for b in {tuple(b) for b in bags if 0 < len(b) <= licenses.MOST}:
            v = {x: c * w.idf.get(x, w.other) for x, c in Counter(b).items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            for name, must, u in w.templates:
                dot = sum(x * u.get(k, 0) for k, x in v.items())
                if round(dot / norm, 9) >= 0.6 and set(must) <= set(b):
                    best = max(x for x in (best, (name == "SPDX", name != "Proprietary", round(dot, 6), round(dot / norm, 6), name)) if x)
        name = best and (spdx.search(t)[1] if best[0] else best[4])
        want[(path, name, best and best[3])] += 1
    got = Counter((r.path, *((r.license, round(r.score, 6)) if r.origin == "header" else (None, None))) for r in licenses.scan(df).collect())
    near = lambda c: defaultdict(list, {k: sorted(v for (p, *v), n in c.items() for _ in range(n) if p == k) for k in {p for p, *_ in c}})
    got, want = near(got), near(want)
    assert got.keys() == want.keys()
    for path, found in got.items():
        assert [x[0] for x in found] == [x[0] for x in want[path]] and all(a[1] is b[1] or abs(a[1] - b[1]) < 2e-6 for a, b in zip(found, want[path]))
    assert sum(v[0][0] is not None for v in want.values()) > 3
