"""License scan: MinHash bands over overlapping windows, then exact containment.

A text's words make shingles of SHINGLE words.  Its windows are, for short
templates, single shingles, and for long ones WIDE shingles that overlap by
half.  A window's signature is one minimum per hash function; every minimum is a
band.  Templates are cut into windows at every shingle, so a window inside a
copied template equals a template window, whatever its place: all bands agree.
With a Jaccard similarity of j between two windows, at least one of HASHES bands
agrees with probability 1 - (1 - j) ** HASHES: 0.9987 at 2/3, which is what 80 %
of shared shingles leave; a single shingle agrees for certain.

Each window that agrees with a template in a band is verified: the share of the
template's distinct shingles that occur around the window.  MIN_CONTAINMENT of
them is a match, if the shingles that tell the license from its like are there
too: where a template shares so many shingles with one of another license that
both could match one place (two versions of a notice), at least half of those
that it does not share must occur.  All of it is DataFrame functions without a
shuffle, up to the best match of a document and license.

An SPDX line whose identifier is one word (MIT) is shorter than a shingle and
not found.

Special rows.  A text that is NULL or has fewer than SHINGLE words matches
nothing.  Rows with one doc_id count as one document, NULL included.  Other
columns play no part.
"""

from __future__ import annotations

import random
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
MIN_CONTAINMENT = 0.8
WIDE, STEP, HASHES = 16, 8, 6
_PRIME = 2147483647

#: Licenses with the names that short notices use.
NAMES = (
    ("MIT", "MIT License"),
    ("ISC", "ISC License"),
    ("Zlib", "zlib License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("MPL-2.0", "Mozilla Public License, Version 2.0"),
    ("BSL-1.0", "Boost Software License, Version 1.0"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
)
#: How a short notice names a license.
FORMS = ("Licensed under the {}", "Released under the {}", "Distributed under the {}", "under the terms of the {}")
#: Creative Commons kinds, and the word that follows a version.
COMMONS = (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
COMMONS_VERSIONS = (("3.0", "Unported"), ("4.0", "International"))
#: GNU licenses with what their notice calls the work and the version.
GNU = (
    ("GPL-2.0", "program", "GNU General Public License", "2"),
    ("GPL-3.0", "program", "GNU General Public License", "3"),
    ("LGPL-2.1", "library", "GNU Lesser General Public License", "2.1"),
    ("LGPL-3.0", "library", "GNU Lesser General Public License", "3"),
    ("AGPL-3.0", "program", "GNU Affero General Public License", "3"),
)
#: Fixed value: the notice of the GNU licenses.
GNU_NOTICE = (
    "This {work} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by "
    "the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This "
    "{work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
)
#: Texts and notices as published.
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
MIT_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEXTS = (
    ("MIT", MIT_GRANT),
    ("MIT", f"{MIT_GRANT} {MIT_DISCLAIMER}"),
    ("BSD-2-Clause", f"{BSD_CONDITIONS} {BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{BSD_CONDITIONS} {BSD_THIRD} {BSD_DISCLAIMER}"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would "
        "be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. This notice may not be removed or altered from any source "
        "distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following:",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
)


def known_templates() -> tuple[tuple[str, str], ...]:
    """(license, text) of all templates: whole texts, notices, short forms and SPDX lines."""
    out = [*TEXTS, *((i, GNU_NOTICE.format(work=w, name=n, version=v)) for i, w, n, v in GNU)]
    out += [(i, form.format(name)) for i, name in NAMES for form in FORMS]
    named = [i for i, _ in NAMES]
    for version, scope in COMMONS_VERSIONS:
        for kind, long in COMMONS:
            short = f"CC {kind} {version}"
            named.append(f"CC-{kind}-{version}")
            out += [(named[-1], f"{verb} under {short}") for verb in ("Licensed", "Released", "Distributed")]
            out.append((named[-1], f"licensed under a Creative Commons {long} {version} {scope} License"))
    lines = [(i, f"SPDX-License-Identifier: {i}") for i in named]
    # an identifier of one word makes a line that is shorter than a shingle
    return (*out, *(line for line in lines if len(re.split(r"[^A-Za-z0-9]+", line[1])) >= SHINGLE))


TEMPLATES = known_templates()


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` made once per row, however often the body's functions use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column) -> Column:
    """Hashes of a text's shingles of words (letters and digits, in lower case)."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def hashed(w: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])
        )
        return F.when(F.size(w) >= SHINGLE, each).otherwise(F.array().cast("array<bigint>"))

    return _let(words, hashed)


def _functions(seed: int = 42) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    return [(rng.randrange(1, _PRIME), rng.randrange(_PRIME)) for _ in range(HASHES)]


def _telling(own: set[int], rivals: list[set[int]]) -> list[list[int]]:
    """Per rival that could match where ``own`` does, the shingles that are not the rival's."""
    near = [own - other for other in rivals if len(own & other) > (2 * MIN_CONTAINMENT - 1) * len(own)]
    return sorted({tuple(sorted(apart)) for apart in near if apart})


def templates(spark: SparkSession, texts=TEMPLATES) -> list[dict]:
    """Each template's license, distinct shingles, those that tell it apart, and keys per band (band -1: single shingles)."""
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "template int, text string")
    found = {r.template: r.s for r in frame.select("template", shingle_hashes(F.col("text")).alias("s")).collect()}
    out = []
    for i, (name, _) in enumerate(texts):
        shingles = found[i]
        if not shingles:
            raise ValueError(f"template {i} of {name} has fewer than {SHINGLE} words")
        if len(shingles) < WIDE:
            keys = {-1: set(shingles)}
        else:
            windows = [shingles[p : p + WIDE] for p in range(len(shingles) - WIDE + 1)]
            keys = {k: {min((s % _PRIME * a + b) % _PRIME for s in w) for w in windows} for k, (a, b) in enumerate(_functions())}
        rivals = [set(found[k]) for k, (other, _) in enumerate(texts) if other != name]
        known = {"template": i, "license": name, "shingles": sorted(set(shingles)), "size": len(shingles), "keys": keys}
        out.append(known | {"telling": [list(t) for t in _telling(set(shingles), rivals)]})
    return out


def _hit(band: int, key: Column, pos: Column) -> Column:
    return F.struct(F.lit(band).alias("band"), key.alias("key"), pos.alias("pos"))


def _agreeing(band: int, shingles: Column, keys: list[int]) -> Column:
    """Hits of wide windows whose minimum under the band's hash function is one of ``keys``."""
    a, b = _functions()[band]
    starts = F.sequence(F.lit(0), F.greatest(F.size(shingles) - WIDE, F.lit(0)) + STEP - 1, F.lit(STEP))

    def hits(mixed: Column) -> Column:
        least = F.transform(starts, lambda p: _hit(band, F.array_min(F.slice(mixed, p + 1, F.lit(WIDE))), p))
        return F.filter(least, lambda x: x["key"].isin(*keys))

    return _let(F.transform(shingles, lambda s: F.pmod(F.pmod(s, F.lit(_PRIME)) * a + b, F.lit(_PRIME))), hits)


def _candidates(known: list[dict], shingles: Column) -> Column:
    """Array of (band, key, pos) where a window agrees with some template."""
    keys: dict[int, set[int]] = {}
    for t in known:
        for band, own in t["keys"].items():
            keys[band] = keys.get(band, set()) | own
    found = []
    if -1 in keys:
        at = F.filter(F.sequence(F.lit(0), F.size(shingles) - 1), lambda i: F.get(shingles, i).isin(*sorted(keys[-1])))
        found.append(F.transform(at, lambda i: _hit(-1, F.get(shingles, i), i)))
    found += [_agreeing(band, shingles, sorted(keys[band])) for band in sorted(keys) if band >= 0]
    return F.when(F.size(shingles) > 0, F.concat(*found))


def scan(docs: DataFrame, texts=TEMPLATES, min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """(doc_id, license, containment, first_word, n_matches) for every license found in ``docs`` (doc_id, text).

    ``containment`` is the best over the license's templates, ``first_word`` the
    first word of the first window that matches, ``n_matches`` the windows.
    """
    known = templates(docs.sparkSession, texts)
    scanned = docs.select(
        "doc_id", _let(shingle_hashes(F.col("text")), lambda s: F.struct(s.alias("s"), _candidates(known, s).alias("c"))).alias("_x")
    )
    # both tables are as large as the templates are, whatever the documents
    keys = [(t["template"], band, key) for t in known for band, own in t["keys"].items() for key in own]
    keys = docs.sparkSession.createDataFrame(keys, "template int, band int, key bigint")
    about = [(t["template"], t["license"], t["shingles"], t["size"], t["telling"]) for t in known]
    about = docs.sparkSession.createDataFrame(
        about, "template int, license string, _shingles array<bigint>, _size int, _telling array<array<bigint>>"
    )
    met = scanned.select("doc_id", F.col("_x.s").alias("_s"), F.explode("_x.c").alias("c"))
    met = met.select("doc_id", "_s", "c.band", "c.key", "c.pos")
    met = met.join(F.broadcast(keys), ["band", "key"]).join(F.broadcast(about), "template")
    first = F.greatest(F.col("pos") - F.col("_size"), F.lit(0))
    met = met.withColumn("_around", F.slice("_s", first + 1, 2 * F.col("_size") + WIDE))
    share = F.size(F.array_intersect("_shingles", "_around")) / F.size("_shingles")
    told = F.forall("_telling", lambda t: 2 * F.size(F.array_intersect(t, "_around")) >= F.size(t))
    sure = met.withColumn("containment", share).where((F.col("containment") >= min_containment) & told)
    return sure.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.min("pos").cast("long").alias("first_word"), F.count_distinct("pos").alias("n_matches")
    )
