"""Licence scan: every window of a text against licence notices by Dice coefficient over word pairs, in DataFrame operations only.

A text is normalised to its lower-case runs of letters and digits; its pairs are neighbouring words, at positions from 0. A
notice of m pairs, b of them different, is compared with every m pairs in a row of the whole text (behind its end the text is
thought to go on with other pairs, so a shorter text is one window). With n positions of the window that hold a pair of the
notice, c different ones, the coefficient is 2c / ((c + m - n) + b): repeated pairs of the notice count once, others each
time. A window matches from ``PERCENT`` / 100 on; so words before, behind or in between cost only their share of the window,
and line ends, comment marks and spelling of a header do not matter.

Size bounds prune notices: a match needs c >= PERCENT * b / (200 - PERCENT) different pairs, so a text with fewer
pairs, or fewer different pairs of the notice in a block, is not compared with it. For the same reason a match holds one of a few words
of each notice (``telling_words``); a text without any of them is not taken apart.

Of each notice a text has one best window (highest coefficient, then most pairs, then first). A notice whose best window overlaps
that of a notice with more shared pairs (then with a higher coefficient, then an earlier one in the list) is not counted: a GPL
header names one version. The notices are a list in this module, so they are broadcast whatever the corpus. Positions
are dealt into blocks that overlap by a window, so that a text of any length is compared in bounded groups.

Results for special rows: every row of the input gives one row and is scanned by itself, also where rows share a doc_id or
have none. A null text, one without words or without a match has a null license, dice and first_word, and n_notices 0.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.session import stored

PERCENT = 80  # least Dice coefficient
BLOCK = 8192  # positions in a block, at least the pairs of the longest notice

# Identifiers of the public list of licences.
IDENTIFIERS = [
    "MIT", "Apache-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-3.0-only",
    "AGPL-3.0-only", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense", "Zlib",
]

# Notices as their licences recommend them, and the usual short forms.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
]

# Whole licence texts, without title and copyright line.
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_REST = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_REST = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
NOTICES += [
    ("MIT", f"{_MIT_GRANT} {_MIT_REST}"),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TWO} {_BSD_REST}"),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_TWO} {_BSD_THIRD} {_BSD_REST}"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
]
NOTICES += [(name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS]


def _words(text: str) -> str:
    return rf"array_remove(split(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), '')"


def _pairs(words: str) -> str:
    """SQL for the word pairs of an array column, without a lambda that looks into the whole array."""
    return f"if(size({words}) < 2, array(), array_compact(zip_with({words}, slice({words}, 2, size({words})), (x, y) -> concat(x, ' ', y))))"


def least_shared(different: int) -> int:
    """Different pairs of a notice with ``different`` ones that every matching window holds."""
    return -(-PERCENT * different // (200 - PERCENT))


def telling_words() -> list[str]:
    """Words of which every match of any notice holds one: of each notice the longest, until the pairs without them are too few."""
    chosen = set()
    for _, text in NOTICES:
        words = re.findall(r"[^\W_]+", text.lower())
        pairs = set(zip(words, words[1:]))
        own = set()
        for word in sorted(set(words), key=lambda w: (-len(w), w)):
            if sum(not own & set(pair) for pair in pairs) < least_shared(len(pairs)):
                break
            own.add(word)
        chosen |= own
    return sorted(chosen)


def notices(spark: SparkSession) -> DataFrame:
    """notice (number), license, m (its pairs), b (its different pairs), least (those that a match holds) and pairs (different ones)."""
    rows = [F.struct(F.lit(k).alias("notice"), F.lit(name).alias("license"), F.lit(text).alias("text")) for k, (name, text) in enumerate(NOTICES)]
    return (
        spark.range(1).select(F.inline(F.array(*rows)))
        .selectExpr("notice", "license", f"{_words('text')} as words")
        .selectExpr("notice", "license", "size(words) - 1 as m", f"array_distinct({_pairs('words')}) as pairs")
        .selectExpr("notice", "license", "m", "size(pairs) as b", f"({PERCENT} * size(pairs) + {199 - PERCENT}) div {200 - PERCENT} as least", "pairs")
    )


def _hits(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, version (hash of the text), notice, block and hits (position, number of the pair) where a notice has enough different pairs."""
    telling = ", ".join(f"'{word}'" for word in telling_words())
    listed = F.broadcast(known.select("notice", "m", "least", F.posexplode("pairs").alias("number", "pair")))  # a list in this module
    placed = (
        docs.select("doc_id", "version", F.expr(_words("text")).alias("words"))
        # texts without a telling word leave with their array, not by a filter that would be computed before it
        .select("doc_id", "version", F.expr(f"if(arrays_overlap(words, array({telling})), {_pairs('words')}, array())").alias("pairs"))
        .select("doc_id", "version", F.size("pairs").alias("held"), F.posexplode("pairs").alias("position", "pair"))
        .join(listed, "pair")
        .where("held >= least")
    )
    # a window starts in one block and may end in the next
    blocks = f"if(position >= {BLOCK} and position % {BLOCK} < m - 1, array(position div {BLOCK}, position div {BLOCK} - 1), array(position div {BLOCK}))"
    grouped = (
        placed.select("doc_id", "version", "notice", "position", "number", F.explode(F.expr(blocks)).alias("block"))
        .groupBy("doc_id", "version", "notice", "block")
        .agg(F.collect_set(F.struct("position", "number")).alias("hits"))
    )
    sizes = F.broadcast(known.select("notice", "least"))
    return grouped.join(sizes, "notice").where("size(array_distinct(hits.number)) >= least").drop("least")


def _matches(hits: DataFrame, known: DataFrame) -> DataFrame:
    """The best matching window of each notice in each text: dice, c and start."""
    keys = ["doc_id", "version", "notice", "block"]
    earlier = "lag(position) over (partition by doc_id, version, notice, block, number order by position)"
    ordered = (
        hits.select(*keys, F.inline("hits"))
        .select(*keys, "position", F.expr(f"coalesce({earlier}, -1)").alias("earlier"))
        .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("position", "earlier"))).alias("hits"))
        .join(F.broadcast(known.select("notice", "m", "b")), "notice")
    )
    counted = """aggregate(slice(hits, i + 1, m), named_struct('c', 0, 'n', 0), (s, y) -> if(y.position >= x.position + m, s,
        named_struct('c', s.c + if(y.earlier < x.position, 1, 0), 'n', s.n + 1)))"""
    windows = f"transform(hits, (x, i) -> if(x.position div {BLOCK} = block, named_struct('start', x.position, 's', {counted}), null))"
    dice = "2.0D * w.s.c / (w.s.c + m - w.s.n + b)"
    return (
        ordered.select("doc_id", "version", "notice", "m", "b", F.expr(f"array_compact({windows})").alias("windows"))
        .select("doc_id", "version", "notice", F.expr(
            f"array_max(transform(filter(windows, w -> 200 * w.s.c >= {PERCENT} * (w.s.c + m - w.s.n + b)), "
            f"w -> named_struct('dice', {dice}, 'c', w.s.c, 'back', -w.start)))"
        ).alias("best"))
        .where("best is not null")
        .groupBy("doc_id", "version", "notice").agg(F.max("best").alias("best"))
        .select("doc_id", "version", "notice", "best.dice", "best.c", F.expr("-best.back").alias("start"))
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, license (the match with most pairs), dice, first_word (where it starts, from 0), n_notices and licenses (all names) per row."""
    known = stored(notices(docs.sparkSession), "notices")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
    matches = _matches(_hits(rows, known), known).join(F.broadcast(known.select("notice", "license", "m")), "notice")
    # at most one match per notice of the list
    ranked = matches.groupBy("doc_id", "version").agg(
        F.sort_array(F.collect_list(F.struct("c", "dice", (-F.col("notice")).alias("place"), "start", "m", "license")), asc=False).alias("found")
    )
    overlapped = "exists(slice(found, 1, i), y -> y.start < x.start + x.m and x.start < y.start + y.m)"
    best = ranked.select("doc_id", "version", F.element_at("found", 1).alias("best"), F.expr(f"filter(found, (x, i) -> not {overlapped})").alias("kept")).select(
        "doc_id", "version", "best.license", "best.dice", F.col("best.start").cast("bigint").alias("first_word"),
        F.size("kept").cast("bigint").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("kept.license")), ",").alias("licenses"),
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.version") == F.col("b.version"))
    joined = rows.drop("text").alias("d").join(stored(best, "licenses").alias("b"), same, "left")
    return joined.select(
        "d.doc_id", "license", "dice", "first_word", F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"), F.coalesce("licenses", F.lit("")).alias("licenses")
    )
