"""License scans by an exact set-similarity join, in DataFrame operations only.

A template of L words is looked for in blocks of 2 L consecutive words that start at every L-th word, so a notice of its
length is whole in one of them, however its lines are wrapped. A block holds the template if at least ``share`` of the
template's distinct words are in it.

The join has two steps. Words are ordered by how many texts of the whole corpus hold them, rarest first, and the sets of
template words of whole texts are joined with the templates: one of the template's first words (its prefix) must be
there, the text must have enough template words, and the words after the first common one must suffice on both sides
(prefix, length and position filters). A block's set is part of its text's set, so no block is lost. Only texts that
hold a template's words at all are divided into blocks, and the blocks' common words are counted in full.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civigrid.llm.common import by_key, digest, small, written
from civigrid.llm.urlfilter import LOWER, UPPER

#: Template containment from which a block counts.
SHARE = 0.8
# Notices and licenses by the label that they stand for, as their authors publish them.
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-2-clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-3-clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "boost-1.0-text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program.""",
    "gpl-3.0": "Licensed under the GNU General Public License, version 3",
    "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "agpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "epl-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gfdl-notice": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts.",
    "all-rights-reserved": "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means, including photocopying, recording, or other electronic or mechanical methods, without the prior written permission of the publisher",
}
PHRASES = {"apache": ("apache", "license"), "gpl": ("general", "public", "license"), "mit": ("mit", "license")}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def words_of(text: str) -> list[str]:
    """A template's words, as those of documents are taken."""
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def needed(n: int, share: float) -> int:
    """Words of a template of ``n`` distinct ones that a block must have."""
    return max(1, math.ceil(n * share - 1e-9))


def local(spark: SparkSession, rows: list[tuple], **kinds: pa.DataType) -> DataFrame:
    """A small table from the driver, as a local relation: unlike a list's, no Python worker is started for it."""
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return spark.createDataFrame(pa.table({k: pa.array(c, t) for (k, t), c in zip(kinds.items(), columns, strict=True)}))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, share: float = SHARE) -> DataFrame:
    """For each document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base: places where the words of a phrase follow each other. ``labels`` has the base labels and those of templates
    contained in a block of words. ``score`` is 1 with a base place, else the largest containment found, else 0. A null
    text counts as empty (0 words, null places, empty labels). Equal texts have equal results; of equal containments all
    labels stand. A very long text is read to the end, in time proportional to its length. Repeated rows give repeated
    rows, an empty table none; templates without a word are left out; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = {name: w for name, text in (TEMPLATES if templates is None else templates).items() if (w := words_of(text))}
    vocabulary = sorted({x for w in texts.values() for x in w})
    low = lowered(F.coalesce(F.col("text").cast("string"), F.lit("")))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), low.alias("text")).withColumn("words", words(F.col("text")))

    def at(i: Column, word: str) -> Column:
        return F.get(F.col("words"), i) == word

    ends = F.filter(F.when(F.contains("text", F.lit("license")), F.sequence(F.lit(0), F.size("words"))).otherwise(F.array().cast("array<int>")), lambda i: at(i, "license"))

    def starts_of(ws: tuple[str, ...]) -> Column:
        return F.transform(F.filter("ends", lambda i: _before(i, ws, at)), lambda i: i - (len(ws) - 1))

    places = {label: starts_of(ws) for label, ws in PHRASES.items()}
    own = F.array_intersect("words", F.array(*map(F.lit, vocabulary)).cast("array<string>"))
    rows = given.withColumn("ends", ends).select("doc_id", F.size("words").alias("n_words"), *(p.alias(label) for label, p in places.items()), own.alias("own"), digest(F.col("text")).alias("key"))
    rows = written(rows, "licenses")
    starts = F.array_sort(F.concat(*PHRASES))
    base = F.filter(F.array(*(F.when(F.size(label) > 0, F.lit(label)) for label in sorted(PHRASES))), lambda x: x.isNotNull())
    likely = candidates(rows.select("key", "own").dropDuplicates(["key"]), {name: sorted(set(w)) for name, w in texts.items()}, share)
    found = written(blocks(spark, docs.select(low.alias("text")), likely, texts, share), "licenses-found")
    out = by_key(rows.drop("own"), found, "key", how="left", spread_by="doc_id")
    n_base = F.size(starts)
    labels = F.array_sort(F.array_distinct(F.concat(base, F.coalesce("found", F.array().cast("array<string>")))))
    return out.select("doc_id", F.col("n_words").cast("long").alias("n_words"), n_base.cast("long").alias("n_base"), F.get(starts, F.lit(0)).cast("long").alias("first_word"), F.when(n_base > 0, F.get(starts, n_base - 1)).cast("long").alias("last_word"), F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce("contained", F.lit(0.0))).alias("score"))


def _before(i: Column, ws: tuple[str, ...], at) -> Column:
    """Whether the words before place ``i`` are those of a phrase but its last."""
    out = i >= len(ws) - 1
    for k, w in enumerate(reversed(ws[:-1]), 1):
        out = out & (i >= k) & F.coalesce(at(F.greatest(i - k, F.lit(0)), w), F.lit(False))
    return out


def candidates(texts: DataFrame, sets: dict[str, list[str]], share: float) -> DataFrame:
    """key and names, the templates of whose words the text (key, own: its template words) has the share: the join's first step."""
    spark = texts.sparkSession
    # The order over the templates' words: by the texts that hold them, then by the word. At most a row for each such word.
    counts = {r.token: r.n for r in texts.select(F.explode("own").alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()}
    order = {w: k for k, w in enumerate(sorted({w for s in sets.values() for w in s}, key=lambda w: (counts.get(w, 0), w)))}
    index, whole, first = [], [], set()
    for name, s in sets.items():
        ranked, need = sorted(s, key=order.__getitem__), needed(len(s), share)
        first.update(ranked[: len(ranked) - need + 1])
        whole.append((name, ranked))
        index += [(order[w], name, place, len(ranked), need) for place, w in enumerate(ranked[: len(ranked) - need + 1])]
    # These tables have the templates' words, whatever the corpus.
    text, number = pa.string(), pa.int32()
    ranks = F.broadcast(local(spark, list(order.items()), word=text, rank=number))
    prefixes = F.broadcast(local(spark, index, rank=number, name=text, place=number, size=number, need=number))
    full = F.broadcast(local(spark, whole, name=text, template=pa.list_(text)))
    least = min((needed(len(s), share) for s in sets.values()), default=1)
    some = texts.where((F.size("own") >= least) & F.arrays_overlap("own", F.array(*map(F.lit, sorted(first))).cast("array<string>")))
    ranked = some.select("key", "own", F.explode("own").alias("word")).join(ranks, "word").groupBy("key").agg(F.first("own").alias("own"), F.sort_array(F.collect_list("rank")).alias("ranks"))
    probed = ranked.select("key", "own", F.posexplode("ranks").alias("at", "rank")).join(prefixes, "rank")
    left = F.least(F.col("size") - F.col("place"), F.size("own") - F.col("at"))
    # The first common word settles it: it has the most words after it on both sides, so position filtering loses nothing.
    near = probed.where((F.size("own") >= F.col("need")) & (left >= F.col("need"))).select("key", "own", "name", "need").distinct().join(full, "name")
    return near.where(F.size(F.array_intersect("own", "template")) >= F.col("need")).groupBy("key").agg(F.collect_set("name").alias("names"))


def blocks(spark: SparkSession, docs: DataFrame, likely: DataFrame, texts: dict[str, list[str]], share: float) -> DataFrame:
    """For texts with a block that holds a template: key, found (the templates' names) and contained (the largest share)."""
    parts = [(x, name, len(w), len(set(w)), needed(len(set(w)), share)) for name, w in texts.items() for x in sorted(set(w))]
    text, number = pa.string(), pa.int32()
    table = F.broadcast(local(spark, parts, word=text, name=text, length=number, size=number, need=number))  # as many rows as the templates have words
    likely = small(written(likely, "licenses-likely"))
    spread = docs.withColumn("key", digest(F.col("text"))).join(likely, "key").select("key", "names", F.posexplode(words(F.col("text"))).alias("at", "word"))
    hits = spread.join(table, "word").where(F.array_contains("names", F.col("name")))
    nth = F.floor(F.col("at") / F.col("length")).cast("int")
    placed = hits.select("key", "name", "size", "need", "word", F.explode(F.when(nth == 0, F.array(nth)).otherwise(F.array(nth, nth - 1))).alias("block")).distinct()
    common = placed.groupBy("key", "name", "size", "need", "block").agg(F.count("*").alias("common")).where("common >= need")
    return common.groupBy("key").agg(F.sort_array(F.collect_set("name")).alias("found"), F.max(F.col("common") / F.col("size")).alias("contained"))
