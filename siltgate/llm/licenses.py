"""Licence scan: TF-IDF cosine of notices and licence files to templates, then inheritance.

Built from DataFrame functions only.  ``files`` has a ``path`` and a ``text``.

* Templates: short notices, ``SPDX-License-Identifier`` lines for the names in ``SPDX``, and
  whole licence texts.  Each notice has one telling word, its anchor.
* Windows: wherever an anchor stands in a text, the words around it are cut out as they
  stand around the anchor of each notice that has it, and compared with that notice.  So a
  notice is found inside a longer line, over line breaks, and with some words changed.
  Each text with an anchor is also compared as a whole with all templates.
* Cosine: term counts times ``ln((1 + T) / (1 + df)) + 1`` over the ``T`` templates, the
  window's length in the vector counting words that no template has.  A window at
  ``header_min`` or above gives its file a licence; a whole text at ``file_min`` or above
  makes the file the licence file of its directory.  The highest cosine wins, then the
  licence name; of several licence files in one directory the highest cosine, then the
  name, then the path.
* A file without a licence of its own takes that of the nearest directory at or above its
  own with a licence file.  Directories are resolved once each, and joined back to their
  files by salted keys where one has a million files or more.

Paths are cut at ``/``; empty parts are dropped.  NULL paths count as the root, NULL and
empty texts have no words.  Repeated paths are files of their own if their texts differ
and get equal answers if not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import ascii_lower
from siltgate.operators.skew import hot_routes, salted_join

#: Short forms of public licence notices, by SPDX name.
NOTICES = (
    ("AGPL-3.0", "GNU Affero General Public License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose"),
    ("LGPL-3.0", "GNU Lesser General Public License"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "All rights reserved"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
#: Names that an SPDX line may give.
SPDX = (
    "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "GPL-2.0", "GPL-3.0",
    "ISC", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense",
)
#: Whole public licence texts, without titles and copyright lines.
TEXTS = (
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    ),
    (
        "BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright
        holder nor the names of its contributors may be used to endorse or promote products derived from this
        software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
        CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
        the GNU General Public License for more details.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    ),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
)
#: Telling words, the most telling first: the first that a notice has is its anchor.
ANCHORS = (
    "spdx", "redistribution", "permission", "reserved", "unencumbered", "commons", "mozilla", "apache", "gnu", "bsd",
    "licensed", "license",
)
TEMPLATES = (*NOTICES, *((n, f"SPDX-License-Identifier: {n}") for n in SPDX), *TEXTS)
#: Templates that are compared with windows: all but the whole texts.
N_NOTICES = len(NOTICES) + len(SPDX)
HEADER_MIN = 0.8
FILE_MIN = 0.5


def terms(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), "[^a-z0-9]+"), lambda w: w != "")


def template_words(text: str) -> list[str]:
    """The same words of a template, for what is fixed before any job."""
    kept = [c if c.isascii() and c.isalnum() else " " for c in text.lower()]
    return "".join(kept).split()


def anchored_notices() -> list[tuple[int, str, str, int, int]]:
    """``template, license, anchor, before, n``: words before the anchor, words in all."""
    out = []
    for k, (name, text) in enumerate(TEMPLATES[:N_NOTICES]):
        words = template_words(text)
        anchor = next(a for a in ANCHORS if a in words)
        out.append((k, name, anchor, words.index(anchor), len(words)))
    return out


def template_vectors(files: DataFrame) -> DataFrame:
    """``license, template, word, weight, idf``: unit vectors, some thousand fixed rows."""
    spark = files.sparkSession
    rows = spark.createDataFrame(
        [(k, name, text) for k, (name, text) in enumerate(TEMPLATES)],
        "template int, license string, text string",
    )
    counted = (
        rows.select("template", "license", F.explode(terms(F.col("text"))).alias("word"))
        .groupBy("template", "license", "word")
        .agg(F.count("*").alias("tf"))
    )
    idf = counted.groupBy("word").agg(
        F.expr(f"ln({1.0 + len(TEMPLATES)}D / (1 + count(*))) + 1").alias("idf")
    )
    weighed = counted.join(idf, "word").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weighed.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighed.join(norms, "template").selectExpr(
        "license", "template", "word", "w / norm AS weight", "idf"
    )


def windows(marked: DataFrame) -> DataFrame:
    """``path, text_hash, at, template, words``: the words of texts (w) where a notice may be."""
    notices = anchored_notices()
    reach = max(n for *_, n in notices)
    spark = marked.sparkSession
    known = spark.createDataFrame(notices, "template int, license string, anchor string, before int, n int")
    named = ", ".join(f"'{a}'" for a in ANCHORS)
    around = f"""transform(filter(sequence(0, size(w) - 1), i -> w[i] IN ({named})), i -> struct(
        w[i] AS anchor, i AS at, least(i, {reach}) AS here,
        slice(w, greatest(i - {reach}, 0) + 1, least(i, {reach}) + {reach}) AS near))"""
    found = marked.selectExpr("path", "text_hash", f"inline({around})").dropDuplicates(
        ["path", "text_hash", "at"]
    )
    return found.join(F.broadcast(known), "anchor").selectExpr(
        "path", "text_hash", "at", "template",
        "slice(near, greatest(here - before, 0) + 1, n + least(here - before, 0)) AS words",
    )


def block_scores(files: DataFrame) -> DataFrame:
    """``path, text_hash, whole, license, cosine``: the best licence of each file's windows
    and of its whole text."""
    named = ", ".join(f"'{a}'" for a in ANCHORS)
    marked = files.select(
        "path", F.xxhash64("text").alias("text_hash"), terms(F.col("text")).alias("w")
    ).filter(f"exists(w, x -> x IN ({named}))")
    vectors = template_vectors(files)
    idf = vectors.groupBy("word").agg(F.max("idf").alias("idf"))
    unseen = f"(ln({1.0 + len(TEMPLATES)}D) + 1)"

    def weighed(words: DataFrame, key: list[str]) -> DataFrame:
        counted = words.groupBy(*key, "word").agg(F.count("*").alias("tf"))
        return counted.join(F.broadcast(idf), "word", "left").selectExpr(
            *key, "word", f"tf * coalesce(idf, {unseen}) AS w"
        )

    # Windows: each against the one notice it was cut for.
    key = ["path", "text_hash", "at", "template"]
    of_notices = vectors.select("template", "license", "word", "weight")
    near = weighed(windows(marked).selectExpr(*key, "explode(words) AS word"), key)
    in_windows = (
        near.join(F.broadcast(of_notices.drop("license")), ["template", "word"], "left")
        .groupBy(*key)
        .agg(
            F.expr("coalesce(sum(w * weight), 0D) AS dot"), F.expr("sqrt(sum(w * w)) AS norm")
        )
        .join(F.broadcast(of_notices.select("template", "license").distinct()), "template")
        .selectExpr("path", "text_hash", "false AS whole", "license", "round(dot / norm, 6) AS cosine")
    )
    # Whole texts: against all templates.
    key = ["path", "text_hash"]
    whole = weighed(
        marked.dropDuplicates(key).selectExpr(*key, "explode(w) AS word"), key
    )
    norms = whole.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        whole.join(F.broadcast(of_notices), "word")
        .groupBy(*key, "license", "template")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    )
    on = F.expr(" AND ".join(f"d.{c} <=> n.{c}" for c in key))
    in_whole = dots.alias("d").join(norms.alias("n"), on).selectExpr(
        "d.path", "d.text_hash", "true AS whole", "d.license", "round(dot / norm, 6) AS cosine"
    )
    return in_windows.unionByName(in_whole).groupBy("path", "text_hash", "whole").agg(
        F.expr("min(struct(-cosine AS rank, license)) AS best")
    ).selectExpr("path", "text_hash", "whole", "best.license AS license", "-best.rank AS cosine")


def _parts(path: str) -> str:
    return f"filter(split(coalesce({path}, ''), '/'), p -> p <> '')"


def scan(files: DataFrame, header_min: float = HEADER_MIN, file_min: float = FILE_MIN) -> DataFrame:
    """One row per file: ``path, license, origin, cosine, from_dir``.

    ``origin`` is file, header, inherited or none; ``from_dir`` is the directory whose
    licence file decides, NULL unless inherited.
    """
    scores = block_scores(files)
    licence_files = scores.filter(F.col("whole") & (F.col("cosine") >= file_min))
    directory = f"array_join(slice({_parts('path')}, 1, greatest(size({_parts('path')}) - 1, 0)), '/')"
    own = (
        scores.filter(
            (F.col("whole") & (F.col("cosine") >= file_min))
            | (~F.col("whole") & (F.col("cosine") >= header_min))
        )
        .groupBy("path", "text_hash")
        .agg(F.expr("max(whole) AS is_file"), F.expr("min(struct(-cosine AS rank, license)) AS best"))
        .selectExpr("path", "text_hash", "is_file", "best.license AS license", "-best.rank AS cosine")
    )
    by_dir = (
        licence_files.selectExpr(f"{directory} AS from_dir", "license", "cosine", "path")
        .groupBy("from_dir")
        .agg(F.expr("min(struct(-cosine AS rank, license, path)).license AS license"))
    )
    rows = files.select("path", F.xxhash64("text").alias("text_hash")).withColumn(
        "dir", F.expr(directory)
    )
    above = rows.select("dir").distinct().selectExpr(
        "dir", "split(dir, '/') AS p"
    ).selectExpr("dir", "explode(sequence(0, size(p))) AS depth", "p").selectExpr(
        "dir", "depth", "array_join(slice(p, 1, depth), '/') AS from_dir"
    )
    nearest = (
        above.join(by_dir, "from_dir")
        .groupBy("dir")
        .agg(F.expr("max(struct(depth, from_dir, license)) AS near"))
        .selectExpr("dir", "near.from_dir AS from_dir", "near.license AS near_license")
    )
    own_rows = (
        rows.alias("f")
        .join(own.alias("o"), F.expr("f.path <=> o.path AND f.text_hash = o.text_hash"), "left")
        .select("f.path", "f.dir", "f.text_hash", "o.is_file", "o.license", "o.cosine")
    )
    # A directory may hold a third of all files: its rows go to several tasks.
    hot = hot_routes(rows, ["dir"])
    return (
        salted_join(own_rows, nearest, ["dir"], "left", spread_by=["path", "text_hash"], hot=hot)
        .selectExpr(
            "path",
            "coalesce(license, near_license) AS license",
            "CASE WHEN is_file THEN 'file' WHEN license IS NOT NULL THEN 'header' "
            "WHEN near_license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin",
            "cosine",
            "CASE WHEN license IS NULL THEN from_dir END AS from_dir",
        )
    )


def documents_as_files(docs: DataFrame) -> DataFrame:
    """``documents`` laid out as ``source/lang/<hundred>/<doc_id>``; a NULL id is ``none``."""
    return docs.selectExpr(
        """concat_ws('/', source, lang, coalesce(CAST(doc_id DIV 100 AS STRING), 'none'),
            coalesce(CAST(doc_id AS STRING), 'none')) AS path""",
        "text",
    )
