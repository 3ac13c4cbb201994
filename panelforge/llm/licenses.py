"""License scans: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Units are the sentences that hold a marker word, anywhere in a text, the blocks
of successive non-blank lines that hold one (comment signs stripped, lines
joined) and their marked sentences, and the whole texts of files named as
licence files.  A unit's sparse TF-IDF vector is
compared with those of the templates; document frequencies are counted over all
texts.  A file without a licence of its own takes that of the nearest directory
above it that has a licence file with one, by joining its ancestor paths.

Everything is DataFrame functions.  Equal units are scored once, so a notice
that stands in a third of all files is one row after map-side combining; the
joins back have single rows on the other side.  What is broadcast are the
templates' terms, a few hundred whatever the input.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, text_of

#: Standard public notices, short and long, by SPDX identifier.
TEMPLATES: Mapping[str, Sequence[str]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0"),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
        "SPDX-License-Identifier: MIT"),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause"),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "SPDX-License-Identifier: GPL-3.0"),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3.",
                 "SPDX-License-Identifier: LGPL-3.0"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal dedication.",),
}
#: Words that make a sentence a unit, and names of licence files.
MARKER = r"(?i)licen[cs]e|copyright|permission|redistribut|public domain|spdx"
LICENSE_FILE = r"(?i)^(un)?licen[cs]e|^copying|^notice"
#: The least cosine that counts as a match.
THRESHOLD = 0.6
#: Comment signs at the start and the end of a line.
_COMMENT = r"(?m)^[ \t]*(?:/\*+|\*+/?|//+!?|#+|--+|;+|%+|<!--)?[ \t]*|[ \t]*(?:\*+/|-->)[ \t\r]*$"
_NOT_TERM = r"[^a-z0-9.]+|\.(?![0-9])"


def _terms(text: Column) -> Column:
    """Lower-case words and numbers such as 2.0, as an array."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), _NOT_TERM, " "), " "), lambda x: x != "")


def _template_terms(text: str) -> list[str]:
    return [x for x in re.sub(_NOT_TERM, " ", text.lower()).split(" ") if x]


def _sentences(text: Column) -> Column:
    """Sentences of each line: cut after . ! ? where a capital follows."""
    return F.flatten(F.transform(F.split(text, "\n"), lambda x: F.split(x, r"(?<=[.!?])\s+(?=\p{Lu})")))


def _blocks(text: Column) -> Column:
    """Blocks of several successive non-blank lines with a marker word, without comment signs, joined to one line."""
    bare = F.regexp_replace(text, _COMMENT, "")
    blocks = F.filter(F.split(bare, r"\n(?:[ \t\r\f]*\n)+"), lambda x: x.rlike(r"\S[ \t\r\f]*\n") & x.rlike(MARKER))
    return F.transform(blocks, lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))


def _header_units(text: Column) -> Column:
    """The blocks and their sentences with a marker word."""
    cut = F.transform(_blocks(text), lambda x: F.concat(F.array(x), F.filter(
        F.split(x, r"(?<=[.!?:])\s+(?=\p{Lu})"), lambda y: y.rlike(MARKER))))
    return F.array_distinct(F.flatten(cut))


def idf_weights(df: DataFrame, text: str, vocabulary: Sequence[str]) -> tuple[dict[str, float], float]:
    """ln((1 + N) / (1 + df)) + 1 of each word over all N texts, and the weight of a word that no text has."""
    words = F.array(*[F.lit(x) for x in vocabulary])
    found = df.select(F.explode_outer(F.array_union(F.array(F.lit("")), F.array_intersect(_terms(text_of(text)), words)))
                      .alias("term"))
    counts = {r["term"]: r["n"] for r in found.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = counts.get("", 0)
    return {x: math.log((1 + n) / (1 + counts.get(x, 0))) + 1 for x in vocabulary}, math.log(1 + n) + 1


def score_units(units: DataFrame, idf: Mapping[str, float], unseen: float, templates=TEMPLATES) -> DataFrame:
    """uid, license, score: the best template for each distinct ``unit`` (ties: the first name).

    ``uid`` tells units apart and goes with their words in place of the text.  Words outside the templates weigh as
    words that no text has.
    """
    spark = units.sparkSession
    names = [(name, text) for name, texts in sorted(templates.items()) for text in texts]
    vectors = []
    for _, text in names:
        raw = {t: k * idf[t] for t, k in Counter(_template_terms(text)).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        vectors.append({t: v / norm for t, v in raw.items()})
    table = spark.createDataFrame([(t, idf[t], [v.get(t, 0.0) for v in vectors]) for t in sorted(idf)],
                                  "term string, idf double, weights array<double>")
    terms = units.select("uid", "unit").distinct().select("uid", F.explode(_terms(F.col("unit"))).alias("term"))
    terms = terms.groupBy("uid", "term").agg(F.count(F.lit(1)).alias("tf"))
    terms = terms.join(F.broadcast(table), "term", "left")          # the templates' terms
    weight = F.col("tf") * F.coalesce("idf", F.lit(unseen))
    sums = terms.groupBy("uid").agg(
        F.sqrt(F.sum(weight * weight)).alias("norm"),
        *[F.sum(weight * F.coalesce(F.col("weights")[i], F.lit(0.0))).alias(f"t{i}") for i in range(len(names))])
    scores = F.array(*[F.struct(F.round(F.col(f"t{i}") / F.col("norm"), 12).alias("score"), F.lit(-i).alias("at"),
                                F.lit(name).alias("license")) for i, (name, _) in enumerate(names)])
    return sums.select("uid", F.array_max(scores).alias("best")).select("uid", "best.license", "best.score")


def scan_licenses(df: DataFrame, id_col: str = "doc_id", path: str = "path", text: str = "text", templates=TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """id, path, own_license, own_score, license, license_dir for every distinct (id, path) of ``df``.

    * ``own_license``: the best template over the file's units if its cosine reaches ``threshold``, else null;
      ``own_score``: that cosine (0 without units).
    * ``license``: the file's own, else that of the nearest directory at or above the file's that has a licence file
      with a licence of its own (``license_dir``; the root is the empty path), else null.  Several licence files in
      one directory: the highest score, then the first name.
    * Null and empty texts have no units; a null path inherits nothing.  Rows that share id and path are one file.
      An empty table gives an empty result.  Other columns are ignored.
    """
    vocabulary = sorted({t for texts in templates.values() for x in texts for t in _template_terms(x)})
    idf, unseen = idf_weights(df, text, vocabulary)
    files = df.select(F.col(id_col).alias("id"), F.col(path).alias("path"), text_of(text).alias("text"))
    name = F.regexp_extract(F.coalesce("path", F.lit("")), r"[^/]*$", 0)
    is_license = name.rlike(LICENSE_FILE)
    marked = files.filter(F.col("text").rlike(MARKER) | is_license)
    units = marked.select("id", "path", F.explode(F.concat(
        F.filter(_sentences(F.col("text")), lambda x: x.rlike(MARKER)), _header_units(F.col("text")),
        F.when(is_license, F.array("text")).otherwise(F.array().cast("array<string>")))).alias("unit"))
    units = cut_lineage(units.withColumn("uid", F.unhex(F.sha2("unit", 256))), "units")
    scored = units.select("id", "path", "uid").join(score_units(units, idf, unseen, templates), "uid")
    best = scored.groupBy("id", "path").agg(
        F.max(F.struct("score", F.col("license"))).alias("best"))
    own = F.when(F.col("best.score") >= threshold, F.col("best.license"))
    rows = files.select("id", "path").distinct().join(
        best.withColumnsRenamed({"id": "b_id", "path": "b_path"}),
        F.col("id").eqNullSafe(F.col("b_id")) & F.col("path").eqNullSafe(F.col("b_path")), "left").select(
        "id", "path", own.alias("own_license"), F.coalesce("best.score", F.lit(0.0)).alias("own_score"))

    parent = F.regexp_replace(F.col("path"), r"/?[^/]*$", "")
    dirs = (rows.filter(is_license & F.col("own_license").isNotNull()).groupBy(parent.alias("dir"))
            .agg(F.max_by("own_license", F.struct("own_score", F.col("own_license"))).alias("dir_license")))
    parts = F.split(parent, "/")
    ancestors = F.array_union(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/")))
    heirs = rows.filter("own_license is null and path is not null").select("id", "path", F.explode(ancestors).alias("dir"))
    found = heirs.join(dirs, "dir").groupBy("id", "path").agg(
        F.max(F.struct(F.length("dir").alias("depth"), F.col("dir"), F.col("dir_license"))).alias("near"))
    found = found.select(F.col("id").alias("f_id"), F.col("path").alias("f_path"), "near.dir", "near.dir_license")
    out = rows.join(found, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("path") == F.col("f_path")), "left")
    return out.select(F.col("id").alias(id_col), F.col("path").alias(path), "own_license", "own_score",
                      F.coalesce("own_license", "dir_license").alias("license"), F.col("dir").alias("license_dir"))
