"""Licence notices in documents, by the Dice coefficient of word bigrams.

A text is read as units: itself, its lines, and the sentences of its lines. Units and
templates are normalised alike (lower case, one space for every run of other characters
than letters and digits) and become sets of word bigrams. A template with m bigrams can
only reach the threshold t against a unit of m t / (2 - t) to m (2 - t) / t bigrams, which
prunes the templates of a unit, and only against a unit that holds one of the template's
marker bigrams: as many of its bigrams as may be missing from a match, and one more. The
markers' longest words prune whole texts first. The best template of a unit is reported.

Everything is an expression on the row; only the matches, few rows, are shuffled to keep
the best one of each unit.

Results for odd input: null and empty texts and units of fewer than two words match
nothing; of equally good templates the first by name counts; repeated rows are scanned
alike; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.text import computed_once

THRESHOLD = 80  # per cent
NOT_WORD = r"[^\p{L}\p{N}]+"
_BREAK = "\x01"

# The templates, notices and short licence texts, by licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


# Words too common to look for.
COMMON = frozenset("a and any as at be by can for in is not of on or out that the this to under with you".split())


def _rare(bigram: str) -> str:
    """The word to look for: the longest that is not common."""
    return max(bigram.split(), key=lambda w: (w not in COMMON, len(w), w))


@dataclass(frozen=True)
class Template:
    license: str
    bigrams: tuple[str, ...]
    low: int
    high: int
    markers: tuple[str, ...]


def template(license: str, text: str, threshold: int = THRESHOLD) -> Template:
    """A template's bigrams, the sizes it can match, and the bigrams one of which a match has."""
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    bigrams = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
    m = len(bigrams)
    low, high = -(-m * threshold // (200 - threshold)), m * (200 - threshold) // threshold
    least_shared = math.ceil(threshold * (m + low) / 200)
    # Bigrams with long words that are not common are taken for the rarest.
    order = lambda b: (_rare(b) in COMMON, -len(_rare(b)), b)
    markers = sorted(bigrams, key=order)[: m - least_shared + 1]
    return Template(license, tuple(bigrams), low, high, tuple(markers))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " "))


def bigrams(words: Column) -> Column:
    """The distinct bigrams of an array of words."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    # Two arrays side by side: the words are an argument, computed once, not once per pair.
    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def _strings(values: list[str] | tuple[str, ...]) -> Column:
    """An array of texts as one literal."""
    return F.split(F.lit("\n".join(values)), "\n")


def scan_licenses(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: int = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, line, sentence, license, n_bigrams, n_shared, dice) of every unit that
    matches. line is -1 for the whole text and sentence -1 for a whole line; a line of one
    sentence is only reported as a sentence, and a text of one line as a line."""
    known = sorted((template(name, text, threshold) for name, text in templates), key=lambda t: (t.license, t.bigrams))
    markers = sorted({m for t in known for m in t.markers})
    words_of = sorted({_rare(m) for m in markers})
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    near = text.where(F.arrays_overlap(F.split(normalised(F.col("text")), " "), _strings(words_of)))
    # The row's number tells units of repeated rows apart.
    marked = near.withColumn("_row", F.monotonically_increasing_id()).withColumn("_b", F.regexp_replace("text", r"([.!?])[ \t]+", f"$1{_BREAK}"))
    lines = marked.select("_row", "doc_id", F.posexplode(F.split("_b", "\n")).alias("line", "_l"))
    whole = marked.select(
        "_row", "doc_id", F.lit(-1).alias("line"), F.lit(-1).alias("sentence"), F.translate("_b", _BREAK, " ").alias("unit")
    ).where(F.instr("_b", "\n") > 0)
    parts = F.split("_l", _BREAK)
    units = F.concat(
        F.transform(parts, lambda s, i: F.struct(i.alias("sentence"), s.alias("unit"))),
        F.when(
            F.size(parts) > 1, F.array(F.struct(F.lit(-1).alias("sentence"), F.translate("_l", _BREAK, " ").alias("unit")))
        ).otherwise(F.array().cast("array<struct<sentence: int, unit: string>>")),
    )
    each = lines.select("_row", "doc_id", "line", F.inline(units)).unionByName(whole)
    # Sets and then templates pass a generator, so nothing is computed once per mention.
    grams = F.struct(bigrams(F.split(normalised(F.col("unit")), " ")).alias("g"))
    sets = computed_once(each, grams, "_row", "doc_id", "line", "sentence").where(F.arrays_overlap("g", _strings(markers)))
    # The templates are the query set, a few rows: every unit left meets each by its number.
    table = docs.sparkSession.createDataFrame(
        [(k, t.license, len(t.bigrams), t.low, t.high, list(t.bigrams)) for k, t in enumerate(known)],
        "k int, license string, m int, low int, high int, t array<string>",
    )
    each_template = F.explode(F.sequence(F.lit(0), F.lit(len(known) - 1))).alias("k")
    candidates = sets.select(
        "_row", "doc_id", "line", "sentence", "g", F.size("g").alias("n_bigrams"), each_template
    ).join(F.broadcast(table), "k")
    compared = candidates.where(F.col("n_bigrams").between(F.col("low"), F.col("high"))).select(
        "_row", "doc_id", "line", "sentence", "k", "license", "n_bigrams", "m",
        F.size(F.array_intersect("g", "t")).alias("n_shared"),
    )
    total = F.col("m") + F.col("n_bigrams")
    matching = compared.where(200 * F.col("n_shared") >= threshold * total).withColumn("dice", 2.0 * F.col("n_shared") / total)
    best = F.max_by(F.struct("license", "n_bigrams", "n_shared", "dice"), F.struct("dice", -F.col("k")))
    return matching.groupBy("_row", "doc_id", "line", "sentence").agg(best.alias("_b")).select(
        "doc_id", "line", "sentence", "_b.*"
    )
