"""Licence scan: text segments against licence templates by Dice over word bigrams.

Segments are a document's lines, its paragraphs (between lines without letters or
digits) and the whole document. A segment is normalised to lower-case words of letters and digits; its
bigrams are a set. With ``A`` and ``B`` the bigram sets of segment and template, their
score is ``2 |A & B| / (|A| + |B|)``.

For a threshold ``t`` two bounds prune without loss. Sizes: ``|A|`` has to lie between
``t / (2 - t) * |B|`` and ``(2 - t) / t * |B|``. Overlap: at least
``t / (2 - t) * |B|`` of the template's bigrams have to be there, so any choice of the
others and one more must be met; the choice takes those with the longest words. Only
segments that meet such an anchor are scored.

Templates are a parameter of bounded size (``MAX_TEMPLATES``, ``MAX_TEMPLATE_WORDS``,
both checked); their anchors are therefore broadcast.

Defined results: null and empty texts have no segment and no row. A segment of one word
has no bigram and never matches. Each segment gets its best template, ties going to the
smaller name; a segment that is at once line, paragraph or document is reported once, as
the smallest of them. Repeated rows are reported as one (same id, same place, same text).
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8
MAX_TEMPLATES, MAX_TEMPLATE_WORDS = 1000, 20_000

# Public licence notices.
TEMPLATES = {
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT/line": "Released under the MIT License.",
    "MIT/licensed": "Licensed under the MIT License.",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD/conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL/notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-3.0/line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0/notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0/line": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0/line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0/notice": "To the extent possible under law, the author has waived all copyright to this work.",
    "Unlicense/notice": "This is free and unencumbered software released into the public domain.",
    "rights-reserved": "All rights reserved.",
}


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def bigrams(text: str) -> list[str]:
    """The distinct ones, in order of first occurrence."""
    found = words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(found, found[1:], strict=False)))


def head(anchor: str) -> str:
    """The word of a bigram to look for first."""
    return max(anchor.split(" "), key=lambda w: (len(w), w))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Sizes that a set may have to reach the threshold with one of ``size``."""
    slack = 1e-9
    return math.ceil(threshold / (2 - threshold) * size - slack), math.floor((2 - threshold) / threshold * size + slack)


def anchors(found: list[str], often: Counter[str], threshold: float) -> list[str]:
    """Bigrams of which every set within reach of the template holds at least one."""
    missing = len(found) - size_bounds(len(found), threshold)[0]
    return sorted(found, key=lambda b: (-len(head(b)), often[b], b))[: missing + 1]


def template_table(spark: SparkSession, templates: dict[str, str], threshold: float) -> DataFrame:
    """``template, bigrams, low, high, anchors`` as a literal of the plan."""
    if len(templates) > MAX_TEMPLATES or any(len(words(t)) > MAX_TEMPLATE_WORDS for t in templates.values()):
        raise ValueError("too many or too long templates for a broadcast")
    sets = {name: found for name, text in templates.items() if (found := bigrams(text))}
    if not sets:
        raise ValueError("no template holds a word bigram")
    often = Counter(b for found in sets.values() for b in found)
    rows = []
    for name, found in sets.items():
        low, high = size_bounds(len(found), threshold)
        rows.append(F.struct(
            F.lit(name).alias("template"),
            F.array(*map(F.lit, found)).alias("template_bigrams"),
            F.lit(low).alias("low"), F.lit(high).alias("high"),
            F.array(*map(F.lit, anchors(found, often, threshold))).alias("anchors"),
        ))
    return spark.range(1).select(F.inline(F.array(*rows)))


def _normalised(text: Column) -> Column:
    """Lower-case words with single spaces between; line ends stay."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def _words(norm: Column) -> Column:
    return F.split(F.translate(norm, "\n", " "), " +")


def _pairs(found: Column) -> Column:
    """Bigrams of an array of words, with repetitions."""
    n = F.greatest(F.size(found) - 1, F.lit(0))
    return F.zip_with(F.slice(found, F.lit(1), n), F.slice(found, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))


def _segments(docs: DataFrame, heads: list[str], id_col: str, text_col: str) -> DataFrame:
    """``doc_id, kind, number, words`` of segments that hold one of the words ``heads``."""
    def parts(kind: str, found: Column) -> Column:
        return F.transform(found, lambda s, i: F.struct(F.lit(kind).alias("kind"), i.alias("number"), s.alias("part")))

    def met(found: Column) -> Column:
        return F.exists(found, lambda w: w.isin(heads))

    empty = r"(?: ?\n)(?: ?\n)+"
    norm = F.col("norm")
    # A paragraph or document is another segment only if it spans several lines or paragraphs.
    blocks = F.filter(parts("paragraph", F.split(norm, empty)), lambda s: F.instr(s["part"], "\n") > 0)
    whole = F.filter(parts("document", F.array(norm)), lambda s: s["part"].rlike(empty))
    return (
        docs.filter(F.lower(F.col(text_col)).rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(heads)})(?![\p{{L}}\p{{N}}])"))
        .select(F.col(id_col).alias("doc_id"), _normalised(F.col(text_col)).alias("norm"))
        .select("doc_id", F.inline(F.concat(parts("line", F.split(norm, "\n")), blocks, whole)))
        .select("doc_id", "kind", "number", F.filter(_words(F.col("part")), lambda w: w != "").alias("words"))
        .filter(met(F.col("words")))
    )


def scan(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, kind, number, license, shared, dice`` of every segment that reaches the threshold.

    ``number`` counts lines or paragraphs from 0; ``shared`` is the number of common bigrams.
    """
    table = template_table(docs.sparkSession, templates, threshold)
    bounds = [size_bounds(n, threshold) for t in templates.values() if (n := len(bigrams(t)))]
    least, most = min(low for low, _ in bounds), max(high for _, high in bounds)
    often = Counter(b for t in templates.values() for b in bigrams(t))
    heads = sorted({head(a) for t in templates.values() for a in anchors(bigrams(t), often, threshold)})
    marks = table.select("template", "low", "high", F.explode("anchors").alias("anchor")).select(
        "template", "low", "high", F.xxhash64("anchor").alias("mark")
    )
    met = (
        _segments(docs, heads, id_col, text_col)
        .withColumn("set", F.array_distinct(F.transform(_pairs(F.col("words")), lambda b: F.xxhash64(b))))
        .filter(F.size("set").between(least, most))
        .select("doc_id", "kind", "number", "words", F.size("set").alias("n"), F.explode("set").alias("mark"))
        .join(F.broadcast(marks), "mark")
        .filter("n between low and high")
        .select("doc_id", "kind", "number", "words", "template").distinct()
    )
    mine = F.array_distinct(_pairs(F.col("words")))
    scored = (
        met.join(F.broadcast(table.select("template", "template_bigrams")), "template")
        .select(
            "doc_id", "kind", "number", "words", "template",
            F.size(F.array_intersect(mine, F.col("template_bigrams"))).alias("shared"),
            (F.size(mine) + F.size("template_bigrams")).alias("both"),
        )
        .withColumn("dice", F.lit(2.0) * F.col("shared") / F.col("both"))
        .filter(F.col("dice") >= threshold)
    )
    best = F.struct((-F.col("dice")).alias("worse"), F.col("template").alias("license"), "shared", "dice")
    return (
        scored.groupBy("doc_id", "kind", "number", "words").agg(F.min(best).alias("best"))
        .select("doc_id", "kind", "number", "best.license", "best.shared", "best.dice")
    )
