"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance down the directories.

Three parts of every whole text are weighed. Each line, against every statement. Each window of as many terms as a
statement has, over line ends, that stands where two of the statement's heaviest terms (its prefix) fall on their places
in it and that lies in the text, against that statement: so a statement among other words or wrapped over lines is found. And the whole text of a
licence file, against whole licences. All are bags of terms (runs of a-z and 0-9 after lower-casing), weighted by term
frequency and inverse document frequency over all documents; a term that no template has weighs as one that no document
has. A part that shares no prefix term with a template cannot reach the threshold, so only parts with one are weighed: no
match is lost.

A document's licence is that of its best part. A document without one takes the licence of the licence file in the
nearest directory above it. Null texts, paths and ids: no header, no inheritance, the row stays. Ties go to the
licence name that sorts first; repeated rows give a row each.

Everything runs on DataFrame functions; what the driver sees are the templates and the frequencies of their terms.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.joins import spread_join

THRESHOLD = 0.6

#: Licence statements by licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain worldwide."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."),
)
_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
    "THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
#: Whole licences by licence. A caller may give others, long ones too.
WHOLE = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
        "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
        "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        "\"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", _BSD_2 + _AS_IS),
    ("BSD-3-Clause", _BSD_2 + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission. " + _AS_IS),
)
#: Places of prefix terms that must agree on where a window stands; a statement with one place needs only that.
AGREEING = 2
#: A template list beyond this is refused: its terms are literals of the plan.
MAX_TEMPLATE_CHARS = 1 << 20

_TERM = re.compile("[a-z0-9]+")


def template_terms(templates) -> list[tuple[str, Counter]]:
    """Licence and term frequencies of each template, with A-Z lower-cased as in `terms`."""
    if sum(len(text) for _, text in templates) > MAX_TEMPLATE_CHARS:
        raise ValueError("licence templates are larger than MAX_TEMPLATE_CHARS")
    return [(name, Counter(_TERM.findall(text.lower()))) for name, text in templates]


def terms(text: Column) -> Column:
    """The terms of a text, in order, repeats included."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def document_frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> tuple[int, dict[str, int]]:
    """The number of documents and, for each term of the vocabulary, in how many it occurs."""
    known = F.array(*[F.lit(t) for t in vocabulary])
    found = docs.select(F.explode(F.array_intersect(known, terms(F.col(text)))).alias("term"))
    counts = found.groupBy("term").count().collect()  # at most one row for each term of the templates
    return docs.count(), {row.term: row["count"] for row in counts}


def _idf(n: int, df: int) -> float:
    return math.log((1 + n) / (1 + df)) + 1


def prefix_terms(templates: list[tuple[str, Counter]], idf: dict[str, float], threshold: float) -> list[str]:
    """The heaviest terms of each template, as many as leave the rest too light to reach the threshold alone."""
    out = set()
    for _, tf in templates:
        weights = sorted(((n * idf[t], t) for t, n in tf.items()), reverse=True)
        rest = total = sum(w * w for w, _ in weights)
        for w, t in weights:
            # the cosine with a line that has none of the terms so far is at most sqrt(rest / total)
            if rest < (threshold * (1 - 1e-9)) ** 2 * total:
                break
            out.add(t)
            rest -= w * w
    return sorted(out)


def prefix_places(templates: list[tuple[str, str]], prefix: list[list[str]]) -> dict[str, list[tuple[int, int]]]:
    """For each prefix term, the template and the place in it, from 0, of every occurrence. Of a template with fewer than
    AGREEING such places, each counts AGREEING times."""
    out: dict[str, list] = {}
    for k, (_, text) in enumerate(templates):
        found = [(t, i) for i, t in enumerate(_TERM.findall(text.lower())) if t in prefix[k]]
        for t, i in found * (AGREEING if len(found) < AGREEING else 1):
            out.setdefault(t, []).append((k, i))
    return out


def _unit(kind: str, number: Column, own: Column, found: Column) -> Column:
    unit = F.struct(F.lit(kind).alias("kind"), number.alias("number"), own.cast("int").alias("own"))
    return F.struct(unit.alias("_unit"), found.alias("terms"))


def _starts(words: Column, places: dict[str, list[tuple[int, int]]]) -> Column:
    """The template and start of a window for every place of a prefix term, sorted."""
    needed = sorted(places)
    pairs = lambda t: F.array(*[F.struct(F.lit(k).alias("own"), F.lit(i).alias("place")) for k, i in places[t]])
    known = F.create_map(*[c for t in needed for c in (F.lit(t), pairs(t))])
    seen = F.filter(F.transform(words, lambda t, i: F.struct(t.alias("term"), i.alias("at"))), lambda x: x["term"].isin(needed))
    start = lambda x: lambda o: F.struct(o["own"].alias("own"), (x["at"] - o["place"]).alias("start"))
    return F.sort_array(F.flatten(F.transform(seen, lambda x: F.transform(F.try_element_at(known, x["term"]), start(x)))))


def _windows(words: str, starts: str, sizes: list[int]) -> Column:
    """The windows that lie in the text and on which prefix terms agree, from columns of its terms and sorted starts."""
    behind, last = lambda i: F.get(starts, i - AGREEING), F.lit(AGREEING - 1)
    end = lambda s: s["start"] + F.get(F.array(*map(F.lit, sizes)), s["own"])
    inside = lambda s: (s["start"] >= 0) & (end(s) <= F.size(words))
    # in the sorted array a start is kept at its AGREEING-th place
    agreed = lambda s, i: (i >= last) & (F.get(starts, i - last) == s) & F.coalesce(behind(i) != s, F.lit(True))
    cut = lambda s: F.transform(F.sequence(s["start"], end(s) - 1), lambda j: F.get(words, j))
    return F.transform(F.filter(starts, lambda s, i: agreed(s, i) & inside(s)), lambda s: _unit("window", s["start"], s["own"], cut(s)))


def _lines(text: str, needed: list[str]) -> Column:
    """The lines with a needed term."""
    holds = rf"(?<![a-z0-9])(?:{'|'.join(needed)})(?![a-z0-9])"
    numbered = F.transform(F.split(text, "\n"), lambda line, i: F.struct(line.alias("line"), i.alias("number")))
    kept = F.filter(numbered, lambda x: x["line"].rlike(holds))
    return F.transform(kept, lambda x: _unit("line", x["number"], F.lit(None), terms(x["line"])))


def license_parts(
    docs: DataFrame,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
    text: str = "text",
    whole=WHOLE,
    is_file: Column | None = None,
) -> DataFrame:
    """_row, license and similarity of the best line, window or whole licence file of each document that has one; _row is
    a column of `docs`."""
    spark = docs.sparkSession
    statements, licences = [template_terms(t) for t in (templates, whole)]
    known = statements + licences
    vocabulary = sorted({t for _, tf in known for t in tf})
    if not vocabulary:
        return spark.createDataFrame([], docs.select("_row").schema.add("license", "string").add("similarity", "double"))
    n, df = document_frequencies(docs, vocabulary, text)
    idf = {t: _idf(n, df.get(t, 0)) for t in vocabulary}
    other = _idf(n, 0)
    weights = []
    for k, (name, tf) in enumerate(known):
        norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in tf.items()))
        weights += [(k, k >= len(statements), name, t, c * idf[t] / norm) for t, c in sorted(tf.items())]
    by_template = spark.createDataFrame(weights, "template int, whole boolean, license string, term string, weight double")
    by_term = spark.createDataFrame(sorted(idf.items()), "term string, idf double")

    prefix = [prefix_terms([t], idf, threshold) for t in statements]
    in_statements, in_licences = sorted({t for p in prefix for t in p}), prefix_terms(licences, idf, threshold)
    holds = lambda needed: F.arrays_overlap("_terms", F.array(*map(F.lit, needed))) if needed else F.lit(False)
    wanted = F.coalesce(is_file, F.lit(False)) if is_file is not None else F.lit(False)
    lower = docs.select("_row", F.lower(F.col(text)).alias("_text"), wanted.alias("_file"))
    texts = lower.withColumn("_terms", terms(F.col("_text")))
    # the texts without any prefix term end here, before they are cut
    texts = texts.where(holds(in_statements) | (F.col("_file") & holds(in_licences)))
    whole_text = F.array(_unit("whole", F.lit(0), F.lit(None), F.col("_terms")))
    cuts = [F.when(F.col("_file"), whole_text).otherwise(F.slice(whole_text, 1, 0))]
    if in_statements:
        places = prefix_places(templates, prefix)
        texts = texts.withColumn("_starts", _starts(F.col("_terms"), places))
        cuts += [_lines("_text", in_statements), _windows("_terms", "_starts", [sum(tf.values()) for _, tf in statements])]
    parts = texts.select("_row", F.inline(F.concat(*cuts)))
    bags = parts.select("_row", "_unit", F.explode("terms").alias("term"))
    bags = bags.groupBy("_row", "_unit", "term").agg(F.count("*").alias("tf"))
    bags = bags.join(F.broadcast(by_term), "term", "left")
    bags = bags.withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(other)))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm")
    shared = F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "w"))).alias("known")
    norms = bags.groupBy("_row", "_unit").agg(norm, shared)
    dots = norms.select("_row", "_unit", "norm", F.inline("known")).join(F.broadcast(by_template), "term")
    own = F.col("_unit.own")
    dots = dots.where(((F.col("_unit.kind") == "whole") == F.col("whole")) & (own.isNull() | (own == F.col("template"))))
    dots = dots.groupBy("_row", "_unit", "norm", "template", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    close = dots.withColumn("similarity", F.col("dot") / F.col("norm")).where(F.col("similarity") >= threshold)
    best = close.groupBy("_row").agg(F.min(F.struct((-F.round("similarity", 9)).alias("s"), "license")).alias("b"))
    return best.select("_row", F.col("b.license").alias("license"), (-F.col("b.s")).alias("similarity"))


def parent(path: Column) -> Column:
    """The directory of a path; empty at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def nearest_licensed(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """dir, license and levels up to the nearest directory at or above each of `directories` (dir) in `licensed`
    (dir, license)."""
    parts = F.split("dir", "/")
    depths = F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts)))
    above = directories.distinct().select(
        "dir", F.explode(F.transform(depths, lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, 1, d), "/").alias("up")))).alias("a")
    )
    above = above.select("dir", "a.depth", F.col("a.up").alias("up"))
    least = licensed.groupBy(F.col("dir").alias("up")).agg(F.min("license").alias("license"))
    found = spread_join(above, least, ["up"], "inner", spread_by=["dir"])
    nearest = found.groupBy("dir").agg(F.max(F.struct("depth", "license")).alias("n"))
    top = F.when(F.col("dir") == "", 0).otherwise(F.size(F.split("dir", "/")))
    return nearest.select("dir", F.col("n.license").alias("inherited"), (top - F.col("n.depth")).alias("levels"))


def scan_licenses(
    docs: DataFrame,
    path: str = "path",
    is_license_file: Column | None = None,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
    whole=WHOLE,
) -> DataFrame:
    """key, path, license, origin ('header', 'inherited' or null), similarity (of the own header) and levels (up to
    the directory inherited from) of every row. Licence files are those named LICENSE or COPYING unless the caller
    gives another condition over `_path`."""
    name = F.regexp_extract("_path", r"([^/]*)$", 1)
    named = is_license_file if is_license_file is not None else F.upper(name).rlike("^(LICEN[CS]E|COPYING)([.-]|$)")
    row = F.struct(F.col(key).alias("key"), F.col(path).alias("path"), F.xxhash64(text).alias("hash"))
    rows = docs.select(row.alias("_row"), F.col(path).alias("_path"), F.col(text).cast("string").alias("_text"))
    rows = rows.withColumn("_row", F.to_json("_row"))
    own = license_parts(rows, templates, threshold, "_text", whole, named)
    slim = docs.select(F.col(key).alias("_key"), F.col(path).alias("_path"), F.to_json(row).alias("_row"))
    marked = spread_join(slim, own, ["_row"], "left", spread_by=["_row"]).withColumn("dir", parent(F.col("_path")))
    licensed = marked.where(named & F.col("license").isNotNull()).select("dir", "license")
    wanting = marked.where(F.col("license").isNull() & F.col("dir").isNotNull()).select("dir")
    out = spread_join(marked, nearest_licensed(wanting, licensed), ["dir"], "left", spread_by=["_row"])
    header = F.col("license").isNotNull()
    return out.select(
        F.col("_key").alias(key),
        F.col("_path").alias(path),
        F.coalesce("license", "inherited").alias("license"),
        F.when(header, "header").when(F.col("inherited").isNotNull(), "inherited").alias("origin"),
        F.col("similarity"),
        F.when(~header, F.col("levels")).alias("levels"),
    )
