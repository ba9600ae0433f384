"""Licence scans by sparse TF-IDF cosine and directory inheritance (operator 5), in DataFrame functions only.

A unit is a line of a file, a block of successive lines (all of a comment or none, up to an empty line) or the whole
file.  Equal units of a file are one.  Templates are the statements, standard headers, SPDX tags and full texts that declare a
licence.  Units and templates are sparse vectors: a term that
occurs weighs its idf.  The idf of a template's term comes from its document frequency over all files;
a term of no template weighs as one that a single file holds.  A unit has the licence of the template with the
greatest cosine, if that is ``LEAST`` at least (of equals the first by name).  A file's own licence is that of its whole
text, else the best of its blocks, else of its lines; a file whose
whole text has a licence is a licence file and stands for its directory.  A file without one inherits
from the nearest directory above it that has a licence file (of several, the first by path).

Units that hold none of a template's heaviest terms can't reach ``LEAST`` (what is left of the
template is shorter than that), nor can units of which less than about half the terms are a template's, so they are left
out before their terms are counted; a file that holds none is not cut into units at all.  Inheritance is
settled once for each directory, by joining its ancestors' paths, and files then meet their directory.

Null or empty texts have no licence of their own but may inherit; a null path inherits nothing.  Repeated rows
are each judged.  Of the input only the named id, path and text columns are read; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.session import cut_lineage

LEAST = 0.7
WHOLE, BLOCK, LINE = 0, 1, 2  # parts of a file, the larger first

# The customary statements that declare a licence.
STATEMENTS = (
    ("All-Rights-Reserved", "All rights reserved."),
    ("All-Rights-Reserved", "Copyright. All rights reserved."),
    ("All-Rights-Reserved", "Copyright The Authors. All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, public domain dedication."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *((f"CC-{x}-4.0", f"Licensed under CC {x} 4.0.") for x in ("BY", "BY-NC", "BY-NC-ND", "BY-NC-SA", "BY-ND", "BY-SA")),
    *((name, f"This work is licensed under a Creative Commons {x} 4.0 International License.") for name, x in (
        ("CC-BY-4.0", "Attribution"), ("CC-BY-NC-4.0", "Attribution-NonCommercial"), ("CC-BY-NC-ND-4.0", "Attribution-NonCommercial-NoDerivatives"),
        ("CC-BY-NC-SA-4.0", "Attribution-NonCommercial-ShareAlike"), ("CC-BY-ND-4.0", "Attribution-NoDerivatives"), ("CC-BY-SA-4.0", "Attribution-ShareAlike"))),
)
# Standard headers, a paragraph each.  Each is a template with the paragraphs after it, and its first paragraph alone.
_GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software "
        "Foundation, either version {2} of the License, or (at your option) any later version.",
        "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.",
        "You should have received a copy of the GNU {1} along with this {0}. If not, see <https://www.gnu.org/licenses/>.")
HEADERS = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                   "You may obtain a copy of the License at", "http://www.apache.org/licenses/LICENSE-2.0",
     'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
     "limitations under the License."),
    *((name, *(x.format(work, text, version) for x in _GNU)) for name, work, text, version in (
        ("GPL-2.0", "program", "General Public License", "2"), ("GPL-3.0", "program", "General Public License", "3"),
        ("LGPL-2.1", "library", "Lesser General Public License", "2.1"), ("LGPL-3.0", "library", "Lesser General Public License", "3"))),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                "this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
# Licences whose full text is a file of licence_texts.
TEXTS = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")


def _templates():
    out = [*STATEMENTS, *((name, (resources.files("ordermart.llm") / "licence_texts" / f"{name}.txt").read_text("utf-8")) for name in TEXTS)]
    for name, *paragraphs in HEADERS:
        out += [(name, paragraphs[0]), *([(name, "\n".join(paragraphs))] if len(paragraphs) > 1 else [])]
    for name in sorted({x for x, _ in out} - {"All-Rights-Reserved"}):
        gnu = "GPL" in name
        out += [(name, f"SPDX-License-Identifier: {name}{end}") for end in (("", "+", "-only", "-or-later") if gnu else ("",))]
    return tuple(sorted(out, key=lambda x: x[0]))


TEMPLATES = _templates()  # in order of name
# Fixed value: punctuation between terms; full stops are dropped ("2.0." is the term 20).
PUNCTUATION = ",;:!?()[]{}\"'*\t\r\f\v/#<>%|`"
DASHES = ("", "-", "--")  # what comment marks and bullets leave
TAG = r"spdx-license-identifier:[ \t]*([^ \t\r\n]+)"  # the tag and its licence are one term
# A line that begins so is a comment's.
MARK = r"[ \t]*(?:#|//|/?\*|--|;|%|<!--)"


def terms(text: Column) -> Column:
    """Distinct terms of one unit."""
    plain = F.lower(text)
    plain = F.when(F.contains(plain, F.lit("spdx-license-identifier:")), F.regexp_replace(plain, TAG, "spdx-license-identifier_$1")).otherwise(plain)
    plain = F.translate(plain, PUNCTUATION + "\n.", " " * (len(PUNCTUATION) + 1))
    return F.array_distinct(F.filter(F.split(plain, " "), lambda w: ~w.isin(*DASHES)))


def plain_terms(text: str) -> list[str]:
    """``terms`` of a template, on the driver."""
    text = re.sub(TAG, r"spdx-license-identifier_\1", text.lower())
    for c in PUNCTUATION + "\n":
        text = text.replace(c, " ")
    return [w for w in dict.fromkeys(text.replace(".", "").split(" ")) if w not in DASHES]


def blocks(text: Column) -> Column:
    """The blocks of several lines that don't make up the whole text: successive lines up to an empty one, all of a comment or
    none."""
    apart = F.regexp_replace(text, rf"(?m)^({MARK}[^\n]*)\n(?!{MARK})", "$1\n\n")
    apart = F.regexp_replace(apart, rf"(?m)^(?!{MARK})([^\n]*)\n(?={MARK})", "$1\n\n")
    return F.filter(F.split(apart, r"\n[ \t\r]*\n\n*"), lambda b: F.contains(F.trim(b), F.lit("\n")) & (b != text))


def weights(files: DataFrame, text: str = "text") -> tuple[dict[str, float], float]:
    """(idf of the templates' terms, idf of any other term) over all files."""
    vocabulary = sorted({w for _, t in TEMPLATES for w in plain_terms(t)})
    held = files.select(F.filter(terms(F.coalesce(F.col(text), F.lit(""))), lambda w: w.isin(*vocabulary)).alias("held"))
    counted = held.select(F.explode("held").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    frequency = {r.term: r.n for r in counted.collect()}  # a row for a template's term at most
    total = files.count()
    return {w: math.log(1 + (total + 1) / (frequency.get(w, 0) + 1)) for w in vocabulary}, math.log(1 + (total + 1) / 2)


def template_vectors(idf: dict[str, float]) -> list[tuple[str, dict[str, float]]]:
    """(name, terms by weight) of each template, of length 1."""
    out = []
    for name, text in TEMPLATES:
        own = {w: idf[w] for w in plain_terms(text)}
        size = math.sqrt(sum(x * x for x in own.values()))
        out.append((name, {w: x / size for w, x in own.items()}))
    return out


def heaviest(vectors: list[tuple[str, dict[str, float]]]) -> list[str]:
    """The terms of which a unit must hold one to reach ``LEAST`` with any template."""
    needed = set()
    for _, own in vectors:
        rest = 1.0
        for w, x in sorted(own.items(), key=lambda wx: (-wx[1], wx[0])):
            if math.sqrt(max(rest, 0)) < LEAST:
                break
            needed.add(w)
            rest -= x * x
    return sorted(needed)


def holds(found: Column, needed: list[str]) -> Column:
    return F.arrays_overlap(found, F.split(F.lit(" ".join(needed)), " "))


def matches(units: DataFrame, idf: dict[str, float], other: float) -> DataFrame:
    """Units (key columns, ``terms``) with their licence and cosine; units without one are left out."""
    vectors = template_vectors(idf)
    needed = heaviest(vectors)
    spark = units.sparkSession
    keys = [c for c in units.columns if c != "terms"]
    vocabulary = spark.createDataFrame([(w, x, *(own.get(w, 0.0) * x for _, own in vectors)) for w, x in idf.items()],
                                       "term string, idf double, " + ", ".join(f"t{i} double" for i in range(len(vectors))))
    # of a unit that reaches LEAST the templates' terms make up LEAST ** 2 at least, as no other term of a file weighs less than they do
    candidates = units.select(*keys, F.size("terms").alias("size"), F.filter("terms", lambda w: w.isin(*idf)).alias("known")).filter(
        F.size("known") >= F.col("size") * F.lit(LEAST * LEAST - 0.01)).filter(holds(F.col("known"), needed))
    # copies of a unit (repeated rows) are one unit: their terms may not be summed together
    known = candidates.dropDuplicates(keys).select(*keys, "size", F.explode("known").alias("term"))
    # the vocabulary has a row for each term of the fixed templates, so its size is known
    joined = known.join(F.broadcast(vocabulary), "term").groupBy(*keys, "size").agg(
        F.sum(F.col("idf") * F.col("idf")).alias("norm"), F.count("*").alias("known"),
        *[F.sum(f"t{i}").alias(f"t{i}") for i in range(len(vectors))])
    length = F.sqrt(F.col("norm") + (F.col("size") - F.col("known")) * F.lit(other * other))
    # ten decimals: sums in another order may differ beyond them
    best = F.array_max(F.array(*[F.struct(F.round(F.col(f"t{i}") / length, 10).alias("cosine"), F.lit(-i).alias("i")) for i in range(len(vectors))]))
    names = F.array(*[F.lit(name) for name, _ in vectors])
    return joined.select(*keys, best.alias("best")).filter(F.col("best.cosine") >= LEAST).select(
        *keys, F.element_at(names, 1 - F.col("best.i")).alias("licence"), F.col("best.cosine").alias("cosine"))


def parent(path: Column) -> Column:
    """The directory of a path; the root is the empty path."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))


def scan(files: DataFrame, id: str, path: Column, text: str = "text") -> DataFrame:
    """id, path, licence, cosine (of the own licence), origin (own, inherited or null) and licence_path (the
    file that declares it) of every file."""
    rows = files.select(F.col(id).alias("id"), path.alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(text).alias("th"))
    idf, other = weights(rows)
    keys = ["id", "path", "th"]
    part = lambda size, texts: F.transform(texts, lambda t: F.struct(F.lit(size).alias("part"), t.alias("t")))
    # a file's units hold no other terms than the file: most files need no look at their blocks and lines
    near = rows.filter(holds(terms(F.col("text")), heaviest(template_vectors(idf))))
    units = near.select(*keys, F.explode(F.concat(part(WHOLE, F.array("text")), part(BLOCK, F.array_distinct(blocks(F.col("text")))),
                                                  part(LINE, F.array_distinct(F.split("text", "\n"))))).alias("u"))
    units = units.select(*keys, "u.part", F.xxhash64("u.t").alias("unit"), terms(F.col("u.t")).alias("terms"))
    found = cut_lineage(matches(units, idf, other), "licence-units")  # the few units that have a licence
    best = F.min(F.struct("part", (-F.col("cosine")).alias("x"), "licence"))
    own = found.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.licence").alias("own"), (-F.col("b.x")).alias("cosine"))
    whole = found.filter(F.col("part") == WHOLE)
    licensed = whole.filter("path is not null").groupBy(parent(F.col("path")).alias("above")).agg(
        F.min(F.struct("path", "licence")).alias("l"))
    dirs = rows.filter("path is not null").select(parent(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    up = F.concat(F.array(F.lit("")), F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))))
    settled = dirs.select("dir", F.posexplode(up).alias("depth", "above")).join(licensed, "above").groupBy("dir").agg(
        F.max_by("l", "depth").alias("l"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    found = rows.drop("text").alias("r").join(own.alias("o"), same[0] & same[1] & same[2], "left").select("r.*", "own", "cosine")
    found = found.withColumn("dir", parent(F.col("path"))).join(settled, "dir", "left")
    return found.select("id", "path", F.coalesce("own", "l.licence").alias("licence"), "cosine",
                        F.when(F.col("own").isNotNull(), "own").when(F.col("l").isNotNull(), "inherited").alias("origin"),
                        F.when(F.col("own").isNotNull(), F.col("path")).otherwise(F.col("l.path")).alias("licence_path"))
