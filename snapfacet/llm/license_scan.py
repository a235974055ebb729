"""Operator 3, licence scan: sparse TF-IDF cosine to templates, inherited down the folders.

Every line of a file, and the file as a whole, is a bag of words. Words of the templates weigh
tf * idf with document frequencies over all files; any other word weighs like a word no file has,
once. The cosine to each template (one line notices, headers, identifiers) is taken. Blocks, the
neighbouring lines between lines without a word (a comment sign is none), and again the whole file
are bags for the longer templates: wrapped headers, titles and bodies of licence files, with weights
of their own words. The best of all is the file's own licence if it reaches ``threshold``. A file without one takes
the licence of the nearest folder above it whose licence file (by name) has one: folders are joined
with the licence files of all their ancestors on the path, once per folder, not per file.

Only DataFrame functions run. Lines are scored where they are, so the texts are not shuffled. A bag
can reach the threshold only if the template words it holds have at least threshold**2 of the squared
norm of some template (Cauchy and Schwarz), and a line holds no more of them than its file: so files
are first tested by the template words they hold, then lines, and only what passes is scored; this
loses nothing. Templates and their words are a fixed list; what is collected from the files is one
document frequency for each of those words.

Defined results: a null or empty text has no licence of its own; a null path has no folder and inherits
nothing; equal scores take the last template by name; several licence files of a folder give the best
score, then the last name; repeated rows are returned as often as they are there; an empty table gives
an empty result. Other columns, whatever their names, are in ``row``.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import table
from . import blocks as B

#: Public licence notices, by SPDX name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:"""
_MIT_END = """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission. """
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at """
_APACHE_END = """http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} License as
published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version. """
_GNU_END = """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} License for more details. You should have
received a copy of the GNU {0} License along with this program. If not, see https://www.gnu.org/licenses/."""
_GNU_NAMES = [
    ("AGPL-3.0", "Affero General Public", "3", "19 November 2007"),
    ("GPL-1.0", "General Public", "1", "February 1989"),
    ("GPL-2.0", "General Public", "2", "June 1991"),
    ("GPL-3.0", "General Public", "3", "29 June 2007"),
    ("LGPL-2.0", "Library General Public", "2", "June 1991"),
    ("LGPL-2.1", "Lesser General Public", "2.1", "February 1999"),
    ("LGPL-3.0", "Lesser General Public", "3", "29 June 2007"),
]
_CC_NAMES = [
    ("CC-BY-4.0", "Attribution"),
    ("CC-BY-NC-4.0", "Attribution-NonCommercial"),
    ("CC-BY-NC-ND-4.0", "Attribution-NonCommercial-NoDerivatives"),
    ("CC-BY-NC-SA-4.0", "Attribution-NonCommercial-ShareAlike"),
    ("CC-BY-ND-4.0", "Attribution-NoDerivatives"),
    ("CC-BY-SA-4.0", "Attribution-ShareAlike"),
]
#: Wrapped headers, and the titles, paragraphs or bodies of licence files.
TEXTS = [
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + _APACHE_END),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_3 + _BSD_END),
    *((name, f"Creative Commons {kind} 4.0 International Public License") for name, kind in _CC_NAMES),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    (
        "CC0-1.0",
        """The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined
below) upon the creator and subsequent owner(s) (each and all, an "owner") of an original work of authorship and/or a
database (each, a "Work").""",
    ),
    *((name, f"GNU {kind} License Version {version}, {date}") for name, kind, version, date in _GNU_NAMES),
    *((name, _GNU.format(kind, version)) for name, kind, version, _ in _GNU_NAMES),
    *((name, _GNU.format(kind, version) + _GNU_END.format(kind)) for name, kind, version, _ in _GNU_NAMES),
    ("ISC", _ISC),
    ("MIT", _MIT),
    ("MIT", _MIT + _MIT_END),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
]
#: From the end of a line over lines without a word to the start of the next block.
BETWEEN_BLOCKS = r"\n[^A-Za-z0-9]*\n"
#: File names that hold the licence of their folder.
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([.-][^/]*)?$"


def _template_words(text: str) -> dict[str, int]:
    words = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
    return {w: words.count(w) for w in words}


def _anchors(weights: dict[str, float], least: float) -> list[str]:
    """The heaviest words of a template, so many that the others together stay below ``least`` of its squared norm."""
    words, rest = sorted(weights, key=lambda w: (-weights[w], w)), sum(x * x for x in weights.values())
    for n, w in enumerate(words):
        if rest < least:
            return words[:n]
        rest -= weights[w] ** 2
    return words


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, t in templates for w in _template_words(t)})


def _split(text: Column) -> Column:
    """The words of a text, with empty ones at the ends."""
    return F.split(F.lower(text), "[^a-z0-9]+")


def _texts(column: str) -> Column:
    return F.coalesce(B.quoted(column).cast("string"), F.lit(""))


def document_frequencies(files: DataFrame, text_col: str, terms: list[str]) -> tuple[int, dict[str, int]]:
    """Number of files, and of the files that hold each term (one row per term comes back)."""
    known = F.array(*(F.lit(t) for t in terms))
    found = F.concat(F.array_intersect(_split(_texts(text_col)), known), F.array(F.lit("")))
    rows = files.select(F.explode(found).alias("term")).groupBy("term").count().collect()
    counts = {r["term"]: r["count"] for r in rows}
    return counts.pop("", 0), counts


class Weights:
    """TF-IDF weights of the templates, as literals."""

    def __init__(self, n: int, df: dict[str, int], threshold: float, templates):
        self.threshold = threshold
        self.idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in vocabulary(templates)}
        self.other = math.log(1 + n) + 1
        self.templates = [(name, {w: k * self.idf[w] for w, k in _template_words(text).items()}) for name, text in templates]
        self.norms = [math.sqrt(sum(x * x for x in weights.values())) for _, weights in self.templates]
        self.known = F.array(*(F.lit(w) for w in self.idf))
        self.anchors = sorted({w for (_, weights), norm in zip(self.templates, self.norms) for w in _anchors(weights, self._least(norm))})

    def _least(self, norm: float) -> float:
        """The part of a template's squared norm that a bag's words must have to reach the threshold."""
        return self.threshold**2 * norm * norm * (1 - 1e-9)

    def anchored(self, held: Column) -> Column:
        """Whether there is a word that some template cannot be reached without: a cheap test, made first."""
        return F.arrays_overlap(held, F.array(*(F.lit(w) for w in self.anchors)))

    def reachable(self, held: Column) -> Column:
        """Whether the template words ``held`` have enough of some template's squared norm."""
        out = F.lit(False)
        for (_, weights), norm in zip(self.templates, self.norms):
            # words of different weights: the sum over those that are held
            share = sum((F.when(F.array_contains(held, w), F.lit(x * x)).otherwise(0.0) for w, x in weights.items()), F.lit(0.0))
            out = out | (share >= self._least(norm))
        return (F.size(held) > 0) & out

    def best(self, tf: Column, others: Column) -> Column:
        """The best (score, license) of a bag: counts of the template words it holds, and the
        number of its different other words."""
        weight = F.create_map(*(F.lit(x) for kv in self.idf.items() for x in kv))
        parts = F.transform(F.map_entries(tf), lambda e: F.pow(e["value"] * F.element_at(weight, e["key"]), F.lit(2.0)))
        norm = F.sqrt(F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x) + others * (self.other * self.other))
        scored = []
        for (name, weights), own in zip(self.templates, self.norms):
            times = [F.coalesce(F.try_element_at(tf, F.lit(w)), F.lit(0)) * F.lit(x * self.idf[w] / own) for w, x in weights.items()]
            dot = sum(times[1:], times[0])
            scored.append(F.struct(F.round(F.when(norm > 0, dot / norm).otherwise(0.0), 6).alias("score"), F.lit(name).alias("license")))
        return F.array_max(F.array(*scored))


class TextWeights(Weights):
    """The same for many words: the templates are one literal array that is walked."""

    def __init__(self, n: int, df: dict[str, int], threshold: float, templates):
        super().__init__(n, df, threshold, templates)
        rows = []
        for (name, weights), own in zip(self.templates, self.norms):
            of = lambda value: F.create_map(*(F.lit(v) for w, x in weights.items() for v in (w, value(w, x))))
            words = F.array(*(F.lit(w) for w in weights)).alias("words")
            least = F.lit(self._least(own)).alias("least")
            squares, parts = of(lambda w, x: x * x).alias("squares"), of(lambda w, x: x * self.idf[w] / own).alias("parts")
            rows.append(F.struct(F.lit(name).alias("license"), words, least, squares, parts))
        self.rows = F.array(*rows)

    def reachable(self, held: Column) -> Column:
        share = lambda t: F.aggregate(F.array_intersect(held, t["words"]), F.lit(0.0), lambda acc, w: acc + F.element_at(t["squares"], w))
        return (F.size(held) > 0) & F.exists(self.rows, lambda t: share(t) >= t["least"])

    def best(self, tf: Column, others: Column) -> Column:
        weight = F.create_map(*(F.lit(x) for kv in self.idf.items() for x in kv))
        add = lambda acc, e: acc + F.pow(e["value"] * F.element_at(weight, e["key"]), F.lit(2.0))
        norm = F.sqrt(F.aggregate(F.map_entries(tf), F.lit(0.0), add) + others * (self.other * self.other))

        def scored(t: Column) -> Column:
            held = F.array_intersect(F.map_keys(tf), t["words"])
            dot = F.aggregate(held, F.lit(0.0), lambda acc, w: acc + F.element_at(tf, w) * F.element_at(t["parts"], w))
            return F.struct(F.round(F.when(norm > 0, dot / norm).otherwise(0.0), 6).alias("score"), t["license"].alias("license"))

        return F.array_max(F.transform(self.rows, scored))


def own_licenses(files: DataFrame, text_col: str = "text", threshold: float = 0.7, templates=TEMPLATES, texts=TEXTS) -> DataFrame:
    """All columns of ``files`` in ``row``, with ``own``: (score, license) or null. Lines are held
    against ``templates``, blocks against ``texts``."""
    terms = sorted({*vocabulary(templates), *vocabulary(texts)})
    n, df = document_frequencies(files, text_col, terms)
    kinds = [(Weights(n, df, threshold, templates), "\n")] if templates else []
    kinds += [(TextWeights(n, df, threshold, texts), BETWEEN_BLOCKS)] if texts else []
    row = F.struct(*(B.quoted(c) for c in files.columns if c != text_col))
    found = files.select(row.alias("row"), _texts(text_col).alias("_text"))
    found = found.withColumn("_held", F.array_intersect(_split(F.col("_text")), F.array(*(F.lit(t) for t in terms))))
    found = found.select("row", *(_bags(weights, between).alias(f"_bags{i}") for i, (weights, between) in enumerate(kinds)))
    of = lambda weights: lambda b: weights.best(b["tf"], b["others"])
    best = [F.array_max(F.transform(f"_bags{i}", of(weights))) for i, (weights, _) in enumerate(kinds)]
    scored = found.select("row", F.array_max(F.array(*best)).alias("best"))
    return scored.select("row", F.when(F.col("best.score") >= threshold, F.col("best")).alias("own"))


def _bags(weights: Weights, between: str) -> Column:
    """The bags of ``_text``, split at ``between``, that can reach the threshold."""
    held = lambda words: F.array_intersect(words, weights.known)
    text = F.col("_text")
    # the whole file counts as one more line
    enough = weights.anchored(F.col("_held")) & weights.reachable(held(F.col("_held")))
    lines = F.when(enough, F.array_union(F.split(text, between), F.array(text))).otherwise(F.array().cast("array<string>"))
    bags = F.transform(lines, lambda line: F.filter(_split(line), lambda w: w != ""))
    bags = F.transform(bags, lambda words: F.struct(words.alias("words"), held(words).alias("held")))
    bags = F.filter(bags, lambda b: weights.anchored(b["held"]) & weights.reachable(b["held"]))

    def counted(b: Column) -> Column:
        tf = F.transform(b["held"], lambda w: F.size(F.filter(b["words"], lambda x: x == w)))
        others = F.size(F.array_distinct(b["words"])) - F.size(b["held"])
        return F.struct(F.map_from_arrays(b["held"], tf).alias("tf"), others.alias("others"))

    return F.transform(bags, counted)


def folder(path: Column) -> Column:
    """The folder of a path ('' at the top)."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", threshold: float = 0.7, templates=TEMPLATES, texts=TEXTS) -> DataFrame:
    """Per file: ``row``, ``license``, ``score``, ``origin`` ('own', 'inherited' or null) and
    ``from_folder`` (of the licence file that it is inherited from)."""
    path = F.col("row")[path_col].cast("string")
    found = own_licenses(files, text_col, threshold, templates, texts).withColumn("_folder", folder(path))
    given = found.where(path.rlike(LICENSE_FILE) & F.col("own").isNotNull()).groupBy("_folder").agg(F.max("own").alias("given"))
    given = given.select(F.col("_folder").alias("_above"), "given")
    parts = F.split("_folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    folders = found.select("_folder").where("_folder IS NOT NULL").distinct().select("_folder", F.explode(F.array_distinct(above)).alias("_above"))
    nearest = folders.join(given, "_above").groupBy("_folder").agg(F.max(F.struct(F.length("_above").alias("n"), "_above", "given")).alias("_near"))
    out = found.join(nearest.withColumnRenamed("_folder", "_of"), F.col("_folder") == F.col("_of"), "left")
    inherited = F.col("own").isNull() & F.col("_near").isNotNull()
    return out.select(
        "row",
        F.coalesce(F.col("own.license"), F.col("_near.given.license")).alias("license"),
        F.coalesce(F.col("own.score"), F.col("_near.given.score")).alias("score"),
        F.when(F.col("own").isNotNull(), F.lit("own")).when(inherited, F.lit("inherited")).alias("origin"),
        F.when(inherited, F.col("_near._above")).alias("from_folder"),
    )


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, laid out as a source tree: source / thousands / hundreds / file, where
    every fiftieth document is the licence file of its folder and every thousandth of the one
    above."""
    i = F.col("doc_id")
    above = F.concat_ws("/", F.coalesce("source", F.lit("none")), (i / 1000).cast("long").cast("string"))
    below = F.concat_ws("/", above, (i / 100).cast("long").cast("string"))
    name = F.when(i % 1000 == 0, F.concat_ws("/", above, F.lit("LICENSE"))).when(i % 50 == 0, F.concat_ws("/", below, F.lit("COPYING")))
    path = F.coalesce(name, F.concat(below, F.lit("/"), i.cast("string"), F.lit(".txt")))
    docs = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    out = scan(docs)
    return out.select("row.doc_id", "row.path", "license", F.round("score", 4).alias("score"), "origin", "from_folder")


def _oracle_kind(k: str, templates, bags: str) -> str:
    """Tables of one kind of templates, held against the given bags: no key words, no test before the score."""
    values = ", ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(templates))
    split = "list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda w: w <> '')"
    return f"""
  templates{k}(t, name, body) AS (VALUES {values}),
  tw{k} AS (SELECT t, name, w, count(*) AS n FROM (SELECT t, name, unnest({split.format('body')}) AS w FROM templates{k}) GROUP BY t, name, w),
  df{k} AS (SELECT w, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({split.format('text')}) AS w FROM files) WHERE w IN (SELECT w FROM tw{k}) GROUP BY w),
  idf{k} AS (SELECT w, ln((1 + n.n) / (1 + coalesce(df.df, 0))) + 1 AS idf FROM (SELECT DISTINCT w FROM tw{k}) LEFT JOIN df{k} AS df USING (w), n),
  lines{k} AS (SELECT doc_id, unnest(list_distinct(list_append({bags}, text))) AS line FROM files),
  bags{k} AS (SELECT doc_id, line, w, count(*) AS n FROM (SELECT doc_id, line, unnest({split.format('line')}) AS w FROM lines{k}) GROUP BY doc_id, line, w),
  norms{k} AS (SELECT doc_id, line, sqrt(sum(CASE WHEN i.w IS NULL THEN (ln(1 + nn.n) + 1) * (ln(1 + nn.n) + 1) ELSE b.n * idf * b.n * idf END)) AS norm
      FROM bags{k} b LEFT JOIN idf{k} i ON i.w = b.w, n AS nn GROUP BY doc_id, line),
  tn{k} AS (SELECT t, sqrt(sum(n * idf * n * idf)) AS norm FROM tw{k} JOIN idf{k} USING (w) GROUP BY t),
  dots{k} AS (SELECT b.doc_id, b.line, tw.t, tw.name, sum(b.n * tw.n * idf * idf) AS dot FROM bags{k} b JOIN tw{k} tw USING (w) JOIN idf{k} USING (w)
      GROUP BY b.doc_id, b.line, tw.t, tw.name),
  scored{k} AS (SELECT d.doc_id, d.name, round(dot / (norms.norm * tn.norm), 6) AS score FROM dots{k} d JOIN norms{k} norms USING (doc_id, line) JOIN tn{k} tn USING (t)),"""


def _oracle(threshold: float = 0.7) -> str:
    """The same result in DuckDB: all lines against all notices, all blocks against all headers and bodies."""
    lines = _oracle_kind("1", TEMPLATES, "string_split(text, chr(10))")
    blocks = _oracle_kind("2", TEXTS, f"regexp_split_to_array(text, '{BETWEEN_BLOCKS}')")
    return f"""
WITH files AS (SELECT doc_id, coalesce(text, '') AS text,
      coalesce(source, 'none') || '/' || CAST(doc_id // 1000 AS VARCHAR) AS above,
      coalesce(source, 'none') || '/' || CAST(doc_id // 1000 AS VARCHAR) || '/' || CAST(doc_id // 100 AS VARCHAR) AS below FROM documents),
  paths AS (SELECT doc_id, text, CASE WHEN doc_id % 1000 = 0 THEN above || '/LICENSE' WHEN doc_id % 50 = 0 THEN below || '/COPYING'
      ELSE below || '/' || CAST(doc_id AS VARCHAR) || '.txt' END AS path,
      CASE WHEN doc_id % 1000 = 0 THEN above ELSE below END AS folder FROM files),
  n AS (SELECT count(*) AS n FROM documents),{lines}{blocks}
  scored AS (SELECT * FROM scored1 UNION ALL SELECT * FROM scored2),
  own AS (SELECT doc_id, name, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, name DESC) AS r FROM scored) WHERE r = 1 AND score >= {threshold}),
  given AS (SELECT folder, name, score FROM (SELECT folder, name, score, row_number() OVER (PARTITION BY folder ORDER BY score DESC, name DESC) AS r
      FROM paths JOIN own USING (doc_id) WHERE doc_id % 50 = 0) WHERE r = 1),
  near AS (SELECT p.doc_id, g.folder, g.name, g.score, row_number() OVER (PARTITION BY p.doc_id ORDER BY length(g.folder) DESC) AS r
      FROM paths p JOIN given g ON p.folder = g.folder OR starts_with(p.folder, g.folder || '/'))
SELECT p.doc_id, p.path, coalesce(own.name, near.name) AS license, round(coalesce(own.score, near.score), 4) AS score,
  CASE WHEN own.name IS NOT NULL THEN 'own' WHEN near.name IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN own.name IS NULL THEN near.folder END AS from_folder
FROM paths p LEFT JOIN own ON own.doc_id = p.doc_id LEFT JOIN near ON near.doc_id = p.doc_id AND near.r = 1
"""


OP3_SQL = _oracle()
