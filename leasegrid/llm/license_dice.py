"""Licence scan: Dice coefficient over word bigrams against licence templates.

Text is normalised to lower-case ASCII words. Lines, paragraphs and the whole
text are compared as sets of word bigrams with every template whose size the
threshold allows: 2|A and B| / (|A| + |B|) >= d needs |A| within
[d / (2 - d), (2 - d) / d] times |B|, so all other templates are pruned unseen.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence notices as their authors publish them.
TEMPLATES = {
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "bsd-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        "\"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "mit-notice": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY "
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense-notice": "This is free and unencumbered software released into the public domain.",
}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """Lower-case ASCII words and numbers, one blank between them; null counts as empty."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def with_bigrams(rows: DataFrame, norm: str, out: str) -> DataFrame:
    """Adds the set of adjacent word pairs of normalised text; a single word stands for itself.

    The words become a column of their own (behind a generator, which the
    optimiser does not undo), or every pair would split the text again.
    """
    words = rows.withColumn("__words", F.explode(F.array(F.split(norm, " "))))
    pairs = F.transform(
        F.slice("__words", 1, F.greatest(F.size("__words") - 1, F.lit(1))),
        lambda w, i: F.concat_ws(" ", w, F.get("__words", i + 1)),
    )
    return words.withColumn(out, F.explode(F.array(F.array_distinct(pairs)))).drop("__words")


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = spark.createDataFrame(sorted(templates.items()), "license_id string, body string")
    rows = rows.select("license_id", normalised(F.col("body")).alias("norm")).where("norm <> ''")
    return with_bigrams(rows, "norm", "t_pairs").drop("norm")


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_dice: float = 0.8,
) -> DataFrame:
    """Licences found in each document: ``id, license_id, dice, n_segments``.

    Segments are the whole text, its paragraphs (split at blank lines) and its
    lines; equal segments of one row count once, for the licence they resemble
    most (of equals the last by name). ``n_segments`` counts those that reach
    ``min_dice``. Null, empty and wordless texts match nothing.
    Repeated ids are reported as one document, a null id as another; further
    columns are ignored. Templates travel as a literal of a few kilobytes; a
    template set has at most a few thousand entries by nature.
    """
    chosen = TEMPLATES if templates is None else templates
    small = template_table(docs.sparkSession, chosen).collect()  # one row per template
    if not small:
        return docs.select(F.col(id_col)).limit(0).select(
            id_col, F.lit("").alias("license_id"), F.lit(0.0).alias("dice"), F.lit(0).cast("long").alias("n_segments")
        )
    known = F.array(*[
        F.struct(F.lit(r.license_id).alias("id"), F.lit(list(r.t_pairs)).alias("pairs"), F.lit(len(r.t_pairs)).alias("n"))
        for r in small
    ])
    every = F.lit(sorted({p for r in small for p in r.t_pairs}))
    low, high = min_dice / (2 - min_dice), (2 - min_dice) / min_dice
    least = min(len(r.t_pairs) for r in small) * low
    most = max(len(r.t_pairs) for r in small) * high
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = F.array_distinct(F.concat(F.array(text), F.split(text, r"\n[ \t\r]*\n"), F.split(text, "\n")))
    segments = docs.select(F.col(id_col).alias("id"), F.explode(parts).alias("part"))
    segments = segments.select("id", F.explode(F.array(normalised(F.col("part")))).alias("norm")).where("norm <> ''")
    sets = with_bigrams(segments, "norm", "pairs").drop("norm")
    sets = sets.where((F.size("pairs") >= least) & (F.size("pairs") <= most) & F.arrays_overlap("pairs", every))
    fit = F.filter(known, lambda t: (F.size("pairs") >= t["n"] * low) & (F.size("pairs") <= t["n"] * high))
    rated = F.transform(fit, lambda t: F.struct(
        (2.0 * F.size(F.array_intersect("pairs", t["pairs"])) / (F.size("pairs") + t["n"])).alias("dice"), t["id"].alias("license_id")))
    best = sets.select("id", F.array_max(rated).alias("best")).select("id", "best.*").where(F.col("dice") >= min_dice)
    return (
        best.groupBy("id", "license_id").agg(F.max("dice").alias("dice"), F.count("*").alias("n_segments"))
        .select(F.col("id").alias(id_col), "license_id", F.round("dice", 6).alias("dice"), "n_segments")
    )
