"""Operator 7, licence scan: Dice coefficient over word bigrams.

Every line of a text, and the text as a whole, is normalised (lower case,
letters and digits only) and compared with every licence template by the
Dice coefficient of their sets of word bigrams.  Only a unit whose number of
bigrams lies within the bounds that the least score allows is compared
(2 min / (a + b) >= t  <=>  t / (2 - t) <= a / b <= (2 - t) / t).  The
templates are compiled into the projection, so no row is joined, shuffled or
handed to a user function.

Edge cases: null, empty and one-word texts have no bigrams and match nothing;
repeated rows are scanned each; equal scores go to the template that comes
first by name; texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

LEAST = 0.8

#: fixed values: notices by which works commonly state their licence
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License."),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.",
                     "Released under the 2-Clause BSD License."),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.",
                     "Use of this source code is governed by a BSD-style license that can be found in "
                     "the LICENSE file."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all "
                "copyright and related rights to this work."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the software without restriction."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, Version 2.0."),
}


def _bigrams_py(text: str) -> list[str]:
    """The bigrams of a template, by the rule that ``_bigrams`` applies to texts."""
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _words(unit: Column) -> Column:
    plain = F.btrim(F.regexp_replace(F.lower(unit), "[^a-z0-9]+", " "))
    return F.split(plain, " ")


def _bigrams(words: Column) -> Column:
    return F.array_distinct(F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b)))


def _best(bigrams: Column, templates: dict[str, tuple[str, ...]], least: float) -> Column:
    """struct(score, licence) of the best template, null if none reaches ``least``."""
    n, found = F.size(bigrams), []
    for name in sorted(templates):
        for text in templates[name]:
            t = _bigrams_py(text)
            low, high = len(t) * least / (2 - least), len(t) * (2 - least) / least
            score = (2.0 * F.size(F.array_intersect(bigrams, F.array(*[F.lit(x) for x in t])))) / (n + len(t))
            found.append(F.when(n.between(low, high) & (score >= least),
                                F.struct(score.alias("score"), F.lit(name).alias("licence"))))
    # the highest score; of equal ones the first name
    return F.get(F.array_sort(F.filter(F.array(*found), lambda x: x.isNotNull()),
                              lambda a, b: F.when(a["score"] > b["score"], -1).when(
                                  a["score"] < b["score"], 1).when(a["licence"] < b["licence"], -1).when(
                                  a["licence"] > b["licence"], 1).otherwise(0)), 0)


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, least: float = LEAST,
         text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: the best licence of the whole text and of any of
    its lines, with score, and the line (from 0) that states it."""
    templates = TEMPLATES if templates is None else templates
    longest = max(len(_bigrams_py(t)) for x in templates.values() for t in x) if templates else 0
    # a unit with more words than this is outside all bounds, unless its bigrams repeat
    bound = int(longest * (2 - least) / least) + 1
    df = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    df = df.withColumn("units", F.concat(F.split("t", "\n", -1), F.array("t")))
    df = df.withColumn("grams", F.transform("units", lambda u: _bigrams(_words(u))))
    df = df.withColumn("hits", F.transform("grams", lambda g, i: F.when(
        F.size(g) <= bound, F.struct(_best(g, templates, least).alias("b"), i.alias("line")))))
    df = df.withColumn("hits", F.filter("hits", lambda h: h["b"].isNotNull()))
    top = F.get(F.array_sort("hits", lambda a, b: F.when(a["b"]["score"] > b["b"]["score"], -1).when(
        a["b"]["score"] < b["b"]["score"], 1).when(a["b"]["licence"] < b["b"]["licence"], -1).when(
        a["b"]["licence"] > b["b"]["licence"], 1).otherwise(a["line"] - b["line"])), 0)
    df = df.withColumn("top", top).withColumn("n_units", F.size("units"))
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["b"]["licence"])))
    return df.select(
        "doc_id", F.col("top.b.licence").alias("licence"), F.round("top.b.score", 6).alias("score"),
        F.when(F.col("top.line") < F.col("n_units") - 1, F.col("top.line")).otherwise(
            F.when(F.col("top.line").isNotNull(), -1)).cast("int").alias("line"),
        F.array_join(names, ",").alias("licences"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
