"""Licence scan: lines and paragraphs against licence templates.

Text is normalised (lower case, letters and digits, single blanks).  A passage
and a template are compared by the Dice coefficient of their sets of word
bigrams, 2 |A and B| / (|A| + |B|).  Since the coefficient bounds the sizes,
only templates of a fitting size are candidates, and since it bounds the
shared bigrams, a passage must have one of the template's first bigrams in a
fixed order.  Templates are indexed under those; texts without the word of any
indexed bigram are passed over by one search.

Only DataFrame functions are used.

Defined results: a null or empty text has no notice; a passage of one word has
no bigram and matches nothing; equal coefficients go by template name; rows
with equal doc_id are one document; an empty table gives no rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import join_same
from ..functions.sizes import broadcast_if_small
from ..functions.storage import materialise

#: Notices of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "MIT": "Released under the MIT License.",
    "MIT notice": "This project is licensed under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0 notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "All rights reserved": "All rights reserved.",
}
LEAST = 0.8


def normal(text: Column) -> Column:
    """Lower-case letters and digits, words parted by one blank, lines kept."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " "), r" *\n *", "\n")


def bigrams(passage: Column) -> Column:
    """Distinct word bigrams of one normalised passage."""
    words = F.filter(F.split(passage, "[ \n]+"), lambda w: w != "")
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pairs)


def index_of(templates: DataFrame, least: float) -> DataFrame:
    """(name, grams, n, gram): one row per bigram of which a match must have one.

    A match shares at least least / (2 - least) of a template's bigrams, so it
    has one of the first n - that + 1; the order puts long bigrams first, which
    are rare in other texts.
    """
    made = templates.select("name", bigrams(normal(F.col("text"))).alias("grams")).withColumn("n", F.size("grams")).filter("n > 0")
    order = F.transform(F.array_sort(F.transform("grams", lambda g: F.struct((-F.length(g)).alias("k"), g.alias("g")))), lambda x: x["g"])
    keep = (F.col("n") - F.ceil(F.lit(least / (2 - least)) * F.col("n") - 1e-9) + 1).cast("int")
    return made.select("name", "grams", "n", F.explode(F.slice(order, 1, keep)).alias("gram"))


def passages(text: Column) -> Column:
    """Lines, and paragraphs of several lines, of a normalised text."""
    lines = F.split(text, "\n")
    blocks = F.filter(F.split(text, "\n\n+"), lambda p: F.contains(p, F.lit("\n")))
    return F.filter(F.concat(lines, blocks), lambda p: p != "")


def notices(docs: DataFrame, templates: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, passage, name, dice) of every passage and template with at least ``least``; templates(name, text) are few."""
    index = index_of(templates, least)
    anchors = [r.w for r in index.select(F.explode(F.split("gram", " ")).alias("w")).groupBy("w").count().select("w").collect()]
    if not anchors:
        return docs.select("doc_id", F.lit("").alias("passage"), F.lit("").alias("name"), F.lit(0.0).alias("dice")).limit(0)
    first = [r.w for r in index.select(F.array_max(F.transform(F.split("gram", " "), lambda w: F.struct(F.length(w), w.alias("w"))))["w"].alias("w")).distinct().collect()]
    any_of = "(?:^|[^\\p{L}\\p{N}])(?:" + "|".join(sorted(first)) + ")(?:$|[^\\p{L}\\p{N}])"
    # One plain search per anchor over the text lower-cased once; the pattern then only reads the few texts left.
    some = F.exists(F.array(F.lower("text")), lambda t: functools.reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in sorted(first)]))
    live = docs.select("doc_id", "text").filter(some).select("doc_id", F.lower("text").alias("text"))
    passage = live.select("doc_id", F.explode(passages(normal(F.col("text")))).alias("passage")).filter(F.col("passage").rlike(any_of))
    made = passage.select("doc_id", F.trim("passage").alias("passage"), bigrams(F.col("passage")).alias("own")).withColumn("m", F.size("own"))
    low, high = least / (2 - least), (2 - least) / least
    met = made.select("*", F.explode("own").alias("gram")).join(broadcast_if_small(index), "gram").filter(
        (F.col("m") >= F.col("n") * low - 1e-9) & (F.col("m") <= F.col("n") * high + 1e-9)).drop("gram").distinct()
    dice = 2 * F.size(F.array_intersect("own", "grams")) / (F.col("m") + F.col("n"))
    return met.select("doc_id", "passage", "name", dice.alias("dice")).filter(F.col("dice") >= least)


def scan(docs: DataFrame, templates: DataFrame | None = None, least: float = LEAST) -> DataFrame:
    """(doc_id, n_notices, licence, dice): distinct notices and the best template of every document."""
    if templates is None:
        templates = docs.sparkSession.createDataFrame(sorted(TEMPLATES.items()), "name string, text string")
    found = notices(docs, templates, least)
    per = materialise(found.groupBy("doc_id").agg(F.countDistinct("passage").alias("n"),
                                      F.min_by("name", F.struct(-F.col("dice"), F.col("name"))).alias("licence"), F.max("dice").alias("dice")))
    out = join_same(docs.select("doc_id").distinct(), broadcast_if_small(per), ["doc_id"], "left")
    return out.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"), "licence", "dice")
