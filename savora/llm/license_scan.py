"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a paragraph.  A template is reported where a block holds at least ``threshold`` of its
distinct words.  Words that no template has cannot count, so a block is reduced to its template words; these are ordered
by the number of blocks that hold them, rarest first.  A block that meets the threshold holds one of the
first ``|T| - need + 1`` words of the template (prefix filter), has ``need`` template words at all (length
filter), and has enough of them left behind the first common one (positional filter).  Pairs that pass are counted exactly.

The templates are a parameter of fixed size, so they and the counts of their words are broadcast.

Defined cases: a null text is an empty text, without words and labels; every row is kept and judged apart, also rows with equal or
null ids; other columns pass through, but for those in ``ADDED``, which are replaced; no rows give no rows.
"""

from __future__ import annotations

import math
import re
from typing import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from savora.llm.common import stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PARAGRAPHS = r"\n[ \t\r]*\n"
THRESHOLD = 0.9
PHRASES = {"cc-by": ("cc", "by"), "gpl": ("general", "public", "license"), "reserved": ("all", "rights", "reserved")}

# fixed values: wording of the licenses themselves
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
           "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
           "publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
           "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
           "conditions are met",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
           "that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
               "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike International License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "no-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                   "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
}

ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
ROW, BLOCK = "_row", "_block"


def template_words(text: str) -> list[str]:
    return sorted({w for w in re.split(SEPARATORS, text.lower()) if w})


def need_of(size: int, threshold: float) -> int:
    """Words of a template that a block must hold; the small term keeps exact products exact."""
    return max(1, math.ceil(threshold * size - 1e-9))


def block_words(text: Column) -> Column:
    """Array of the words of each paragraph."""
    lowered = F.translate(text, CAPITALS, SMALL)
    return F.transform(F.split(lowered, PARAGRAPHS), lambda p: F.filter(F.split(p, SEPARATORS), lambda w: w != ""))


def phrase_places(words: str, phrase: tuple[str, ...]) -> Column:
    """Word positions at which the phrase stands."""
    held = F.lit(True)
    for word in phrase:
        held = held & F.array_contains(words, word)
    return F.when(held, F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: _stands(words, phrase, i))).otherwise(F.array().cast("array<int>"))


def _stands(words: str, phrase: tuple[str, ...], i: Column) -> Column:
    same = F.get(F.col(words), i) == phrase[0]
    for k, word in enumerate(phrase[1:], 1):
        same = same & F.coalesce(F.get(F.col(words), i + k) == word, F.lit(False))
    return same


def template_links(blocks: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Rows ``(_row, _block, label, containment)`` of all pairs that meet the threshold.

    ``blocks`` holds ``(_row, _block, held)``, ``held`` being the distinct template words of the block; it is read twice.
    """
    spark = blocks.sparkSession
    words = {label: template_words(text) for label, text in templates.items()}
    counts = {r[0]: r[1] for r in blocks.select(F.explode("held").alias("word")).groupBy("word").count().collect()}
    vocabulary = sorted({w for ws in words.values() for w in ws}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(vocabulary)}
    prefixes, sets = [], []
    for label, ws in words.items():
        order, need = sorted(rank[w] for w in ws), need_of(len(ws), threshold)
        sets.append((label, order, len(order), need))
        prefixes += [(r, label, i) for i, r in enumerate(order[:len(order) - need + 1])]
    prefix = F.broadcast(spark.createDataFrame(prefixes, "word_rank int, label string, place int"))
    full = F.broadcast(spark.createDataFrame(sets, "label string, template array<int>, size int, need int"))
    ranks = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, rank[w])])
    ordered = blocks.filter(F.size("held") > 0).select(ROW, BLOCK, F.array_sort(F.transform("held", lambda w: ranks[w])).alias("ranks"))
    opening = sorted({p[0] for p in prefixes})
    found = (ordered.withColumn("_first", F.filter("ranks", lambda r, i: r.isin(*opening)))
             .select(ROW, BLOCK, "ranks", F.explode("_first").alias("word_rank"))
             .join(prefix, "word_rank").join(full, "label")
             .withColumn("_at", F.array_position("ranks", F.col("word_rank")).cast("int") - 1)
             # the common words before this one are at most those before it on either side
             .filter((F.size("ranks") >= F.col("need"))
                     & (F.least("place", "_at") + F.least(F.col("size") - F.col("place"), F.size("ranks") - F.col("_at")) >= F.col("need"))))
    return (found.dropDuplicates([ROW, BLOCK, "label"])
            .withColumn("common", F.size(F.array_intersect("ranks", "template"))).filter(F.col("common") >= F.col("need"))
            .select(ROW, BLOCK, "label", (F.col("common") / F.col("size")).alias("containment")))


def scan(docs: DataFrame, text: str = "text", templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Add the columns ``ADDED`` to every row.  ``score`` is the best containment of a reported template, else 0."""
    vocabulary = sorted({w for t in templates.values() for w in template_words(t)})
    rest = [c for c in docs.columns if c not in (*ADDED, text)]
    rows = (docs.withColumn("_blocks", block_words(F.coalesce(F.col(text), F.lit(""))))
            .withColumn("_words", F.flatten("_blocks")).withColumn(ROW, F.monotonically_increasing_id())
            .withColumns({f"_at_{label}": phrase_places("_words", phrase) for label, phrase in PHRASES.items()}))
    known = F.array(*[F.lit(w) for w in vocabulary])
    places = F.concat(*[F.col(f"_at_{label}") for label in PHRASES])
    rows = stored(rows.select(
        *rest, ROW, F.size("_words").cast("long").alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        F.array_compact(F.array(*[F.when(F.size(f"_at_{label}") > 0, F.lit(label)) for label in PHRASES])).alias("_base"),
        F.transform("_blocks", lambda b: F.array_intersect(b, known)).alias("_held")), "licenses")
    blocks = rows.select(ROW, F.posexplode("_held").alias(BLOCK, "held"))
    per_row = template_links(blocks, templates, threshold).groupBy(ROW).agg(
        F.collect_set("label").alias("_more"), F.max("containment").alias("_score"))
    none = F.array().cast("array<string>")
    return rows.join(per_row, ROW, "left").select(
        *rest, "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("_base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("_base", F.coalesce("_more", none)))), ",").alias("labels"),
        F.coalesce("_score", F.lit(0.0)).alias("score"))
