"""License scans: MinHash bands over overlapping windows retrieve templates, containment decides.

Words are runs of a-z, 0-9 and characters beyond ASCII, lower-cased; a shingle is two words.
A template of ``m`` shingles belongs to the class of the next power of two, ``c``; its documents
are cut into windows of ``c + c/4`` shingles, ``c/4`` apart, so an occurrence lies whole in some
window. A window that holds the needed share of a template has a similarity of at least
``0.5 * containment / (1.75 - 0.5 * containment)`` to it (0.296 at 0.8, where the template has over
half of ``c`` shingles); with ``BANDS`` bands of one row it misses the template with probability
below 9e-7, and a template of one shingle with 1.4e-4. Retrieved templates are then verified exactly: the share
of the template's shingles that the window holds.

Only windows that hold enough shingles of any template of their class are sketched. Fewer could
not be verified, so nothing is lost, and most documents are settled by one pass over their words.

Everything is a DataFrame expression. Template shingles are literals of the plan, so their number
is checked against ``MOST_SHINGLES``. ``one`` wraps a value in a generator so that the optimizer
computes it once instead of copying it into each use.

Null text has no words. A document given twice is reported once; rows without id are reported
under a null id. Empty tables give no rows. Extra columns are ignored. A template without
two words is refused.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import pick

BANDS = 40
CONTAINMENT = 0.8
MOST_SHINGLES = 50_000

# Public license notices and texts. Fixed values.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def one(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that later expressions refer to and never copy."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def shingled(df: DataFrame) -> DataFrame:
    """Adds ``h``, the hashes of two-word shingles in order, to a table with ``text``."""
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^a-z0-9\u0080-\x{10ffff}]+")
    df = one(df, "words", F.filter(words, lambda w: w != ""))
    following = F.slice("words", F.lit(2), F.size("words"))
    pairs = F.zip_with(F.slice("words", F.lit(1), F.greatest(F.size("words") - 1, F.lit(0))), following, lambda a, b: F.xxhash64(a, b))
    return one(df, "h", pairs).drop("words", "text")


def among(hashes: list[int]):
    return lambda h: h.isin(hashes)


def spot(hashes: list[int]):
    return lambda h, i: F.when(h.isin(hashes), i)


def covering(width: int, stride: int):
    """Numbers of the windows that cover a place."""
    return lambda i: F.sequence(F.greatest(F.lit(0), F.floor((i - width) / stride) + 1), F.floor(i / stride))


def window(c: int, width: int, stride: int):
    """The distinct shingles of a window, from its number."""
    return lambda p: F.struct(
        F.lit(c).alias("class"), (p * stride).alias("first_word"), F.array_distinct(F.slice("h", (p * stride + 1).cast("int"), F.lit(width))).alias("w")
    )


def holding(hashes: list[int], least: int):
    return lambda x: F.size(F.filter(x["w"], among(hashes))) >= least


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in templates.items()])
    return shingled(spark.range(1).select(F.inline(rows))).select("license", F.array_distinct("h").alias("shingles"))


def sketch(shingles: str) -> Column:
    """The least hash of the shingles under each of the ``BANDS`` hash functions."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, b))))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, license, containment, first_word)``: templates of which a window holds that share.

    ``first_word`` is where the first such window begins.
    """
    spark, templates = docs.sparkSession, TEMPLATES if templates is None else templates
    table = template_table(spark, templates)
    known = {r["license"]: list(r["shingles"]) for r in table.collect()}
    if not all(known.values()) or sum(map(len, known.values())) > MOST_SHINGLES:
        raise ValueError("templates must have two words each and stay within MOST_SHINGLES")
    classes: dict[int, list[str]] = {}
    for name, shingles in known.items():
        classes.setdefault(max(4, 1 << (len(shingles) - 1).bit_length()), []).append(name)
    need = {c: min(ceil(containment * len(known[n]) - 1e-9) for n in names) for c, names in classes.items()}
    of_class = {c: sorted({h for n in names for h in known[n]}) for c, names in classes.items()}
    every = sorted({h for hs in of_class.values() for h in hs})

    docs = shingled(pick(docs, doc_id="doc_id", text="text"))
    docs = one(docs, "hits", F.array_distinct(F.filter("h", lambda h: h.isin(every))))
    docs = docs.where(F.size("hits") >= min(need.values()))
    windows, marks = [], None
    for c, names in sorted(classes.items()):
        own, stride = of_class[c], max(c // 4, 1)
        width = c + stride
        spots = F.filter(F.transform("h", spot(own)), lambda i: i.isNotNull())
        places = F.array_distinct(F.flatten(F.transform(spots, covering(width, stride))))
        found = F.filter(F.transform(places, window(c, width, stride)), holding(own, need[c]))
        # a document with too few shingles of the class has no such window
        enough = F.size(F.filter("hits", among(own))) >= need[c]
        windows.append(F.when(enough, found).otherwise(F.array().cast("array<struct<class:int,first_word:bigint,w:array<bigint>>>")))
        part = table.where(F.col("license").isin(names)).select(F.lit(c).alias("class"), "license", "shingles", F.posexplode(sketch("shingles")).alias("band", "least"))
        marks = part if marks is None else marks.unionByName(part)
    cut = docs.select("doc_id", F.explode(F.concat(*windows)).alias("x")).select("doc_id", "x.*")
    bands = cut.select("*", F.posexplode(sketch("w")).alias("band", "least"))
    share = F.size(F.array_intersect("w", "shingles")) / F.size("shingles")
    out = bands.join(marks, ["class", "band", "least"]).select("doc_id", "license", "first_word", share.alias("containment"))
    out = out.where(F.col("containment") >= containment - 1e-9)
    return out.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.min("first_word").alias("first_word"))
