"""License scan by Dice coefficient over word bigrams.

A text is compared as a whole, line by line and sentence by sentence.  Each unit is
normalised to lower-case words of letters and digits and compared with each licence
template by the Dice coefficient of their sets of word bigrams; a match has at least
``THRESHOLD``.  Only templates whose size allows that are candidates: 2 * min(a, b) /
(a + b) must reach the threshold.

Before that a text is passed over when it cannot match.  A match at threshold t holds
at least the share t / (2 - t) of a template's bigrams.  Words that touch more bigrams
than may be missing are the template's key words: a match must hold one of them, so a
text without any key word of any template has no match.

Only DataFrame functions, inside one scan and without a shuffle.

Defined results: texts that are null, empty or without a match have a null license,
score 0.0 and an empty list; rows are independent; equal scores go to the licence
name that comes first; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Common wordings of public licence notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
)
#: Words too common to be key words while others are left.
COMMON = frozenset("a an and any are as at be by for from in is it its of on or the this that to under with you".split())


def words_of(text: str) -> list[str]:
    """The normalised words of a template, as the Spark expression gives them."""
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    w = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def size_bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Sizes that a unit of a match with a template of n bigrams can have."""
    slack = 1e-9
    return (math.ceil(n * threshold / (2 - threshold) - slack), math.floor(n * (2 - threshold) / threshold + slack))


def key_words(text: str, threshold: float = THRESHOLD) -> list[str]:
    """Words one of which every match must hold.

    The smallest unit that can match has low = n t / (2 - t) bigrams and must share at
    least t (low + n) / 2 = low of them, so at most n - low of the template's may be
    missing; a unit without these words misses more than that.
    """
    pairs = bigrams_of(text)
    missing = len(pairs) - size_bounds(len(pairs), threshold)[0]
    order = sorted(dict.fromkeys(words_of(text)), key=lambda w: (w in COMMON, w.isdigit(), -len(w), w))
    chosen: list[str] = []
    while sum(any(w in p.split() for w in chosen) for p in pairs) <= missing:
        chosen.append(order[len(chosen)])
    return chosen


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _units(text: Column) -> Column:
    """The whole text, its lines, and its sentences."""
    sentences = F.regexp_replace(text, r"([.!?;])[\x20\x09-\x0D]+", "$1\n")
    return F.concat(F.array(text), F.split(text, "\n"), F.split(sentences, "\n"))


def scan(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, license, score, licenses) of each row: the best match, and all licences matched."""
    keys = sorted({w for _, t in templates for w in key_words(t, threshold)})
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    maybe = F.arrays_overlap(F.split(_normal(F.col("text")), " "), F.array(*map(F.lit, keys)))
    nothing = F.array().cast("array<array<string>>")
    rows = rows.withColumn("maybe", maybe).withColumn(
        "words",
        F.when(F.col("maybe"), F.array_distinct(F.transform(_units(F.col("text")), lambda u: F.split(_normal(u), " "))))
        .otherwise(nothing),
    ).drop("text")

    def pairs(w):
        return F.array_distinct(F.zip_with(
            F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b)
        ))

    rows = rows.withColumn("units", F.when(F.col("maybe"), F.transform("words", pairs)).otherwise(nothing)).drop("words")

    def dice(template: str) -> Column:
        own = bigrams_of(template)
        low, high = size_bounds(len(own), threshold)
        candidates = F.filter("units", lambda u: F.size(u).between(low, high))
        literal = F.array(*map(F.lit, own))
        scores = F.transform(
            candidates, lambda u: 2.0 * F.size(F.array_intersect(u, literal)) / (F.size(u) + F.lit(len(own)))
        )
        return F.coalesce(F.array_max(scores), F.lit(0.0))

    # sorted by score downwards, then by name
    found = F.array(*[F.struct((-dice(t)).alias("minus"), F.lit(n).alias("name")) for n, t in templates])
    matches = F.array_sort(F.filter(found, lambda m: m["minus"] <= -threshold))
    rows = rows.select(
        "doc_id",
        F.when(F.col("maybe"), matches).otherwise(F.array().cast("array<struct<minus:double,name:string>>")).alias("m"),
    )
    return rows.select(
        "doc_id",
        F.get("m", F.lit(0))["name"].alias("license"),
        F.coalesce(-F.get("m", F.lit(0))["minus"], F.lit(0.0)).alias("score"),
        F.array_join(F.array_sort(F.array_distinct(F.col("m")["name"])), ",").alias("licenses"),
    )
