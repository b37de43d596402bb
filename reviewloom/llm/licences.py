"""Licence scan: templates found in documents, with DataFrame functions only.

Words are runs of ASCII letters and digits in lower case, shingles runs of five of them. Overlapping windows of
``WINDOW`` shingles, every ``STRIDE``, get MinHash values under ``BANDS`` seeds, one value per band, and every band
key that also stands in the index of the templates retrieves these templates. The templates' windows are
indexed at every position, so a document window that lies inside an unchanged passage of a template equals one
of them and is found in every band; one that shares a part s of its shingles is found with probability
1 - (1 - s)**BANDS, and a template has many windows. A template too short to hold a window at every alignment is
indexed by its single shingles, against the document's single shingles. A retrieved template counts if its
containment, the share of its distinct shingles that the whole document has, is high enough.

Templates are a parameter and a bounded table: their band keys are constants of the expression that filters the
document's windows, so only windows that meet a template ever leave their row.

Defined cases: a null or empty text has no shingles and no match; text and template of less than five words
have none either; rows of one id are one document, null ids too; a template without shingles never matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import materialise, narrowed

WORDS = 5
WINDOW = 4
STRIDE = 2
BANDS = 4
CONTAINMENT = 0.8
# Band keys that may become constants of a plan; a larger collection of templates is refused.
MOST_KEYS = 200_000

# Notices as their licences word them.
TEMPLATES = (
    ("mit-line", "Released under the MIT License."),
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-line", "Licensed under CC BY-NC 4.0."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)

# Splits ASCII text into words; every other byte below 0x80 separates.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def _with_shingles(df: DataFrame) -> DataFrame:
    """Adds ``_sh``, the hashes of all runs of five words in order, as columns built one on the other."""
    words = df.withColumn("_words", F.transform(word_list(F.col("text")), lambda w: F.xxhash64(w)))
    starts = F.when(F.size("_words") >= WORDS, F.sequence(F.lit(0), F.size("_words") - WORDS)).otherwise(F.array().cast("array<int>"))
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WORDS)]))
    return words.withColumn("_sh", hashed).drop("_words")


def _with_keys(df: DataFrame, stride: int, single: Column) -> DataFrame:
    """Adds ``_keys``: a band key for every window and seed, and for every shingle where ``single`` holds."""
    seeded = df.withColumns({f"_s{b}": F.transform("_sh", _seeded(b)) for b in range(BANDS)})
    starts = F.when(F.size("_sh") >= WINDOW, F.sequence(F.lit(1), F.size("_sh") - WINDOW + 1, F.lit(stride)))
    seeded = seeded.withColumn("_at", F.coalesce(starts, F.array().cast("array<int>")))
    # values under different seeds are different hashes, so a value is its own band's key; naming a list a second
    # time, outside the lambda, keeps the optimiser from computing it anew for every window
    lists = [F.when(F.size(f"_s{b}") >= 0, F.transform("_at", _smallest(b))) for b in range(BANDS)]
    lists.append(F.when(single, F.transform("_sh", _seeded(-1))).otherwise(F.array().cast("array<bigint>")))
    return seeded.withColumn("_keys", F.concat(*lists)).drop("_at", *[f"_s{b}" for b in range(BANDS)])


def _seeded(seed: int):
    return lambda h: F.xxhash64(h, F.lit(seed))


def _smallest(band: int):
    return lambda i: F.array_min(F.slice(F.col(f"_s{band}"), i, F.lit(WINDOW)))


def found_licences(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, template, n_shared, n_template, containment) for every template that a document contains.

    ``templates`` has the columns template and text.
    """
    given = narrowed(templates, "template", "text")
    short = F.size("_sh") < WINDOW + STRIDE - 1
    keyed = _with_keys(_with_shingles(given), 1, short)
    index = materialise(keyed.select("template", F.array_distinct("_sh").alias("shingles"), F.array_distinct("_keys").alias("keys")), "templates")
    found = index.select(F.explode("keys").alias("key")).distinct().limit(MOST_KEYS + 1).collect()
    if len(found) > MOST_KEYS:
        raise ValueError(f"the templates have more than {MOST_KEYS} band keys")
    keys = sorted(r.key for r in found)
    by_key = index.select("template", F.explode("keys").alias("key"))
    rows = _with_keys(_with_shingles(narrowed(docs, "doc_id", "text")), STRIDE, F.lit(True))
    met = rows.withColumn("_met", F.array_distinct(F.filter("_keys", lambda x: x.isin(keys))))
    # the outer form, and the filter after it: a filter on the list itself would be pushed below the columns it is made
    # of, and compute them once more. Whole shingle lists go on only for the rows that met a template.
    hit = met.select("doc_id", "_sh", F.explode_outer("_met").alias("key")).where(F.col("key").isNotNull())
    hit = hit.withColumn("own", F.array_distinct("_sh")).drop("_sh")
    # both tables of the templates are bounded by their keys
    pairs = hit.join(F.broadcast(by_key), "key").select("doc_id", "own", "template").distinct()
    shared = pairs.join(F.broadcast(index.select("template", "shingles")), "template").select(
        "doc_id", "template", F.size("shingles").alias("n_template"), F.explode(F.array_intersect("own", "shingles")).alias("shingle")
    )
    counted = shared.distinct().groupBy("doc_id", "template", "n_template").agg(F.count(F.lit(1)).cast("int").alias("n_shared"))
    share = F.col("n_shared") / F.col("n_template")
    return counted.select("doc_id", "template", "n_shared", "n_template", share.alias("containment")).where(F.col("containment") >= containment)
