"""License scan: MinHash bands of overlapping text windows retrieve templates, exact containment verifies them.

Texts and templates are runs of letters and digits in lower case, and sets of
three-word shingles. For each template length t windows have t + t/4 words and
start at every (t/4)-th word, so some window holds any occurrence whole and has
a Jaccard similarity of 0.5 or more with its template, also where a fifth of
the shingles differs. With 20 bands of 2 rows such a window meets its template
with a probability of 1 - (1 - 0.5 ^ 2) ^ 20 = 0.997. A retrieved template is
reported if ``min_containment`` of its shingles are in the window, and all
shingles of its telling phrase, which is what sets it apart from templates that
are alike ("version 2", "Lesser", "Affero"); an empty phrase asks for nothing.

A window without any shingle of any template cannot contain one; such windows,
nearly all, are left out before signatures are computed. Documents are scanned
where they are read; only rows of found licenses are shuffled. Templates are a
parameter; their bands are broadcast up to ``BROADCAST_TEMPLATES`` of them and
joined as the optimizer sees fit beyond that. Null and empty texts have no
license, long ones are scanned whole; rows that repeat an id are reported
together, and of windows that contain a template equally well the first counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import let


SHINGLE, BANDS, ROWS = 3, 20, 2
BROADCAST_TEMPLATES = 1000

Template = tuple[str, str, str]  # license, text, telling phrase

# Notices and grants of public licenses, and what tells each from the others.
NOTICES = (
    ("MIT", "Released under the MIT License", "the MIT License"),
    ("MIT", "Licensed under the MIT License", "the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ""),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0", "Apache License Version 2.0"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2", "Public License version 2"),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3", "Public License version 3"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "the GNU General Public"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "GNU Lesser General Public"),
    ("AGPL", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "GNU Affero General Public"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ""),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software", ""),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0", "Eclipse Public License 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain", ""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License v 2.0"),
    ("CC0-1.0", "Licensed under CC0 1.0", "under CC0 1.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0", "CC BY SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0", "CC BY NC 4.0"),
    ("all-rights-reserved", "All rights reserved", ""),
)
# Identifiers that machine-readable tags name.
TAGGED = ("MIT", "ISC", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "EPL-2.0", "Unlicense", "MPL-2.0", "CC0-1.0", "CC-BY-4.0")
TEMPLATES: tuple[Template, ...] = NOTICES + tuple((name, f"SPDX-License-Identifier: {name}", f"SPDX-License-Identifier: {name}") for name in TAGGED)


def plain_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words: Column) -> Column:
    """Hash of the shingle that starts at each word."""

    def of(listed: Column) -> Column:
        n = F.size(listed) - SHINGLE + 1
        hashed = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(listed, i, SHINGLE)))
        return F.when(n < 1, F.array().cast("array<bigint>")).otherwise(hashed)

    return let(words, of)


def band_hashes(window: Column) -> Column:
    """One hash for each band of the window's MinHash signature, as (band, hash) structs."""

    def least(j: int) -> Column:
        return F.array_min(F.transform(window, lambda s: F.xxhash64(s, F.lit(j))))

    return F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(*[least(b * ROWS + r) for r in range(ROWS)]).alias("hash")) for b in range(BANDS)])


def window_shape(length: int) -> tuple[int, int]:
    """Words and stride of the windows for templates of ``length`` words."""
    return length + -(-length // 4), max(1, length // 4)


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, min_containment: float = 0.8) -> DataFrame:
    """(doc_id, license, containment, start): the best window of each license found, start counted in words."""
    spark = docs.sparkSession
    listed = spark.createDataFrame(list(templates), "license string, template string, telling string").withColumn("words", plain_words(F.col("template")))
    known = listed.select("license", F.size("words").alias("length"), F.array_distinct(shingles(F.col("words"))).alias("set"), F.array_distinct(shingles(plain_words(F.col("telling")))).alias("telling"))
    rows = known.collect()  # the templates, hashed as texts are
    if any(r["length"] < SHINGLE for r in rows):
        raise ValueError(f"a template needs {SHINGLE} words")
    if any(set(r["telling"]) - set(r["set"]) for r in rows):
        raise ValueError("a telling phrase must be part of its template")
    wanted = sorted({s for r in rows for s in r["set"]})

    hashed = docs.select("doc_id", shingles(plain_words(F.col("text"))).alias("all"))
    hit = hashed.where(F.arrays_overlap("all", F.lit(wanted)))
    hits = hit.withColumn("at", F.filter(F.transform("all", lambda s, i: F.when(s.isin(wanted), i)), lambda i: i.isNotNull()))

    def starts(length: int) -> Column:
        """Starts of the windows that hold a hit; window starts are multiples of the stride."""
        size, stride = window_shape(length)
        reach = (size - SHINGLE) // stride + 1
        near = F.flatten(F.transform("at", lambda i: F.transform(F.sequence(F.lit(0), F.lit(reach)), lambda k: (F.floor(i / stride) - k) * stride)))
        return F.transform(F.filter(F.array_distinct(near), lambda s: s >= 0), lambda s: F.struct(F.lit(length).alias("length"), F.lit(size).alias("size"), s.cast("int").alias("start")))

    lengths = sorted({r["length"] for r in rows})
    windows = hits.select("doc_id", "all", F.explode(F.flatten(F.array(*map(starts, lengths)))).alias("w"))
    windows = windows.select("doc_id", "w.length", "w.start", F.array_distinct(F.slice("all", F.col("w.start") + 1, F.col("w.size") - SHINGLE + 1)).alias("window")).where(F.size("window") > 0)
    banded = windows.select("doc_id", "length", "start", "window", F.explode(band_hashes(F.col("window"))).alias("b")).select("doc_id", "length", "start", "window", "b.band", "b.hash")
    index = known.select("license", "length", "set", "telling", F.explode(band_hashes(F.col("set"))).alias("b")).select("license", "length", "set", "telling", "b.band", "b.hash")
    retrieved = banded.join(F.broadcast(index) if len(rows) <= BROADCAST_TEMPLATES else index, ["length", "band", "hash"])
    told = F.size(F.array_except("telling", "window")) == 0
    share = F.size(F.array_intersect("window", "set")) / F.size("set")
    verified = retrieved.where(told).select("doc_id", "license", "start", share.alias("containment")).where(F.col("containment") >= min_containment)
    best = verified.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.min(F.struct(-F.col("containment"), F.col("start"))).alias("first"))
    return best.select("doc_id", "license", "containment", F.col("first.start").cast("bigint").alias("start"))
