"""License scans by MinHash bands over overlapping text windows.

Templates are short public license notices. Texts and templates are cut into windows of
WINDOW shingles (five words, lower case), one at every word; a template with fewer
shingles is one window of its own size. A window's key in a band is the least of its
shingle hashes in that band's order, so equal windows always meet, and windows of
similarity s miss each other in all bands with probability (1 - s)^BANDS.

A passage that holds 80 % of a template's shingles leaves a run of four of them intact:
an edit inside takes four shingles or more away and a missing end takes any number, so
20 % of m shingles allow m / 20 inner edits, and the longest of the runs left has four
shingles for every m. Such a run is a window equal to one of the template's, which is
met with certainty. Each meeting gives an alignment; the shingles of the aligned passage
and of MARGIN words on both its sides are compared exactly, so up to MARGIN words put into
a license leave all of its other shingles in sight. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm.tables import text_key

WORDS = 5
WINDOW = 4
BANDS = 3
PERCENT = 80
MARGIN = 32
"""Words on both sides of an aligned passage that count with it."""
MOST_TEMPLATE_WORDS = 20_000
"""All templates together; their windows are literals of the plan."""

# Wordings of public license notices.
_CREATIVE_COMMONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}


def _creative_commons() -> dict[str, str]:
    """The short and long wordings of the family; CC-BY-4.0 with "the" stands below."""
    found = {"CC0-1.0 notice": "Licensed under CC0 1.0 Universal.", "CC0-1.0 short notice": "Released under the CC0 1.0 license."}
    for short, long in _CREATIVE_COMMONS.items():
        name = f"CC-{short}-4.0"
        found[f"{name} notice"] = f"Licensed under CC {short} 4.0."
        found[f"{name} work notice"] = f"This work is licensed under CC {short} 4.0."
        found[f"{name} long"] = f"This work is licensed under a Creative Commons {long} 4.0 International License."
        if name != "CC-BY-4.0":
            found[name] = f"This work is licensed under the Creative Commons {long} 4.0 International License."
    return found


TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except"
        " in compliance with the License."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met"
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT conditions": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software."
    ),
    "Apache-2.0 body": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or"
        " implied."
    ),
    "BSD-2-Clause conditions": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer."
    ),
    "BSD-3-Clause conditions": (
        "may be used to endorse or promote products derived from this software without specific prior written"
        " permission."
    ),
    "GPL-2.0": (
        "either version 2 of the License, or (at your option) any later version."
    ),
    "GPL-3.0": (
        "either version 3 of the License, or (at your option) any later version."
    ),
    "GPL-3.0 body": (
        "The GNU General Public License is a free, copyleft license for software and other kinds of works."
    ),
    "LGPL": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
        " published by the Free Software Foundation"
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the"
        " License, or (at your option) any later version."
    ),
    "LGPL-3.0 body": (
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3"
        " of the GNU General Public License, supplemented by the additional permissions listed below."
    ),
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL": (
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as"
        " published by the Free Software Foundation"
    ),
    "AGPL-3.0 body": (
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works,"
        " specifically designed to ensure cooperation with the community in the case of network server software."
    ),
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all"
        " copies."
    ),
    "MPL-2.0 body": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at"
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public"
        " License"
    ),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors"
        " be held liable for any damages arising from the use of this software."
    ),
    "CC0-1.0": "has waived all copyright and related or neighboring rights to",
    **_creative_commons(),
}

_ORDERS = [0x0123456789ABCDEF, 0x7EDCBA9876543210, 0x3C3C5A5A69699696]
"""What a shingle hash is XORed with to get its place in a band's order."""


def words(text: Column) -> Column:
    """Lower-case words of a text; none for a null or blank one."""
    bare = F.btrim(F.lower(text), F.lit(" \t\n\x0b\x0c\r"))
    none = F.array().cast("array<string>")
    return F.when(text.isNull() | (bare == ""), none).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


_SHINGLES = (
    f"transform(if(size({{0}}) >= {WORDS}, sequence(0, size({{0}}) - {WORDS}), cast(array() AS array<int>)),"
    f" i -> {{1}})"
)


def shingle_hashes(name: str) -> Column:
    parts = ", ".join(f"{name}[i + {k}]" for k in range(WORDS))
    return F.expr(_SHINGLES.format(name, f"xxhash64({parts})"))


def shingles(name: str) -> Column:
    return F.expr(_SHINGLES.format(name, f"array_join(slice({name}, i + 1, {WORDS}), ' ')"))


def _key(size: int, band: int) -> str:
    """SQL for the key of the window of ``size`` shingles at i of the hashes h."""
    parts = [f"(h[i + {k}] ^ {_ORDERS[band]}L)" for k in range(size)]
    return parts[0] if size == 1 else f"least({', '.join(parts)})"


def _classes(size: int) -> list[tuple[int, int]]:
    """(window size, band) of what a template of so many shingles is found by."""
    return [(WINDOW, b) for b in range(BANDS)] if size >= WINDOW else [(size, 0)]


def _template_windows(templates: DataFrame) -> DataFrame:
    """(license, size, band, key, at) of all windows of templates (license, shingles, h)."""
    parts = []
    for size in range(1, WINDOW + 1):
        fits = F.size("h") == size if size < WINDOW else F.size("h") >= size
        for _, band in _classes(size):
            keys = F.expr(
                f"transform(sequence(0, size(h) - {size}), i -> named_struct('at', i, 'key', {_key(size, band)}))"
            )
            found = templates.filter(fits).withColumn("w", F.explode(keys))
            parts.append(found.select("license", F.lit(size).alias("size"), F.lit(band).alias("band"), "w.key", "w.at"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, text_key, license, containment, first_word): the licenses in each text,
    with the share of the template's shingles in the best passage and its MARGIN, and where
    it begins.

    docs: doc_id, text, and any other columns, which are ignored. A null, empty or short
    text holds nothing. Rows that repeat a doc_id and its text count as one document; of
    equally good passages the first counts that needs no margin, or else the first. An empty
    table gives an empty one.
    """
    spark = docs.sparkSession
    if sum(len(t.split()) for t in templates.values()) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"more than {MOST_TEMPLATE_WORDS} words of templates")
    if any(len(t.split()) < WORDS for t in templates.values()):
        raise ValueError(f"a template needs {WORDS} words")
    pairs = [F.struct(F.lit(k).alias("license"), F.lit(v).alias("wording")) for k, v in templates.items()]
    rows = spark.range(1).select(F.inline(F.array(*pairs)))
    known = (
        rows.withColumn("words", words(F.col("wording")))
        .withColumn("h", shingle_hashes("words"))
        .withColumn("wanted", F.array_distinct(shingles("words")))
        .withColumn("length", F.size("words"))
    )
    windows = _template_windows(known).join(known.select("license", "wanted", "length"), "license")
    keys: dict[tuple, set] = {}
    for size, band, key in _template_windows(known).select("size", "band", "key").distinct().collect():
        keys.setdefault((size, band), set()).add(key)
    reach = max(len(t.split()) for t in templates.values()) + MARGIN

    cut = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), words(F.col("text")).alias("words")
    ).withColumn("h", shingle_hashes("words"))
    found = []
    for (size, band), some in sorted(keys.items()):
        met = f"{_key(size, band)} IN ({', '.join(f'{k}L' if k != -(2**63) else '-9223372036854775808' for k in sorted(some))})"
        # only a window that lies within the text: least() would skip the nulls beyond
        inside = "true" if size == 1 else f"i + {size} <= size(h)"
        found.append(f"if({inside} AND {met}, {size * 16 + band}, null)")
    hits = F.expr(
        "filter(flatten(transform(if(size(h) > 0, sequence(0, size(h) - 1), cast(array() AS array<int>)),"
        f" i -> if({' OR '.join(f'{f} IS NOT NULL' for f in found)},"
        f" transform(array({', '.join(found)}), c -> named_struct('at', i, 'class', c)),"
        " cast(array() AS array<struct<at:int,class:int>>)))), x -> x.class IS NOT NULL)"
    )
    met = (
        cut.withColumn("hits", hits)
        # The outer form: Spark would push a filter on the hits below their parts, and
        # work all of them out anew for each word.
        .withColumn(
            "hit",
            F.explode_outer(
                F.expr(
                    "transform(hits, x -> named_struct('at', x.at, 'size', x.class div 16, 'band', x.class % 16,"
                    f" 'low', greatest(x.at - {reach}, 0),"
                    f" 'near', slice(words, greatest(x.at - {reach}, 0) + 1, {2 * reach + 16}),"
                    f" 'h', slice(h, x.at + 1, {WINDOW})))"
                )
            ),
        )
        .filter("hit IS NOT NULL")
        .select("doc_id", "text_key", "hit.*")
    )
    by_class = [
        f"WHEN size = {size} AND band = {band} THEN {_key(size, band).replace('[i + ', '[')}" for size, band in sorted(keys)
    ]
    keyed = met.withColumn("key", F.expr(f"CASE {' '.join(by_class)} END") if by_class else F.lit(0).cast("long"))
    aligned = (
        keyed.withColumnRenamed("at", "hit_at")
        # at most MOST_TEMPLATE_WORDS * BANDS rows
        .join(F.broadcast(windows), ["size", "band", "key"])
        .withColumn("start", F.greatest(F.col("hit_at") - F.col("at"), F.lit(0)))
        .withColumn(
            "passage",
            F.expr("slice(near, start - low + 1, greatest(least(hit_at - at, 0) + length, 0))"),
        )
        .withColumn("from", F.greatest(F.col("hit_at") - F.col("at") - MARGIN, F.lit(0)))
        .withColumn(
            "around",
            F.expr(f"slice(near, `from` - low + 1, greatest(hit_at - at + length + {MARGIN} - `from`, 0))"),
        )
        .withColumn("held", F.size(F.array_intersect(shingles("around"), F.col("wanted"))))
        .filter(F.col("held") * 100 >= F.size("wanted") * PERCENT)
        .withColumn("whole", F.size(F.array_intersect(shingles("passage"), F.col("wanted"))) == F.col("held"))
    )
    return (
        aligned.groupBy("doc_id", "text_key", "license")
        .agg(
            F.max(
                F.struct(
                    (F.col("held") / F.size("wanted")).alias("containment"), "whole", (-F.col("start")).alias("back")
                )
            ).alias("best")
        )
        .select(
            "doc_id", "text_key", "license", "best.containment", (-F.col("best.back")).cast("long").alias("first_word")
        )
    )
