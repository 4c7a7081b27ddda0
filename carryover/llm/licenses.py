"""License scans: MinHash bands over overlapping windows, then exact containment.

Texts are lower-cased words of letters and digits, in shingles of five.  A
template of ``m`` shingles is cut into parts of ``c`` shingles, ``c`` the greatest of
``CLASSES`` that is at most ``m``, every ``c / 2`` and at its end.  A document is cut into windows of
``1.5 c`` shingles every ``c / 2``, so an occurrence of a part lies wholly in a
window, and their Jaccard similarity is at least 2/3.  Each of ``BANDS`` bands is
one MinHash value: the two share one with probability
``1 - (1/3)**8 > 0.9998``, and still 0.996 at similarity 1/2 (an edited
part).  Parts of one shingle are windows of one shingle and meet for sure.

A window that shares a band value with a part names the template and the
place; the template is matched if at least ``LEAST`` (0.8) of its distinct shingles
stand in the stretch of the document where it would lie, give or take its
length.

At scale, in DataFrame functions only: the scan is per row, without a
shuffle; only windows that hit a band value leave it, and they are joined
with the templates, a table given by the caller whose size does not depend on
the corpus (``MOST_PARTS`` band values at most, else an error).  Matches are
added up per document and template: a line that a third of the documents hold
is still one row each.

Cases: null, empty and short texts (under five words) match nothing; a
template under five words is an error; rows that repeat an id report the best
match of any; null ids are kept; an empty table gives no rows; other columns
are not read; very long texts are scanned whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SHINGLE = 5
CLASSES = (1, 8, 32)
BANDS = 8
LEAST = 0.8
MOST_PARTS = 200_000

#: License notices (fixed values: their public wording).
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def normal_words(text: str) -> str:
    """SQL: words of letters and digits, in lower case."""
    return f"filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w <> '')"


def shingles(words: str) -> str:
    """SQL: hashes of five consecutive words from each place of an array of words."""
    at = ", ".join(f"w[i{f' + {j}' if j else ''}]" for j in range(SHINGLE))
    return f"transform(array({words}), w -> CASE WHEN size(w) >= {SHINGLE} THEN transform(sequence(0, size(w) - {SHINGLE}), i -> xxhash64({at})) ELSE cast(array() as array<bigint>) END)[0]"


def minima(per: int, of: str, item: str) -> str:
    """SQL: the least ``item`` (over ``x``) of each block of ``per`` elements of an array."""
    return f"transform(sequence(0, (size({of}) - 1) DIV {per}), b -> array_min(transform(slice({of}, b * {per} + 1, {per}), x -> {item})))"


def template_parts(spark, templates: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Templates ``license, m, wanted`` (distinct shingles), and band values ``class, value, license, at``."""
    for name, text in templates.items():
        if len(re.findall(r"[^\W_]+", text)) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
    texts = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    whole = texts.withColumn("h", F.expr(shingles(normal_words("text")))).withColumn("m", F.size("h"))
    c = F.lit(CLASSES[0])
    for size in CLASSES[1:]:
        c = F.when(F.col("m") >= size, F.lit(size)).otherwise(c)
    parts = whole.withColumn("class", c).withColumn("at", F.expr("explode(array_union(sequence(0, m - class, greatest(1, class DIV 2)), array(m - class)))"))
    parts = parts.withColumn("part", F.expr("slice(h, at + 1, class)"))
    values = F.expr(
        f"CASE WHEN class = 1 THEN part ELSE transform(sequence(1, {BANDS}), j -> array_min(transform(part, x -> xxhash64(x, j)))) END"
    )
    parts = parts.select("class", F.explode(values).alias("value"), "license", "m", "at").distinct()
    return whole.select("license", F.array_distinct("h").alias("wanted")), parts


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, doc_id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """``doc_id, license, containment, at_word``: the best match of each template in each document."""
    whole, parts = template_parts(docs.sparkSession, templates)
    known = parts.select("class", "value").distinct().limit(MOST_PARTS + 1).collect()
    if len(known) > MOST_PARTS:
        raise ValueError(f"the templates have more than {MOST_PARTS} band values")
    reach = 2 * (whole.agg(F.max(F.size("wanted"))).first()[0] or 0) + 2 * max(CLASSES)
    # columns of their own, each worked out once: shingles, and per band the minima of blocks of half a class
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.expr(shingles(normal_words(f"`{text}`"))).alias("h"))
    step = CLASSES[1] // 2
    none = "cast(array() as array<array<bigint>>)"
    rows = rows.withColumn(f"m{step}", F.expr(f"if(size(h) = 0, {none}, transform(sequence(1, {BANDS}), j -> {minima(step, 'h', 'xxhash64(x, j)')}))"))
    for c in CLASSES[2:]:
        rows = rows.withColumn(f"m{c // 2}", F.expr(f"transform(m{step}, m -> {minima(c // 2 // step, 'm', 'x')})"))

    found = []
    for c in CLASSES:
        values = ", ".join(f"{v}L" if (v := r["value"]) > -(2**63) else "(-9223372036854775807L - 1L)" for r in known if r["class"] == c)
        if not values:
            continue
        if c == 1:
            places = "if(size(h) = 0, cast(array() as array<int>), sequence(0, size(h) - 1))"
            found.append(f"transform(filter({places}, i -> h[i] IN ({values})), i -> struct({c} AS class, i AS place, h[i] AS value))")
        else:
            least_of = "least(m[i], m[least(i + 1, size(m) - 1)], m[least(i + 2, size(m) - 1)])"
            found.append(
                f"flatten(transform(m{c // 2}, m -> transform(filter(sequence(0, size(m) - 1), i -> {least_of} IN ({values})), "
                f"i -> struct({c} AS class, i * {c // 2} AS place, {least_of} AS value))))"
            )
    near = f"slice(h, greatest(0, x.place - {reach}) + 1, {2 * reach + 2 * max(CLASSES)})"
    rows = rows.select("doc_id", "h", F.expr(f"concat({', '.join(found)})").alias("hits"))
    hit = rows.select("doc_id", F.explode(F.expr(f"transform(hits, x -> struct(x.class AS class, x.place AS place, x.value AS value, greatest(0, x.place - {reach}) AS base, {near} AS h))")).alias("hit"))
    hit = hit.select("doc_id", "hit.*")

    # the template would begin about place - at; an occurrence may lie anywhere in the window
    both = hit.join(F.broadcast(parts), ["class", "value"]).join(F.broadcast(whole), "license")
    slack = F.expr("CASE WHEN class = 1 THEN m DIV 4 ELSE class DIV 2 + m DIV 4 END")
    both = both.withColumn("from", F.greatest(F.col("place") - F.col("at") - slack, F.col("base")))
    stretch = F.expr("slice(h, CAST(from - base + 1 AS INT), CAST(m + 2 * CASE WHEN class = 1 THEN m DIV 4 ELSE class + m DIV 4 END AS INT))")
    both = both.withColumn("stretch", stretch)
    share = F.size(F.array_intersect("wanted", "stretch")) / F.size("wanted")
    first = F.expr("from + array_min(filter(transform(wanted, x -> array_position(stretch, x)), p -> p > 0)) - 1")
    both = both.select("doc_id", "license", share.alias("containment"), first.alias("at_word")).where(F.col("containment") >= least)
    best = both.groupBy("doc_id", "license").agg(F.max(F.struct("containment", (-F.col("at_word")).alias("back"))).alias("best"))
    return best.select("doc_id", "license", F.col("best.containment").alias("containment"), (-F.col("best.back")).cast("long").alias("at_word"))
