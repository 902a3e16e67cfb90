"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Texts and license templates are read as lower-case words (letters and digits)
and shingles of ``WIDTH`` words.  Templates longer than ``PIECE`` shingles are
cut into pieces.  A piece of m shingles belongs to the size class s, the power of
two that is at least m; its windows are 3s shingles long and start every s, so
that every place of up to 2s shingles lies whole in one window.

*Retrieval.*  Of a window only the shingles that templates of its class have are
sketched (the others cannot match anything), so a window that holds four fifths
of a piece has a Jaccard similarity of at least 0.1 with it, whatever the text
around it.  Each of ``BANDS`` bands is one min-hash; the two share a band with a
probability of at least 1 - 0.9^BANDS, over 0.9999 for 96.

*Verification.*  For each window and piece that share a band, the exact share of
the piece's shingles (64-bit hashes) that the window holds is computed.  A
license is found in a text when its pieces' best shares, weighted by their
sizes, come to ``threshold`` or more.

Only DataFrame functions are used.  The templates are a list in the job's code,
a few hundred at most, so their shingles can be sent to every task.

Defined results: null and empty texts and texts shorter than WIDTH words have no
license; templates shorter than WIDTH words are not used; several licenses give
several rows; rows that repeat give one result, rows that share an id but not
their text give one each; a null id is kept; an empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 5
PIECE = 64
BANDS = 96

# License notices (name, text) as commonly published.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "BSD-2-Clause-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "ISC-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "GPL-3.0-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
]
# End of fixed values.


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all word shingles of a text, in order; empty if it has fewer words."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(
        F.array(words),
        lambda ws: F.when(F.size(ws) < width, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(ws) - (width - 1)), lambda i: F.xxhash64(F.slice(ws, i, width)))),
    )[0]


def pieces(templates: DataFrame, width: int = WIDTH, piece: int = PIECE) -> DataFrame:
    """(license_id, piece, class, shingles: distinct hashes, share of the template) of templates (license_id, text)."""
    each = templates.select("license_id", F.posexplode(shingles(F.col("text"), width)).alias("at", "h")).withColumn("piece", F.floor(F.col("at") / piece).cast("int"))
    out = each.groupBy("license_id", "piece").agg(F.collect_set("h").alias("piece_set"))
    whole = out.groupBy("license_id").agg(F.sum(F.size("piece_set")).alias("whole"))
    size_class = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("piece_set").cast("double")))).cast("int")
    return out.join(whole, "license_id").select("license_id", "piece", size_class.alias("class"), "piece_set", (F.size("piece_set") / F.col("whole")).alias("share"))


def bands(hashes: Column, n: int = BANDS) -> Column:
    """One min-hash for each band, tagged with its band."""
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda j: F.xxhash64(j, F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, j)))))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: float = 0.8) -> DataFrame:
    """(doc_id, license_id, containment, first_shingle): every license found in every text."""
    known = pieces(docs.sparkSession.createDataFrame(templates, "license_id string, text string"), width)
    wanted = F.broadcast(known.select("class", F.explode("piece_set").alias("h")).distinct())
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("copy"), F.posexplode(shingles(F.col(f"`{text}`"), width)).alias("at", "h"))
    hits = rows.join(wanted, "h")
    last = F.floor(F.col("at") / F.col("class"))
    windows = hits.withColumn("window", F.explode(F.sequence(last - 2, last))).groupBy("doc_id", "copy", "class", "window").agg(F.collect_set("h").alias("window_set"), F.min("at").alias("first"))
    banded = windows.withColumn("band", F.explode(bands(F.col("window_set"))))
    retrieved = banded.join(F.broadcast(known.select("license_id", "piece", "class", F.explode(bands(F.col("piece_set"))).alias("band"))), ["class", "band"])
    candidates = retrieved.groupBy("doc_id", "copy", "class", "window", "license_id", "piece").agg(F.first("window_set").alias("window_set"), F.min("first").alias("first"))
    checked = candidates.join(F.broadcast(known), ["license_id", "piece", "class"]).withColumn("part", F.size(F.array_intersect("window_set", "piece_set")) / F.size("piece_set"))
    best = checked.groupBy("doc_id", "copy", "license_id", "piece", "share").agg(F.max("part").alias("part"), F.min("first").alias("first"))
    found = best.groupBy("doc_id", "copy", "license_id").agg(F.round(F.sum(F.col("part") * F.col("share")), 6).alias("containment"), F.min("first").alias("first_shingle"))
    return found.where(F.col("containment") >= threshold).select("doc_id", "license_id", "containment", F.col("first_shingle").cast("long"))
