"""License scan: MinHash bands over overlapping windows, verified by exact containment.

Column expressions only. A text's words are lower-cased runs of letters and
digits; a shingle is five of them. For a template of L words, windows of about
2 L words begin every L words, so every occurrence lies whole in one window.
Its Jaccard similarity with that window is then at least :func:`least_jaccard`,
and :func:`bands` takes as many one-row bands (MinHash functions) as make a
collision at least as likely as ``1 - MISS``. Windows that share a band with a
template are candidates; one counts as a match when it holds at least
``CONTAINED`` of the template's shingles, counted exactly.

A window without any shingle of any template can't share a band with one (the
value that two bands share is the hash of a shingle both have), so bands are
computed only where a text has such a shingle. That first test is one pass
over the scan's rows without a shuffle; what follows it are the few windows
it leaves. The templates are a small fixed table.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K, CONTAINED, MISS = 5, 0.8, 1e-5
#: Window lengths in words; a template takes the smallest that is twice its own length at least.
LENGTHS = [12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512]

#: License notices, by SPDX name.
TEMPLATES = {
    "Apache-2.0/short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0/warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT/short": "Released under the MIT License.",
    "MIT/licensed": "Licensed under the MIT License.",
    "MIT/grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MIT/warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "GPL-3.0/short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL/header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "BSD/grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC/grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MPL-2.0/header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0/short": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0/short": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0/short": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0/short": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense/short": "This is free and unencumbered software released into the public domain.",
}
WORD = r"[\p{L}\p{N}]+"


def word_count(text: str) -> int:
    return len(re.findall(r"[^\W_]+", text.lower()))


def window_of(length: int) -> int:
    """Window length for a template of so many words."""
    return next((w for w in LENGTHS if w >= 2 * length), 2 * length + length % 2)


def least_jaccard(length: int) -> float:
    """Least similarity of a template with the full window that has ``CONTAINED`` of its shingles."""
    own, window = length - K + 1, window_of(length) - K + 1
    met = math.ceil(CONTAINED * own)
    return met / (own + window - met)


def bands(length: int) -> int:
    """One-row bands after which such a window is missed with a chance of at most ``MISS``."""
    return math.ceil(math.log(MISS) / math.log(1 - least_jaccard(length)))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _shingle(w: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(w, i + j) for j in range(K)])


def _places(w: Column) -> Column:
    """Where shingles begin, from 0; none in a text of fewer than K words."""
    return F.when(F.size(w) >= K, F.sequence(F.lit(0), F.size(w) - K)).otherwise(F.array().cast("array<int>"))


def _bind(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingles(text: Column) -> Column:
    return _bind(words(text), lambda w: F.transform(_places(w), lambda i: _shingle(w, i)))


def _minhashes(s: Column, n: int) -> Column:
    """The smallest of n seeded hashes of the shingles, one per band."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda b: F.array_min(F.transform(s, lambda x: F.xxhash64(x, b))))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``(doc_id, license, containment, start_word, n_windows)`` per document row and template matched.

    ``containment`` is the largest share of the template's distinct shingles in
    one window, ``start_word`` the first word of the first such window. Null,
    empty and very short texts match nothing. Repeated rows are reported each;
    columns other than ``doc_id`` and ``text`` are ignored. Templates need five
    words at least.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    if short := [n for n, t in templates.items() if word_count(t) < K]:
        raise ValueError(f"templates of fewer than {K} words: {short}")
    rows = [(n, t, window_of(word_count(t)), bands(word_count(t))) for n, t in templates.items()]
    known = spark.createDataFrame(rows, "license string, text string, window int, bands int")
    known = known.select("license", "window", "bands", F.array_distinct(shingles(F.col("text"))).alias("own"))
    own = sorted({s for r in known.select("own").collect() for s in r["own"]})
    most = max((r[3] for r in rows), default=1)
    sizes = sorted({r[2] for r in rows}) or [LENGTHS[0]]

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    may = _bind(words(F.col("text")), lambda w: F.exists(_places(w), lambda i: _shingle(w, i).isin(own) if own else F.lit(False)))
    some = docs.where(may).select(F.monotonically_increasing_id().alias("row"), "doc_id", shingles(F.col("text")).alias("s"))
    places = F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda i: F.get(F.col("s"), i).isin(own) if own else F.lit(False))

    def windows(size: int) -> Column:
        step = size // 2
        begins = F.flatten(F.transform(places, lambda p: F.sequence(F.greatest(F.lit(0), F.ceil((p + K - size) / step).cast("int")), F.floor(p / step).cast("int"))))
        return F.transform(F.array_distinct(begins), lambda b: F.struct(F.lit(size).alias("window"), (b * step).alias("start")))

    at = some.select("row", "doc_id", "s", F.explode(F.flatten(F.array(*map(windows, sizes)))).alias("w"))
    cut = at.select("row", "doc_id", "w.window", "w.start", F.array_distinct(F.slice("s", F.col("w.start") + 1, F.col("w.window") - K + 1)).alias("part"))
    band = cut.select("*", F.posexplode(_minhashes(F.col("part"), most)).alias("band", "value"))
    theirs = known.select("license", "window", "own", F.posexplode(F.slice(_minhashes(F.col("own"), most), F.lit(1), F.col("bands"))).alias("band", "value"))
    met = band.join(F.broadcast(theirs), ["window", "band", "value"])  # a fixed table: templates times bands
    met = met.select("row", "doc_id", "license", "start", (F.size(F.array_intersect("part", "own")) / F.size("own")).alias("containment")).distinct()
    met = met.where(F.col("containment") >= CONTAINED)
    best = met.groupBy("row", "doc_id", "license").agg(F.max("containment").alias("containment"), F.min("start").cast("long").alias("start_word"), F.count("*").alias("n_windows"))
    return best.select("doc_id", "license", "containment", "start_word", "n_windows")


def scan_sql() -> str:
    """DuckDB statement of the same matches over ``documents``, by looking into every window."""
    values = ", ".join(f"('{n}', '{t.replace(chr(39), chr(39) * 2)}', {window_of(word_count(t))})" for n, t in TEMPLATES.items())
    grams = f"CASE WHEN len(w) < {K} THEN [] ELSE list_transform(range(1, len(w) - {K - 2}), lambda i: array_to_string(w[i:i + {K - 1}], ' ')) END"
    return f"""
WITH t AS (SELECT license, size, list_distinct({grams}) AS own FROM (SELECT license, size, regexp_extract_all(lower(body), '{WORD}') AS w FROM (VALUES {values}) v(license, body, size))),
term AS (SELECT license, size, len(own) AS n, unnest(own) AS g FROM t),
d AS (SELECT doc_id, {grams} AS s FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents)),
item AS (SELECT doc_id, unnest(s) AS g, unnest(range(0, len(s))) AS p FROM d),
hit AS (SELECT i.doc_id, i.p, t.license, t.size, t.n, t.g FROM item i JOIN term t USING (g)),
win AS (SELECT doc_id, license, n, g, unnest(range(greatest(0, ceil((p + {K} - size) / (size / 2))::BIGINT), (p // (size // 2)) + 1)) * (size // 2) AS start FROM hit),
met AS (SELECT doc_id, license, start, count(DISTINCT g) / max(n) AS containment FROM win GROUP BY ALL HAVING count(DISTINCT g) >= {CONTAINED} * max(n))
SELECT doc_id, license, max(containment) AS containment, min(start)::BIGINT AS start_word, count(*) AS n_windows FROM met GROUP BY doc_id, license"""
