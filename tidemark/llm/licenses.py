"""License scan, with DataFrame functions only.

Texts become runs of letters and digits in lower case; shingles have three words.  Templates fall
into size classes: class L holds templates of more than L / 2 and at most L shingles, and its windows
are 2 L shingles long, one every L.  A template that stands anywhere in a text thus lies wholly in
one window, with a Jaccard similarity of at least T / (2 L) > 1/4.  With 32 bands of one MinHash
each, the chance that no band collides is below 0.75 ** 32 = 0.0001; with the lowest containment that
counts, 0.8, the similarity is above 1/6 and the chance below 0.3 %.  Every band hashes the shingles
anew together with its number and takes the least value, so the bands are independent.

A collision needs a shingle in common, so texts and windows without any template shingle are left
out first; this changes no result.  Candidates are verified by the share of the template's distinct
word shingles found in the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import from_zero, let, lower_az, shingle_hashes

# Public notice texts.
TEMPLATES = {
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy "
    "of the License at http://www.apache.org/licenses/LICENSE-2.0",
}
TOKEN = r"[\p{L}\p{N}]+"
K, BANDS = 3, 32


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(lower_az(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def size_class(shingles: Column) -> Column:
    """The power of two at or above the number of shingles, at least 4."""
    return F.greatest(F.lit(4), F.pow(F.lit(2.0), F.ceil(F.log2(shingles))).cast("int"))


def min_hashes(hashes: Column) -> Column:
    """Array of (band, value)."""

    def one(band: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))))

    return F.array(*[F.struct(F.lit(j).alias("band"), one(j).alias("value")) for j in range(BANDS)])


def _texts(tokens_: Column) -> Column:
    """The shingles themselves, for verification."""
    return F.transform(
        from_zero(F.size(tokens_) - (K - 1)), lambda i: F.concat_ws(" ", F.slice(tokens_, i + 1, K))
    )


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, size_class, wanted, hashes) of every template; one row per template."""
    listed = F.array(*[F.struct(F.lit(n).alias("license"), F.lit(t).alias("text")) for n, t in templates.items()])
    rows = spark.range(1).select(F.inline(listed)).withColumn("t", tokens(F.col("text")))
    return (
        rows.withColumn("hashes", F.array_distinct(shingle_hashes(F.col("t"), K)))
        .withColumn("wanted", F.array_distinct(_texts(F.col("t"))))
        .select("license", size_class(F.size("hashes")).alias("size_class"), "wanted", "hashes")
    )


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, containment: float = 0.8
) -> DataFrame:
    """One row per document and license found.

    ``doc_id``, ``license``, ``containment`` (best share of the template's shingles in a window),
    ``first_word`` (start of the first such window, in tokens) and ``n_windows``.  Null and empty texts
    match nothing; equal (doc_id, text) rows count once; texts that share a doc_id, or have none, are
    searched each by itself and give one row per license together.  Other columns are not read.  Templates
    need at least three words.
    """
    spark = docs.sparkSession
    known = templates or TEMPLATES
    wanted = template_table(spark, known)
    figures = wanted.select("license", "size_class", F.col("hashes")).collect()  # one row per template
    classes = sorted({r["size_class"] for r in figures})
    of_class = {c: sorted({h for r in figures if r["size_class"] == c for h in r["hashes"]}) for c in classes}
    every = sorted({h for hs in of_class.values() for h in hs})

    def known_array(hashes: list[int]) -> Column:
        return F.array(*[F.lit(h).cast("long") for h in hashes])

    def windows(t: Column, h: Column, c: int) -> Column:
        cut = F.transform(
            from_zero(F.size(h), c),
            lambda i: F.struct(
                F.lit(c).alias("size_class"),
                i.alias("start"),
                F.slice(h, i + 1, 2 * c).alias("h"),
                F.slice(t, i + 1, 2 * c + K - 1).alias("t"),
            ),
        )
        return F.filter(cut, lambda x: F.arrays_overlap(x["h"], known_array(of_class[c])))

    def hit_windows(t: Column, h: Column) -> Column:
        cuts = F.concat(*[windows(t, h, c) for c in classes])
        return F.when(F.arrays_overlap(h, known_array(every)), cuts)

    # one expression from text to windows: as separate columns, a filter would be pushed below the
    # projection and tokens worked out anew for every shingle; "outer" keeps the optimizer from adding
    # such a filter by itself
    cut = let(tokens(F.col("text")), lambda t: let(shingle_hashes(t, K), lambda h: hit_windows(t, h)))
    found = docs.select("doc_id", F.xxhash64("text").alias("row"), F.explode_outer(cut).alias("win"))
    found = found.where("win is not null").select("doc_id", "row", "win.*")
    banded = found.select("doc_id", "row", "size_class", "start", "t", F.inline(min_hashes(F.col("h"))))
    bands = wanted.select("license", "size_class", "wanted", F.inline(min_hashes(F.col("hashes"))))
    hits = banded.join(bands, ["size_class", "band", "value"])
    # one window of one text, whichever band found it
    hits = hits.groupBy("doc_id", "row", "license", "size_class", "start").agg(
        F.first("t").alias("t"), F.first("wanted").alias("wanted")
    )
    share = F.size(F.array_intersect(_texts(F.col("t")), F.col("wanted"))) / F.size("wanted")
    return (
        hits.withColumn("share", share)
        .where(F.col("share") >= containment)
        .groupBy("doc_id", "license")
        .agg(
            F.max("share").alias("containment"),
            F.min("start").cast("long").alias("first_word"),
            F.count(F.lit(1)).alias("n_windows"),
        )
    )
