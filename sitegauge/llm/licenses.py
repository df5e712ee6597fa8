"""Licence notices in texts, found with MinHash bands over overlapping windows, in DataFrame functions.

Texts are cut into shingles of five words.  Windows of twice a block of shingles, one block apart, hold every run of a
block whole; a template's blocks therefore have a Jaccard similarity to one of the windows of at least a known value, and
so many one-row bands are taken that they meet with high probability.  What the bands retrieve is verified exactly: the
share of the template's shingles that the text holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.llm.common import OWN, staged, whole_text

#: Notices as their publishers word them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-short": "Released under the MIT License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "all-rights-reserved": "All rights reserved. No part of this publication may be reproduced",
}
SHINGLE, CONTAINED = 5, 0.8
#: One-row bands.  A template of three shingles in a window of sixteen has similarity 3/16: 1 - (13/16)**48 > 0.9999.
BANDS = 48
#: Block sizes, and the largest template (in shingles) of each but the last.
BLOCKS, UP_TO = (2, 8), (2,)
TOKEN = r"[\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def shingles_of(words: Column) -> Column:
    """Five words each, joined by spaces; of a shorter text all words; of none nothing."""
    joined = F.transform(words, lambda _, i: F.concat_ws(" ", F.slice(words, i + 1, SHINGLE)))
    return F.slice(joined, 1, F.when(F.size(words) == 0, 0).otherwise(F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1))))


def anchor(template: str) -> str:
    """A word that every text holding the asked share of the template's shingles must contain.

    It stands in more of the shingles than may be missing; of such words the longest is taken.
    """
    words = "".join(c if c.isalnum() else " " for c in template.lower()).split()
    shingles = [words[i:i + SHINGLE] for i in range(max(1, len(words) - SHINGLE + 1))]
    needed = [w for w in set(words) if sum(w in s for s in shingles) > (1 - CONTAINED) * len(shingles) + 1e-9]
    return max(needed, key=lambda w: (len(w), w))


def block_of(shingles: Column) -> Column:
    """Block size for a template."""
    size = F.size(shingles)
    return reduce(lambda rest, pair: F.when(size <= pair[1], pair[0]).otherwise(rest), list(zip(BLOCKS, UP_TO, strict=False))[::-1], F.lit(BLOCKS[-1]))


def band_keys(window: Column) -> Column:
    """One minimum of a window's hashes under each of the bands' hash functions."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.array_min(F.transform(window, lambda h: F.xxhash64(h, b))))


def banded(df: DataFrame, size: Column, step: Column, *keep: str) -> DataFrame:
    """keep, band, key of every window of `size` hashes, `step` apart, of the column hashes."""
    starts = F.sequence(F.lit(1), F.greatest(F.size("hashes"), F.lit(1)), step)
    windows = df.where(F.size("hashes") > 0).select(*keep, F.explode(F.transform(starts, lambda i: F.slice("hashes", i, size))).alias("window"))
    return windows.select(*keep, F.posexplode(band_keys(F.col("window"))).alias("band", "key"))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = spark.createDataFrame(sorted(templates.items()), "license string, notice string")
    return rows.select("license", F.array_distinct(shingles_of(words_of(F.col("notice")))).alias("parts"))


def find_licenses(documents: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_licenses, licenses (sorted, joined by commas) of every row.

    A template counts as found if the text holds at least 80 % of its distinct shingles.  Texts without any template's
    anchor word cannot hold that much and take no part in the search.  Null and empty texts have no licence; repeated
    rows are each answered; null ids stay null; an empty table gives no rows; other columns are ignored.
    The number of templates is that of the argument, so their bands are a table of known size.
    """
    spark, templates = documents.sparkSession, templates or TEMPLATES
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    lowered = F.lower("text")
    possible = reduce(Column.__or__, [lowered.contains(a) for a in sorted({anchor(t) for t in templates.values()})])
    searched = staged(
        narrow.where(possible).select("doc_id", F.monotonically_increasing_id().alias("row"), words_of(F.col("text")).alias("words")), "license-texts")

    hashed = searched.select("row", F.transform(shingles_of(F.col("words")), lambda s: F.xxhash64(s)).alias("hashes"))
    known = template_table(spark, templates)
    template_hashes = known.select("license", block_of(F.col("parts")).alias("block"), F.transform("parts", lambda s: F.xxhash64(s)).alias("hashes"))
    template_bands = banded(template_hashes, F.col("block"), F.col("block"), "license", "block")
    text_bands = reduce(DataFrame.unionByName, [
        banded(hashed.withColumn("block", F.lit(b)), F.lit(2 * b), F.lit(b), "row", "block") for b in BLOCKS])
    retrieved = text_bands.join(F.broadcast(template_bands), ["block", "band", "key"]).select("row", "license").distinct()

    verified = (
        searched.join(retrieved, "row").join(F.broadcast(known), "license")
        .where(F.size(F.array_intersect("parts", shingles_of(F.col("words")))) >= F.ceil(F.size("parts") * CONTAINED - 1e-9))
        .groupBy("row").agg(F.sort_array(F.collect_set("license")).alias(f"{OWN}found")))
    found = F.coalesce(F.col(f"{OWN}found"), F.array().cast("array<string>"))
    answered = searched.select("row", "doc_id").join(verified, "row", "left").select(
        "doc_id", F.size(found).cast("long").alias("n_licenses"), F.array_join(found, ",").alias("licenses"))
    rest = narrow.where(~possible).select("doc_id", F.lit(0).cast("long").alias("n_licenses"), F.lit("").alias("licenses"))
    return answered.unionByName(rest)


def oracle(templates: dict[str, str] | None = None) -> str:
    """SQL for the same rows: every shingle of every text against every template's."""
    values = ", ".join(f"('{k}', '{v}')" for k, v in sorted((templates or TEMPLATES).items()))
    return f"""
WITH l(license, notice) AS (VALUES {values}),
lw AS (SELECT license, regexp_extract_all(lower(notice), '[\\p{{L}}\\p{{N}}]+') AS w FROM l),
ls AS (SELECT DISTINCT license, array_to_string(w[i:i + 4], ' ') AS s FROM lw, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
ds AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT license, count(*) AS n FROM ls GROUP BY license),
m AS (SELECT r, license FROM ds JOIN ls USING (s) JOIN n USING (license) GROUP BY r, license, n HAVING count(*) >= ceil(n * {CONTAINED} - 1e-9)),
f AS (SELECT r, count(*) AS c, string_agg(license, ',' ORDER BY license) AS a FROM m GROUP BY r)
SELECT doc_id, coalesce(c, 0)::BIGINT AS n_licenses, coalesce(a, '') AS licenses FROM d LEFT JOIN f USING (r)
"""
