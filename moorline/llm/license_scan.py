"""License scans over overlapping text windows with exact containment (operator 9), in DataFrame functions only.

A template is a run of words; its shingles are its runs of ``WIDTH`` words. In a text only the
shingles that some template has are of interest. Each joins the templates that have it, and falls
into two overlapping windows of each. Windows are twice as long as the longest template of the
same length class, so that every occurrence lies whole in one, and a short notice isn't put
together from words that lie a whole licence text apart.

Templates are few, so their shingles are counted in every window that has one. MinHash bands in
front of that count would save nothing and lose notices: beside other known shingles a window
may resemble a template in it as little as you like.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moorline.llm.scratch import Scratch

WIDTH = 3
# Template lengths in words up to which the length classes reach; the last class has all longer ones.
CLASSES = (32, 256, 2048)

# Short notices of public licences.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "license_id string, text string")


# Licence texts without their appendix, one per file; and standard headers and identifier lines.
TEXTS = Path(__file__).with_name("license_texts")


def license_texts(spark: SparkSession) -> DataFrame:
    """Templates of whole licence texts (``…/text``), file headers and SPDX lines.

    Short ones have no more words than the longest of :data:`NOTICES`, so that scanned together
    they leave the windows of the notices as they are.
    """
    rows = [(f"{path.stem}/text", path.read_text(encoding="utf-8")) for path in sorted(TEXTS.glob("*.txt"))]
    headers = (TEXTS / "headers.tsv").read_text(encoding="utf-8").splitlines()
    return spark.createDataFrame(rows + [tuple(line.split("\t")) for line in headers], "license_id string, text string")


def _words(text: F.Column) -> F.Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9\x{80}-\x{10FFFF}]+", -1), lambda w: w != "")


def _shingles(words: F.Column) -> F.Column:
    """``(at, shingle)`` of each run of WIDTH words; nothing for fewer words."""
    return F.when(
        F.size(words) >= WIDTH,
        F.transform(F.sequence(F.lit(0), F.size(words) - WIDTH), lambda i: F.struct(
            i.alias("at"), F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)]).alias("shingle")
        )),
    )


def license_scan(
    docs: DataFrame, templates: DataFrame, num: int = 19, den: int = 20, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, license_id, shared, n_shingles, first_word)``: the templates that each text contains.

    Texts are lower-cased; words are runs of a-z, 0-9 and other alphabets. A template is contained where a
    window has ``num`` of ``den`` of its distinct shingles or more; ``shared`` is the largest
    such number of any window, ``first_word`` the place of the first shared shingle there. A
    window has twice as many words as the longest template of the same class of ``CLASSES``, and
    the next one starts halfway. A template of fewer than WIDTH words matches nothing, and null,
    empty and shorter texts contain nothing. Null keys and null template ids take no part; rows
    that repeat a key count as one text, as do templates that repeat an id. Other columns are
    not read.
    """
    scratch = Scratch(docs.sparkSession, "license-scan")
    # Words are a column of their own, or every shingle would split its whole text again.
    split = templates.where("license_id IS NOT NULL").select("license_id", _words(F.col("text")).alias("words"))
    parts = split.select("license_id", F.explode(_shingles(F.col("words"))).alias("part"))
    own = parts.groupBy("license_id").agg(F.collect_set("part.shingle").alias("own"), (F.max("part.at") + WIDTH).alias("length"))
    kind = sum((F.when(F.col("length") > bound, 1).otherwise(0) for bound in CLASSES), F.lit(0))
    # Written, so that its size is known where it is joined.
    known = scratch.save(
        own.select("license_id", "own", F.max("length").over(Window.partitionBy(kind)).cast("long").alias("stride"))
        .select("license_id", F.size("own").cast("long").alias("n_shingles"), "stride", F.explode("own").alias("shingle"))
    )
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), _words(F.col(text)).alias("words"))
    hits = rows.select("id", F.explode(_shingles(F.col("words"))).alias("hit")).select("id", "hit.at", "hit.shingle").join(known, "shingle")
    number = F.floor(F.col("at") / F.col("stride"))
    shared = (
        hits.select("id", "license_id", "n_shingles", F.explode(F.array(number - 1, number)).alias("window"), "at", "shingle")
        .groupBy("id", "window", "license_id", "n_shingles")
        .agg(F.countDistinct("shingle").alias("shared"), F.min("at").alias("first_word"))
    )
    return (
        shared.where(F.col("shared") * den >= F.col("n_shingles") * num)
        .groupBy("id", "license_id", "n_shingles")
        .agg(F.max(F.struct("shared", -F.col("first_word"))).alias("best"))
        .select(F.col("id").alias(key), "license_id", F.col("best.shared").alias("shared"), "n_shingles",
                (-F.col("best.col2")).cast("long").alias("first_word"))
    )
