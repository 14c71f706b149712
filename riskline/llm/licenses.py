"""License scans: TF-IDF cosine to templates, then inheritance from the nearest directory.

A file's licence text is its lines with a licence cue, or all of a licence file.  Term
weights are tf * idf, idf over all licence texts and templates; the vectors stay sparse
(one row per file and term).  A file without a licence of its own takes that of the licence
file in its nearest ancestor directory, found by joining directories with their ancestors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.llm.common import staged, text_or_empty, word_count

#: Cosine from which a template counts as found.
THRESHOLD = 0.5
TERM = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
CUE = "(?i)licen[sc]|copyright|copyleft|spdx|public domain|creative commons|released under|permission is hereby"

# Usual notices of public licences, as (licence id, notice).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license. Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0 Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0 Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]


def templates_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    return spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(templates)], "template int, license string, notice string")


def terms(text):
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), 1)


def own_licenses(files: DataFrame, spark: SparkSession, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(row_key, own_license, score) of the files whose licence text is near a template.

    ``files``: row_key, text, is_license_file.  Equal scores: the smallest licence id.
    """
    text = text_or_empty("text")
    lines = F.array_join(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(CUE)), "\n")
    notice = F.when(F.col("is_license_file"), text).otherwise(lines)
    said = files.select("row_key", notice.alias("notice")).where(F.col("notice").rlike(CUE))
    tf = staged(said.select("row_key", F.explode(terms(F.col("notice"))).alias("term")).groupBy("row_key", "term").agg(F.count("*").alias("tf")), "tf")
    shelf = templates_table(spark, templates)
    t_tf = shelf.select("template", "license", F.explode(terms(F.col("notice"))).alias("term")).groupBy("template", "license", "term").agg(F.count("*").alias("t_tf"))
    n = tf.select("row_key").distinct().count() + len(templates)
    df = tf.select("term").unionAll(t_tf.select("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = df.select("term", (F.log(F.lit(float(n)) / F.col("df")) + F.lit(1.0)).alias("idf"))
    # Template vectors: a fixed table, so its broadcast is bounded.
    t_vec = t_tf.join(idf, "term").select("template", "license", "term", (F.col("t_tf") * F.col("idf")).alias("t_w"))
    t_norm = t_vec.groupBy("template").agg(F.sqrt(F.sum(F.col("t_w") * F.col("t_w"))).alias("t_norm"))
    t_vec = F.broadcast(t_vec.join(t_norm, "template"))
    vec = tf.join(idf, "term").select("row_key", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = vec.groupBy("row_key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = vec.join(t_vec, "term").groupBy("row_key", "template", "license", "t_norm").agg(F.sum(F.col("w") * F.col("t_w")).alias("dot"))
    near = dots.join(norm, "row_key").withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 6))
    best = near.where(F.col("score") >= threshold).groupBy("row_key").agg(F.min(F.struct((-F.col("score")).alias("down"), "license")).alias("b"))
    return best.select("row_key", F.col("b.license").alias("own_license"), (-F.col("b.down")).alias("score"))


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``files`` (path, text, is_license_file, a doc_id if any): row_key, path, own_license,
    score, license, inherited_from.

    Directories end at the last '/' of a path; '' is the root, which a path without '/' or a
    null path is in.  Of several licence files in a directory the one with the highest score
    counts, then the smallest licence id.  An own licence comes before an inherited one.
    Null and empty texts have no licence of their own.  Repeated rows are rows of their own.
    """
    spark = files.sparkSession
    keep = [c for c in ("doc_id",) if c in files.columns]
    # Written once with the key, and of the texts only what can hold a licence.
    text = text_or_empty("text")
    named = staged(files.select(
        *keep, F.monotonically_increasing_id().alias("row_key"), F.col("path").cast("string").alias("path"), F.when(text.rlike(CUE), text).alias("text"),
        F.coalesce(F.col("is_license_file"), F.lit(False)).alias("is_license_file"),
    ), "named")
    own = staged(own_licenses(named, spark, templates, threshold), "own")
    path = F.coalesce("path", F.lit(""))
    places = named.select(*keep, "row_key", "path", "is_license_file", F.regexp_extract(path, "^(.*)/", 1).alias("dir"))
    placed = places.join(own, "row_key", "left")
    by_dir = placed.where("is_license_file and own_license is not null").groupBy("dir").agg(
        F.min(F.struct((-F.col("score")).alias("down"), "own_license"))["own_license"].alias("dir_license")
    )
    # Ancestors of the distinct directories: one row per directory and level above it.
    steps = F.split("dir", "/")
    up = places.select("dir").distinct().select(
        "dir", F.posexplode(F.concat(F.array(F.lit("")), F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))))).alias("depth", "ancestor"),
    )
    nearest = up.join(by_dir.withColumnRenamed("dir", "ancestor"), "ancestor").groupBy("dir").agg(
        F.max(F.struct("depth", "ancestor", "dir_license")).alias("m")
    )
    out = placed.join(nearest, "dir", "left")
    return out.select(
        *keep, "row_key", "path", "own_license", "score", F.coalesce("own_license", "m.dir_license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("m.ancestor")).alias("inherited_from"),
    )


#: Words up to which a document with a licence line is its directory's licence file.
NOTICE_WORDS = 40


def document_files(docs: DataFrame) -> DataFrame:
    """``documents`` as files: source/language/shard/doc_id, 50 ids a shard.  A short document
    with a licence cue is a licence file and lies one level higher."""
    text = text_or_empty("text")
    part = lambda c: F.coalesce(c.cast("string"), F.lit("_"))
    lic = text.rlike(CUE) & (word_count(text) <= NOTICE_WORDS)
    shard = F.when(lic, F.lit(None)).otherwise(part(F.floor(F.col("doc_id") / 50)))  # concat_ws skips a null
    return docs.select(
        "doc_id", F.concat_ws("/", part(F.col("source")), part(F.col("lang")), shard, part(F.col("doc_id"))).alias("path"),
        F.col("text"), lic.alias("is_license_file"),
    )
