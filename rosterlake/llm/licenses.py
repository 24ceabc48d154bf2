"""Licences of files: cosine of their headers and of licence files to templates, then inheritance.

Header lines (lines with a word stem that licences use) and whole short texts are units. A unit
and a template are vectors of TF-IDF weights over the templates' terms; all other words of a unit
weigh like a term that no unit has. A file has the licence of its best header line. A file whose
whole text is close to a template is the licence file of its directory, and files without a
licence take that of the nearest directory above them that has one.

Only DataFrame functions are used. Equal units are compared once; directories are resolved
before files are joined to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.session import materialize, small_side

from .tables import written

# Wording of licence notices, by SPDX identifier.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-Rights-Reserved", "All rights reserved."),
)
NO_TAG = "All-Rights-Reserved"  # the one name that is no SPDX identifier
TAGS = tuple((name, f"SPDX-License-Identifier: {name}") for name in sorted({n for n, _ in NOTICES} - {NO_TAG}))
TEMPLATES = NOTICES + TAGS
STEMS = "licen[sc]|copyright|spdx|rights reserved|public domain|permission|redistribut|cc0|cc by"
TERM = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """Lower-cased (A-Z) words, version numbers and hyphenated names of a text."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def template_terms(spark: SparkSession) -> DataFrame:
    """license, template, term, times."""
    rows = spark.createDataFrame([(n, *row) for n, row in enumerate(TEMPLATES)], "template int, license string, text string")
    each = rows.select("template", "license", F.explode(terms(F.col("text"))).alias("term"))
    return each.groupBy("template", "license", "term").agg(F.count("*").alias("times"))


def unit_licences(units: DataFrame, least: float) -> DataFrame:
    """unit (hash of the text), license, score of the distinct unit texts with a cosine of ``least`` or more.

    The inverse frequency of a term is log((1 + units) / (1 + units with it)) + 1 over the
    distinct units; ties go to the first identifier. Compared are units that share a term with a
    template.
    """
    spark = units.sparkSession
    known = F.broadcast(template_terms(spark).select("term").distinct())  # the terms of the fixed templates
    units = units.select(F.xxhash64("text").alias("unit"), "text").dropDuplicates(["unit"])
    total = units.select("unit").count()
    words = units.select("unit", terms(F.col("text")).alias("words"))
    words = words.select("unit", F.size("words").alias("size"), F.explode("words").alias("term")).join(known, "term", "left_semi")
    counted = materialize(words.groupBy("unit", "size", "term").agg(F.count("*").alias("times")), "terms")
    unseen = F.log(F.lit(1.0 + total)) + 1
    found = counted.groupBy("term").agg(F.count("*").alias("n"))
    idf = known.join(found, "term", "left").select(
        "term", (F.log((1.0 + total) / (1 + F.coalesce("n", F.lit(0)))) + 1).alias("idf")
    )
    idf = F.broadcast(materialize(idf, "idf"))  # one row per term of the templates
    weighed = template_terms(spark).join(idf, "term").withColumn("w", F.col("times") * F.col("idf"))
    norms = weighed.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    weighed = F.broadcast(weighed.join(norms, "template").select("template", "license", "term", (F.col("w") / F.col("norm")).alias("tw")))
    own = counted.join(idf, "term").withColumn("w", F.col("times") * F.col("idf"))
    others = F.col("size") - F.sum("times")
    lengths = own.groupBy("unit", "size").agg(F.sqrt(F.sum(F.col("w") * F.col("w")) + others * unseen * unseen).alias("length"))
    scores = own.join(weighed, "term").groupBy("unit", "template", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scores = scores.join(lengths, "unit").withColumn("score", F.round(F.col("dot") / F.col("length"), 6))
    best = scores.groupBy("unit").agg(F.min(F.struct((-F.col("score")).alias("order"), "license", "score")).alias("b"))
    return best.select("unit", "b.license", "b.score").filter(F.col("score") >= least)


def directory(path: Column) -> Column:
    """The path up to its last slash; '' for the top."""
    return F.regexp_replace(path, "/[^/]*$", "")


def inherited(files: DataFrame, holders: DataFrame) -> DataFrame:
    """directory, license, depth for every directory of ``files`` at or below one of ``holders``.

    ``holders`` has one licence per directory. The nearest one counts.
    """
    own = files.select("directory").distinct()
    parts = F.split("directory", "/")
    above = own.select("directory", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("holder"))
    joined = above.join(holders.withColumnRenamed("directory", "holder"), "holder")
    nearest = joined.groupBy("directory").agg(F.max_by(F.struct("holder", "license"), F.length("holder")).alias("n"))
    return nearest.select("directory", "n.license", "n.holder")


def scan_licenses(
    files: DataFrame, key: str, path: str, text: str, header: float = 0.8, whole: float = 0.5
) -> DataFrame:
    """key, path, license, score, source of every file; source is header, directory or none.

    A header line counts from a cosine of ``header`` on, a licence file from ``whole`` on; of a
    file's lines, and a directory's licence files, the best counts, ties go to the first
    identifier, then path. An inherited licence has the score of the licence file. NULL and empty
    texts have no licence of their own; a NULL path is ''. Repeated rows stay, rows without a
    key are scanned; other columns are ignored, an empty table gives no rows. Header lines and
    directories are written to shared storage while the plan is built.
    """
    base = files.select(
        F.col(key).alias("key"), F.coalesce(F.col(path), F.lit("")).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    trigger = F.translate("text", UPPER, LOWER).rlike(STEMS)
    # texts without a stem have no header line; of the others each text is kept once per path
    hits = base.filter(trigger).select("path", F.xxhash64("text").alias("file"), "text")
    hits = written(hits.dropDuplicates(["path", "file"]), "hits")
    lines = hits.select("path", "file", F.explode(F.split("text", "\n")).alias("text")).filter(trigger)
    units = lines.select("path", "file", F.xxhash64("text").alias("unit")).distinct()
    of_file = units.join(unit_licences(lines.select("text"), header), "unit")
    of_file = of_file.groupBy("path", "file").agg(F.min(F.struct((-F.col("score")).alias("order"), "license", "score")).alias("own"))
    of_file = materialize(of_file.select("path", "file", "own.license", "own.score"), "headers")

    whole_licences = unit_licences(hits.select("text"), whole).withColumnRenamed("unit", "file")
    holders = hits.select("path", "file").join(whole_licences, "file")
    holders = holders.groupBy(directory(F.col("path")).alias("directory")).agg(
        F.min(F.struct((-F.col("score")).alias("order"), "license", "path", "score")).alias("h")
    )
    holders = materialize(holders.select("directory", F.struct("h.license", "h.score").alias("license")), "holders")

    slim = base.select("key", "path", directory(F.col("path")).alias("directory"), F.xxhash64("text").alias("file"))
    own = of_file.select("path", "file", F.col("license").alias("own"), F.col("score").alias("own_score"))
    joined = slim.join(own, ["path", "file"], "left")
    above = inherited(slim, holders).select("directory", F.col("license").alias("up"))
    joined = joined.join(small_side(above), "directory", "left")
    source = F.when(F.col("own").isNotNull(), "header").when(F.col("up").isNotNull(), "directory").otherwise("none")
    return joined.select(
        F.col("key").alias(key),
        "path",
        F.coalesce("own", "up.license").alias("license"),
        F.coalesce("own_score", "up.score").alias("score"),
        source.alias("source"),
    )
