"""Licence scan: TF-IDF cosine of notices and licence files to templates, then inheritance along directories.

Passages of a text are its lines and its sentences (cut after `.`, `!` or `?` and white space); terms are runs of a-z and 0-9, also
joined by `.` or `-`, in lower case. A passage or template is the vector of count x idf, idf = 1 + ln((N + 1) / (df + 1)),
df over all N files; a term that no template has counts as never seen (df 0). A passage has the licence of the template with the
largest cosine from SIMILARITY on (6 decimals; ties by name), and a file that of its best passage.

To reach the similarity t, a passage must hold one of the template's weightiest terms, those that remain when the lightest are
left out as long as the squares of their share stay below t squared. So texts and passages without any of those terms are
left out early, exactly. Each distinct passage is compared once.

A file named LICENSE, LICENCE or COPYING (any case, any ending) with a licence hands it to its directory. A file
without one of its own has that of the nearest directory above it that has one; the best score decides between several in one
directory. Paths are separated by `/`.

Null and empty texts have no passages; a null path has no directory. Rows that repeat give a row each. Long texts are cut into
passages like others; a long line is one passage. An empty table gives no rows. Only id, path and text are read, so other columns may have
any name. Only DataFrame functions are used.
"""

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.plans.workspace import stored

SIMILARITY = 0.8
TERM = "[a-z0-9]+(?:[.-][a-z0-9]+)*"

# fixed values: notices by which licences are usually declared
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any "
                "later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
]


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def passages_of(text: Column) -> Column:
    sentences = F.split(F.regexp_replace(text, "([.!?])[ \t\r\n]+", "$1\u0001"), "\u0001")
    return F.array_distinct(F.concat(F.split(text, "\n"), sentences))


def template_vectors(templates: list, idf: dict) -> list[tuple[str, dict]]:
    """Licence and unit vector of each template."""
    out = []
    for name, text in templates:
        found = re.findall(TERM, text.lower())
        vector = {t: found.count(t) * idf[t] for t in set(found)}
        size = math.sqrt(sum(v * v for v in vector.values()))
        out.append((name, {t: v / size for t, v in vector.items()}))
    return out


def needed_terms(vectors: list, least: float) -> set[str]:
    """Terms one of which every passage of at least that similarity to a template holds."""
    out = set()
    for _, vector in vectors:
        left = 0.0
        for term, value in sorted(vector.items(), key=lambda x: (x[1], x[0])):
            left += value * value
            if left >= least * least - 1e-9:
                out.add(term)
    return out


def frequencies(files: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of files, and of those with each term of the templates."""
    wanted = F.array(*[F.lit(t) for t in vocabulary])
    found = files.select(F.explode(F.concat(
        F.array(F.lit("")), F.coalesce(F.array_intersect(terms_of(F.col("text")), wanted), F.array().cast("array<string>"))
    )).alias("term"))
    count = {r["term"]: r["count"] for r in found.groupBy("term").count().collect()}  # the vocabulary at most
    return count.pop("", 0), count


def licenses_of_files(files: DataFrame, templates: list | None = None, least: float = SIMILARITY) -> DataFrame:
    """id, path, license, score, origin (own, inherited or null), origin_path of each row of `files` (id, path, text)."""
    spark = files.sparkSession
    templates = templates or TEMPLATES
    vocabulary = sorted({t for _, text in templates for t in re.findall(TERM, text.lower())})
    n, df = frequencies(files, vocabulary)
    idf = {t: 1 + math.log((n + 1) / (df.get(t, 0) + 1)) for t in vocabulary}
    vectors = template_vectors(templates, idf)
    needed = F.array(*[F.lit(t) for t in sorted(needed_terms(vectors, least))])
    weights = spark.createDataFrame(
        [(t, idf[t], i, name, v[t]) for i, (name, v) in enumerate(vectors) for t in v],
        "term string, idf double, template int, license string, weight double",
    )
    known = spark.createDataFrame([(t, idf[t]) for t in vocabulary], "term string, idf double")

    files = files.select("id", "path", "text").withColumn("_key", F.xxhash64("text"))
    near = files.where(F.arrays_overlap(terms_of(F.col("text")), needed))
    near = near.select("id", "path", "_key", F.explode(passages_of(F.col("text"))).alias("passage"))
    near = stored(near.where(F.arrays_overlap(terms_of(F.col("passage")), needed)), "license-passages")
    counts = near.select("passage").distinct().select("passage", F.explode(terms_of(F.col("passage"))).alias("term"))
    counts = counts.groupBy("passage", "term").agg(F.count("*").alias("tf"))
    sizes = counts.join(known, "term", "left").groupBy("passage").agg(
        F.sqrt(F.sum(F.pow(F.col("tf") * F.coalesce("idf", F.lit(1 + math.log(n + 1))), 2))).alias("size")
    )
    dots = counts.join(weights, "term").groupBy("passage", "template", "license").agg(
        F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot")
    )
    scores = dots.join(sizes, "passage").select("passage", "license", F.round(F.col("dot") / F.col("size"), 6).alias("score"))
    scores = scores.where(F.col("score") >= least).groupBy("passage").agg(_best("license").alias("best"))

    own = near.join(scores, "passage").select("id", "path", "_key", F.col("best.*"))
    own = own.groupBy("id", "path", "_key").agg(_best("license").alias("own"))
    own = own.select(F.col("id").alias("_id"), F.col("path").alias("_path"), F.col("_key").alias("_own_key"), "own")
    judged = files.select("id", "path", "_key").join(
        own, F.col("id").eqNullSafe(F.col("_id")) & F.col("path").eqNullSafe(F.col("_path")) & (F.col("_key") == F.col("_own_key")),
        "left",
    )
    judged = stored(judged.select("id", "path", "own", directory_of(F.col("path")).alias("dir")), "license-own")
    handed = inherited(judged)
    out = judged.join(handed, "dir", "left")
    has_own = F.col("own").isNotNull()
    return out.select(
        "id", "path",
        F.coalesce("own.license", "handed.license").alias("license"),
        F.coalesce("own.score", "handed.score").alias("score"),
        F.when(has_own, "own").when(F.col("handed").isNotNull(), "inherited").alias("origin"),
        F.when(has_own, F.col("path")).otherwise(F.col("handed.path")).alias("origin_path"),
    )


def _best(what: str) -> Column:
    """The struct (license, score) of the largest score, the first name of equals."""
    return F.min(F.struct((-F.col("score")).alias("less"), F.col(what).alias("license"), F.col("score").alias("score")))


def directory_of(path: Column) -> Column:
    """The path up to its last `/`, empty without one, null for null."""
    return F.regexp_replace(F.regexp_replace(path, "[^/]*$", ""), "/$", "")


def inherited(judged: DataFrame) -> DataFrame:
    """dir, handed (license, score, path): of each directory, from the nearest one at or above it that has a licence file."""
    name = F.lower(F.regexp_extract("path", "[^/]*$", 0))
    given = judged.where(F.col("own").isNotNull() & name.rlike(r"^(license|licence|copying)(\.[^/]*)?$"))
    given = given.groupBy(F.col("dir").alias("above")).agg(
        F.min(F.struct("own.less", "own.license", "path", "own.score")).alias("file")
    )
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("above")
    ))
    every = judged.where("dir IS NOT NULL").select("dir").distinct().select("dir", F.explode(above).alias("a"))
    found = every.select("dir", "a.*").join(given, "above")
    found = found.groupBy("dir").agg(F.max(F.struct("depth", "file"))["file"].alias("file"))
    return found.select(
        "dir", F.struct("file.license", "file.score", "file.path").alias("handed")
    )
