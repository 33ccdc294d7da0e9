"""Operator 3, license scans: TF-IDF cosine of headers and licence files to templates, inherited down the folders.

A file's passages are its lines and, for a licence file, also its whole text. Passages and templates are sparse TF-IDF
vectors over words (runs of letters and digits, lower case), with document frequencies counted over all files:
weight = count * (ln((1 + files) / (1 + files with the word)) + 1). A file's own licence is the template with the
highest cosine over its passages, if that is at least ``threshold``. A file without one inherits from the nearest
folder above it (its own folder first) that holds a licence file with a licence, by equality joins of paths.

Only DataFrame functions are used. A passage can reach the threshold only if it holds an *anchor* word: a template's
words are anchors except the lightest ones whose weight all together stays below it. Passages without any anchor are
never turned into vectors, which loses nothing. Frequencies are then counted for the words of the others alone.

Defined cases: a null or empty text has no licence of its own but inherits; a file with a null path keeps its own
notice, but gives and inherits none; a path without a slash lies in the root folder ''; rows with equal paths are judged
each by its own text; ties go to the licence first in the alphabet; no templates, or an empty table: no licences, or no
rows.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import narrow, settle, table

# Notices as their publishers word them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License.",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met:",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International"),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction',
    ),
    "proprietary": ("All rights reserved.",),
}
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)([^/]*)$"
SEPARATORS = r"'[^\\p{L}\\p{N}]+'"


def words_of(text: str) -> str:
    return f"array_remove(split(lower({text}), {SEPARATORS}), '')"


def folder_of(path: str) -> str:
    return f"if(instr({path}, '/') = 0, if({path} IS NULL, null, ''), substring_index({path}, '/', -1 + size(split({path}, '/'))))"


def quoted(words: Sequence[str]) -> str:
    return ", ".join("'" + w + "'" for w in words)  # words hold letters and digits only


def frequencies(files: DataFrame, words: DataFrame) -> DataFrame:
    """``word, files``: in how many files each of the given words occurs."""
    each = files.select(F.explode(F.expr(f"array_distinct({words_of('text')})")).alias("word"))
    met = each.join(narrow(words), "word", "left_semi").groupBy("word").agg(F.count("*").alias("files"))
    return words.join(met, "word", "left").selectExpr("word", "coalesce(files, 0L) AS files")


def weighted(vectors: DataFrame, known: DataFrame, total: int, key: str) -> DataFrame:
    """``key, word, weight`` with vectors of length 1, from ``key, word, n``."""
    idf = f"ln({1 + total} / (1 + files)) + 1"
    raw = vectors.join(known, "word").withColumn("raw", F.expr(f"n * ({idf})"))
    length = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length"))
    return raw.join(length, key).select(key, "word", (F.col("raw") / F.col("length")).alias("weight"))


def scan(
    files: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    *,
    path: str = "path",
    text: str = "text",
    carry: Sequence[str] = (),
    licence_file: str = LICENCE_FILE,
    threshold: float = 0.6,
) -> DataFrame:
    """One row per file: the ``carry`` columns, ``path, license, score, origin, folder``.

    ``origin`` is ``own``, ``inherited`` or null; ``folder`` the folder inherited from; ``score`` the cosine of the
    file's own notice, or of the licence file's.
    """
    spark = files.sparkSession
    named = files.select(*carry, F.col(path).alias("path"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    total = named.count()
    own = own_licences(named, templates, total, licence_file, threshold) if total and templates else None
    out = named.drop("text").withColumn("folder_of", F.expr(folder_of("path")))
    if own is None:
        own = spark.createDataFrame([], "path string, text_hash long, score double, back int, license string")
    own = settle(own)
    givers = own.where(F.col("path").rlike(licence_file)).withColumn("folder", F.expr(folder_of("path")))
    best = F.max(F.struct("score", "back", "license"))
    givers = settle(givers.groupBy("folder").agg(best.alias("best"))).selectExpr(
        "folder", "best.license AS given", "best.score AS given_score"
    )
    folders = out.where("folder_of IS NOT NULL").select("folder_of").distinct()
    above = "transform(sequence(0, size(split(folder_of, '/'))), i -> substring_index(folder_of, '/', i))"
    chain = folders.withColumn("folder", F.explode(F.array_distinct(F.expr(above))))
    nearest = F.max(F.struct(F.length("folder").alias("depth"), "folder", "given", "given_score"))
    heirs = chain.join(narrow(givers), "folder").groupBy("folder_of").agg(nearest.alias("heir"))
    heirs = settle(heirs.selectExpr("folder_of", "heir.folder AS folder", "heir.given", "heir.given_score"))
    # a file's own notice needs no path; only inheritance does
    mine = narrow(own).selectExpr("path AS own_path", "text_hash AS own_hash", "license", "score")
    met = out.join(mine, F.expr("path <=> own_path AND text_hash = own_hash"), "left").join(narrow(heirs), "folder_of", "left")
    return met.selectExpr(
        *[f"`{c}`" for c in carry],
        "path",
        "coalesce(license, given) AS license",
        "coalesce(score, given_score) AS score",
        "CASE WHEN license IS NOT NULL THEN 'own' WHEN given IS NOT NULL THEN 'inherited' END AS origin",
        "if(license IS NULL, folder, null) AS folder",
    )


def own_licences(
    files: DataFrame, templates: Mapping[str, Sequence[str]], total: int, licence_file: str, threshold: float
) -> DataFrame:
    """``path, text_hash, license, score`` of the files that hold a notice of their own."""
    spark = files.sparkSession
    rows = [(i, -place, name, t) for place, name in enumerate(sorted(templates)) for i, t in enumerate(templates[name])]
    given = spark.createDataFrame(
        [(f"{back}#{i}", back, name, t) for i, back, name, t in rows],
        "template string, back int, license string, text string",
    )
    counts = given.select("template", F.explode(F.expr(words_of("text"))).alias("word"))
    counts = counts.groupBy("template", "word").agg(F.count("*").alias("n"))
    vocabulary = counts.select("word").distinct()
    known = settle(frequencies(files, vocabulary))
    model = settle(weighted(counts, known, total, "template"))

    # the words without which a passage cannot reach the threshold: bounded by the templates
    light = model.selectExpr(
        "template", "word", "sum(weight * weight) OVER (PARTITION BY template ORDER BY weight, word) AS upto"
    )
    anchors = sorted({r["word"] for r in light.where(f"upto >= {threshold**2 - 1e-9}").collect()})
    pattern = rf"(?<![\p{{L}}\p{{N}}])({'|'.join(anchors)})(?![\p{{L}}\p{{N}}])"
    held = files.withColumn("low", F.lower("text")).where(F.col("low").rlike(pattern))
    whole = F.when(F.col("path").rlike(licence_file), F.array("low")).otherwise(F.expr("cast(array() AS array<string>)"))
    passages = held.select(
        "path", "text_hash", F.explode(F.array_distinct(F.concat(whole, F.split("low", r"[\r\n]+")))).alias("passage")
    )
    passages = passages.where(F.col("passage").rlike(pattern)).distinct()
    passages = settle(passages.withColumn("id", F.md5("passage")))

    # a passage that many files share is one vector
    texts = passages.select("id", "passage").dropDuplicates(["id"])
    counted = texts.select("id", F.explode(F.expr(words_of("passage"))).alias("word"))
    counted = settle(counted.groupBy("id", "word").agg(F.count("*").alias("n")))
    vectors = weighted(counted, frequencies(files, counted.select("word").distinct()), total, "id")
    shared = vectors.join(F.broadcast(model.withColumnRenamed("weight", "other")), "word")
    cosines = shared.groupBy("id", "template").agg(F.round(F.sum(F.expr("weight * other")), 9).alias("score"))
    likely = cosines.where(f"score >= {threshold}").join(F.broadcast(given.drop("text")), "template")
    best = F.max(F.struct("score", "back", "license"))
    likely = settle(likely.groupBy("id").agg(best.alias("best")))
    found = passages.select("path", "text_hash", "id").join(narrow(likely), "id").groupBy("path", "text_hash")
    return found.agg(F.max("best").alias("best")).select("path", "text_hash", "best.*")


SHORT = 200  # characters
PATH = f"""concat(coalesce(source, ''), '/', coalesce(lang, ''), '/',
    if(length(text) <= {SHORT}, 'LICENSE.', 'doc.'), coalesce(cast(doc_id AS string), ''))"""


def op3_license_scan(spark, sf_dir) -> DataFrame:
    """Documents as files ``source/lang/name.doc_id``; those of up to 200 characters are named as licence files."""
    docs = table(spark, sf_dir, "documents").withColumn("path", F.expr(PATH))
    return scan(docs, carry=["doc_id"]).withColumn("score", F.round("score", 6))


_WORDS = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
_GIVEN = ", ".join(
    "({}, '{}', '{}')".format(n, name, t.replace("'", "''"))
    for n, (name, t) in enumerate((name, t) for name in sorted(TEMPLATES) for t in TEMPLATES[name])
)

OP3_SQL = f"""
WITH files AS (
  SELECT row_number() OVER () AS file, doc_id, text, concat_ws('/', coalesce(source, ''), coalesce(lang, ''),
    CASE WHEN length(text) <= {SHORT} THEN 'LICENSE.' ELSE 'doc.' END || coalesce(CAST(doc_id AS VARCHAR), '')) AS path
  FROM documents),
total AS (SELECT count(*) AS files FROM files),
given AS (SELECT * FROM (VALUES {_GIVEN}) AS v(template, license, text)),
df AS (SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct({_WORDS.format("text")})) AS word FROM files) GROUP BY word),
passages AS (
  SELECT DISTINCT file, path, passage FROM (
    SELECT file, path, unnest(regexp_split_to_array(lower(text), '[\r\n]+')) AS passage FROM files
    UNION ALL SELECT file, path, lower(text) FROM files WHERE regexp_matches(path, '(^|/)LICENSE[^/]*$'))),
texts AS (SELECT DISTINCT passage AS id, passage FROM passages),
words AS (SELECT id, word, count(*) AS n FROM (SELECT id, unnest({_WORDS.format("passage")}) AS word FROM texts) GROUP BY ALL),
raw AS (
  SELECT id, word, n * (ln((1 + (SELECT files FROM total)) / (1 + coalesce(df, 0))) + 1) AS w
  FROM words LEFT JOIN df USING (word)),
lengths AS (SELECT id, sqrt(sum(w * w)) AS len FROM raw GROUP BY id),
tword AS (
  SELECT template, word, count(*) AS n
  FROM (SELECT template, unnest({_WORDS.format("text")}) AS word FROM given) GROUP BY ALL),
traw AS (
  SELECT template, word, n * (ln((1 + (SELECT files FROM total)) / (1 + coalesce(df, 0))) + 1) AS w
  FROM tword LEFT JOIN df USING (word)),
tlengths AS (SELECT template, sqrt(sum(w * w)) AS len FROM traw GROUP BY template),
cosines AS (
  SELECT raw.id, traw.template, round(sum(raw.w * traw.w) / any_value(lengths.len) / any_value(tlengths.len), 9) AS score
  FROM raw JOIN traw USING (word) JOIN lengths ON lengths.id = raw.id JOIN tlengths ON tlengths.template = traw.template
  GROUP BY raw.id, traw.template),
own AS (
  SELECT file, path, license, score FROM (
    SELECT file, path, license, score, row_number() OVER (PARTITION BY file ORDER BY score DESC, license) AS nth
    FROM passages JOIN cosines ON cosines.id = passages.passage JOIN given USING (template) WHERE score >= 0.6)
  WHERE nth = 1),
givers AS (
  SELECT folder, license, score FROM (
    SELECT regexp_replace(path, '/[^/]*$', '') AS folder, license, score,
      row_number() OVER (PARTITION BY regexp_replace(path, '/[^/]*$', '') ORDER BY score DESC, license) AS nth
    FROM own WHERE regexp_matches(path, '(^|/)LICENSE[^/]*$')) WHERE nth = 1),
heirs AS (
  SELECT file, folder, license, score FROM (
    SELECT files.file, givers.folder, givers.license, givers.score,
      row_number() OVER (PARTITION BY files.file ORDER BY length(givers.folder) DESC) AS nth
    FROM files JOIN givers ON starts_with(files.path, givers.folder || '/')) WHERE nth = 1)
SELECT doc_id, files.path, coalesce(own.license, heirs.license) AS license,
  round(coalesce(own.score, heirs.score), 6) AS score,
  CASE WHEN own.license IS NOT NULL THEN 'own' WHEN heirs.license IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN own.license IS NULL THEN heirs.folder END AS folder
FROM files LEFT JOIN own USING (file) LEFT JOIN heirs USING (file)
"""
