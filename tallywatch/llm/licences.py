"""Licence scans: documents against licence templates by the Dice coefficient over word bigrams.

A text is lower-cased and cut into words (runs of letters and digits); its bigrams are a set. A template matches if
2 |A and B| / (|A| + |B|) reaches the threshold, which bounds the sizes of lines a template can match: those pairs of
line and template alone are counted. Lines meet templates by shared bigrams, in a join with the templates' bigrams,
a table of fixed size. DataFrame operations only.

`scan` compares single lines. `scan_text` also compares windows: as many consecutive words as the template has, across
line ends, from each bigram that they share, so that notices that are wrapped, stand within a line or are full texts
are found. A match needs least(size) of a template's bigrams, so a text has none without one of `anchors`, which leave
out the least less one; only texts with an anchor are cut into windows. Set sizes of all windows are running sums: a
bigram counts in the windows that begin behind its previous place and reach its own. n_lines counts the lines that
match, or on which a window begins that matches better than those that begin around it.

Null texts count as empty. A document without a match has no licence, similarity 0 and no lines. Of equal similarities
the first licence by name counts. Rows that repeat id and text get the same result each.
"""

from __future__ import annotations

import re
from fractions import Fraction
from math import ceil
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.common import saved

#: Public licence notices, by licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
THRESHOLD = 0.9
#: Full texts of licences, from files named by licence, and all that texts are compared with.
FULL_TEXTS = tuple((p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))
ALL_TEMPLATES = TEMPLATES + FULL_TEXTS


def bigrams(text: str) -> set[str]:
    words = re.findall(r"[a-z0-9]+", text.lower())
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


#: Words of a lower-cased line, and the distinct bigrams of words.
WORDS = r"split(trim(regexp_replace(line_text, '[^\\p{L}\\p{N}]+', ' ')), ' ')"
PAIRS = "array_distinct(zip_with(slice(words, 1, size(words) - 1), slice(words, 2, size(words) - 1), (a, b) -> concat(a, ' ', b)))"


def matches(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """doc_id, body (hash of the text), line (from 0), template, licence, similarity of matching lines and templates."""
    sets = [(i, name, bigrams(text)) for i, (name, text) in enumerate(templates)]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    rows = [(i, name, len(s), b) for i, name, s in sets for b in sorted(s)]
    known = docs.sparkSession.createDataFrame(rows, "template int, licence string, template_size int, bigram string")
    smallest, largest = (f([len(s) for _, _, s in sets]) for f in (min, max))
    text = F.coalesce("text", F.lit(""))
    lines = (
        docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("body"), F.posexplode(F.split(F.lower(text), "\n")).alias("line", "line_text"))
        .withColumn("words", F.expr(WORDS)).withColumn("pairs", F.expr(PAIRS)).withColumn("size", F.size("pairs"))
        .where((F.col("size") >= smallest * low) & (F.col("size") <= largest * high))
        .select("doc_id", "body", "line", "size", F.explode("pairs").alias("bigram"))
    )
    both = (
        lines.join(F.broadcast(known), "bigram")
        .where((F.col("size") >= F.col("template_size") * low) & (F.col("size") <= F.col("template_size") * high))
        .groupBy("doc_id", "body", "line", "template").agg(
            F.countDistinct("bigram").alias("shared"), F.first("licence").alias("licence"),
            F.first("size").alias("size"), F.first("template_size").alias("template_size"))
    )
    similarity = 2 * F.col("shared") / (F.col("size") + F.col("template_size"))
    return both.select("doc_id", "body", "line", "template", "licence", similarity.alias("similarity")).where(F.col("similarity") >= threshold)


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, licence (of the best match), similarity, n_lines (that match a licence) of every row."""
    best = matches(docs, threshold).groupBy("doc_id", "body").agg(
        F.max("similarity").alias("similarity"), F.min_by("licence", F.struct(-F.col("similarity"), "licence")).alias("licence"),
        F.countDistinct("line").alias("n_lines"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("body"))
    found = best.select(F.col("doc_id").alias("id"), F.col("body").alias("of"), "licence", "similarity", "n_lines")
    return (
        rows.join(found, rows["doc_id"].eqNullSafe(found["id"]) & (rows["body"] == found["of"]), "left")
        .select("doc_id", "licence", F.coalesce("similarity", F.lit(0.0)).alias("similarity"), F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"))
    )


def least(size: int, threshold: float = THRESHOLD) -> int:
    """Bigrams of a template of so many that any set matching it shares."""
    exact = Fraction(str(threshold))
    return ceil(exact * size / (2 - exact))


def anchors(threshold: float = THRESHOLD, templates=ALL_TEMPLATES) -> set[str]:
    """Of each template its longest bigrams, as few as no match can be without."""
    sets = [sorted(bigrams(text), key=lambda b: (-len(b), b)) for _, text in templates]
    return {b for s in sets for b in s[:len(s) - least(len(s), threshold) + 1]}


def _id() -> list[Column]:
    """Rows of one id and text have one result; those without an id have it by text alone."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("body")]


def _anchored(docs: DataFrame, threshold: float, templates) -> DataFrame:
    """id, body, text of the texts that can match a template, once each; a saved table."""
    some = ", ".join(f"'{b}'" for b in sorted(anchors(threshold, templates)))
    words = WORDS.replace("line_text", "lower(text)")
    has = f"exists(transform(array({words}), words -> exists({PAIRS.replace('array_distinct', '')}, p -> p IN ({some}))), x -> x)"
    found = docs.select(*_id(), F.coalesce("text", F.lit("")).alias("text")).where(has)
    return saved(found.dropDuplicates(["id", "body"]))


def windows(texts: DataFrame, threshold: float = THRESHOLD, templates=ALL_TEMPLATES) -> DataFrame:
    """id, body, line (of the first word, from 0), template, licence, similarity of matching windows and templates, peak (none around it is better)."""
    own, theirs = ["id", "body"], ["id", "body", "template"]
    sets = [(i, name, bigrams(text), len(re.findall(r"[a-z0-9]+", text.lower())) - 1) for i, (name, text) in enumerate(templates)]
    rows = [(i, name, len(s), least(len(s), threshold), n, b) for i, name, s, n in sets for b in sorted(s)]
    known = texts.sparkSession.createDataFrame(rows, "template int, licence string, template_size int, least int, span int, bigram string")
    placed = f"flatten(transform(split(lower(text), '\\n'), (line_text, line) -> transform(filter({WORDS}, w -> w <> ''), w -> struct(w AS w, line AS line))))"
    paired = "zip_with(slice(words, 1, size(words) - 1), slice(words, 2, size(words) - 1), (a, b) -> struct(concat(a.w, ' ', b.w) AS bigram, a.line AS line))"
    bigrams_at = (
        texts.withColumn("words", F.expr(placed)).where("size(words) > 1")
        .select(*own, F.posexplode(F.expr(paired)).alias("at", "pair")).select(*own, "at", "pair.bigram", "pair.line")
        .withColumn("before", F.lag("at").over(Window.partitionBy(*own, "bigram").orderBy("at")))
    )
    fit = (
        bigrams_at.join(F.broadcast(known), "bigram").groupBy(*theirs)
        .agg(F.countDistinct("bigram").alias("n"), *(F.first(c).alias(c) for c in ("licence", "template_size", "least", "span")))
        .where("n >= least").select(*theirs, "licence", "template_size", "span")
    )
    hits = F.broadcast(known.select("template", "bigram", F.lit(1).alias("hit")))
    all_at = bigrams_at.join(fit, own).join(hits, ["template", "bigram"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    changes = F.expr("""array(
        struct(greatest(coalesce(before + 1, at - span + 1), at - span + 1) AS start, 1 AS size, hit AS shared, 0 AS begins, 0 AS line),
        struct(at + 1 AS start, -1 AS size, -hit AS shared, 0 AS begins, 0 AS line),
        struct(at AS start, 0 AS size, 0 AS shared, hit AS begins, line AS line))""")
    summed = (
        all_at.select(*theirs, "licence", "template_size", "span", F.explode(changes).alias("c"))
        .groupBy(*theirs, "c.start").agg(
            *(F.first(c).alias(c) for c in ("licence", "template_size", "span")), F.sum("c.size").alias("size"),
            F.sum("c.shared").alias("shared"), F.max("c.begins").alias("begins"), F.max("c.line").alias("line"))
    )
    so_far, order = Window.partitionBy(*theirs).orderBy("start").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*theirs).orderBy("start")
    similarity = 2 * F.sum("shared").over(so_far) / (F.sum("size").over(so_far) + F.col("template_size"))
    found = summed.withColumn("similarity", similarity).where((F.col("begins") == 1) & (F.col("similarity") >= threshold))
    # The next match on each side, if it begins less than half a template away.
    near = lambda f: F.coalesce(F.when(2 * F.abs(F.col("start") - f("start").over(order)) < F.col("span"), f("similarity").over(order)), F.lit(0.0))
    peak = (near(F.lag) <= F.col("similarity")) & (near(F.lead) < F.col("similarity"))
    return found.select(*own, "line", "template", "licence", "similarity", peak.alias("peak"))


def scan_text(docs: DataFrame, threshold: float = THRESHOLD, templates=ALL_TEMPLATES) -> DataFrame:
    """doc_id, licence (of the best match), similarity, n_lines (that match or on which a match begins) of every row."""
    texts = _anchored(docs, threshold, templates)
    lines = matches(texts.select(F.col("id").alias("doc_id"), "text"), threshold, templates)
    every = lines.select(F.col("doc_id").alias("id"), "body", "line", "licence", "similarity").union(
        windows(texts, threshold, templates).select("id", "body", F.when(F.col("peak"), F.col("line")), "licence", "similarity"))
    best = every.groupBy("id", "body").agg(
        F.max("similarity").alias("similarity"), F.min_by("licence", F.struct(-F.col("similarity"), "licence")).alias("licence"),
        F.countDistinct("line").alias("n_lines"))
    return (
        docs.select(F.col("doc_id").cast("long"), *_id()).join(best, ["id", "body"], "left")
        .select("doc_id", "licence", F.coalesce("similarity", F.lit(0.0)).alias("similarity"), F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"))
    )


def oracle() -> str:
    """The same scan as SQL over the table documents."""
    known = ", ".join(
        f"({i}, '{name}', {len(s)}, '{b}')" for i, (name, text) in enumerate(TEMPLATES) for s in [bigrams(text)] for b in sorted(s))
    return f"""
WITH known(template, licence, template_size, bigram) AS (VALUES {known}),
lines AS (
    SELECT doc_id, line, list_filter(string_split(regexp_replace(words, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS words
    FROM (SELECT doc_id, unnest(string_split(lower(coalesce(text, '')), chr(10))) AS words,
                 generate_subscripts(string_split(lower(coalesce(text, '')), chr(10)), 1) AS line FROM documents)),
sized AS (
    SELECT doc_id, line, list_distinct([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) AS pairs FROM lines),
shared AS (
    SELECT doc_id, line, template, licence, template_size, any_value(len(pairs)) AS size, count(*) AS shared
    FROM (SELECT doc_id, line, pairs, unnest(pairs) AS bigram FROM sized) JOIN known USING (bigram)
    GROUP BY doc_id, line, template, licence, template_size),
matched AS (
    SELECT *, CAST(2 * shared AS DOUBLE) / (size + template_size) AS similarity FROM shared
    WHERE CAST(2 * shared AS DOUBLE) / (size + template_size) >= {THRESHOLD}),
best AS (
    SELECT doc_id, first(licence ORDER BY similarity DESC, licence) AS licence, max(similarity) AS similarity, count(DISTINCT line) AS n_lines
    FROM matched GROUP BY doc_id)
SELECT doc_id, licence, CAST(coalesce(similarity, 0) AS DOUBLE) AS similarity, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines
FROM documents LEFT JOIN best USING (doc_id)
"""
