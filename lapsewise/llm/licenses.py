"""License scan over a positional index of rare words, in SQL functions alone.

Words are ASCII letters and digits (lower-cased) and all other non-ASCII characters. Document
frequencies of template words are counted over all documents; each template's rarest words form
the index with their positions. A file looks up all of its index words, hits that keep the same
distance between file and template position vote for that placement, and a placement with enough
votes counts if the file also has the template's mandatory phrase. Null and empty texts have no
words and no labels. Repeated rows get equal labels, ties between placements do not matter as the
best share is taken. Without documents the result is empty.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.storage import write_and_reload

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The phrases of the base rule and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Well-known opening sentences of public licenses.
TEMPLATES = {
    "agpl-3.0": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files, to deal in the Software without restriction",
    "mit-release": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
# Words that must stand together for the template to count.
MANDATORY = {
    "agpl-3.0": "affero general public license", "apache-2.0": "apache license version 2 0",
    "bsd": "source and binary forms", "gpl-3.0": "general public license version 3", "isc": "with or without fee",
    "mit-grant": "free of charge to any person", "mit-release": "released under the mit license",
    "mpl-2.0": "mozilla public license v 2 0",
}
#: Index words of each template.
RARE_WORDS = 6
#: Share of a template's index words that one placement must hit.
QUORUM = 0.6


def word_line(text: Column) -> Column:
    """The words of a text with one space between them; empty without words.

    Lower case is that of all letters, which gives the words of A-Z alone but for the spelling of words that hold
    other letters: the Kelvin sign, whose lower case is a k, is the only one that must not reach it.
    """
    safe = F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138"))
    return F.trim(F.regexp_replace(F.lower(safe), NOT_WORD, " "))


def words_of(line: Column) -> Column:
    return F.when(line == "", F.array().cast("array<string>")).otherwise(F.split(line, " "))


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def _texts(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def build_index(docs: DataFrame, text: str = "text", rare_words: int = RARE_WORDS) -> list[tuple[str, str, int, float]]:
    """(word, template, position, idf) of each template's rarest words; counts cover all documents."""
    vocabulary = sorted({w for t in TEMPLATES.values() for w in template_words(t)})
    found = docs.select(F.array_intersect(_texts(vocabulary), words_of(word_line(F.col(text)))).alias("w"))
    # One row per vocabulary word, and one for the number of documents.
    counted = found.select(F.explode(F.concat("w", F.array(F.lit("")))).alias("w")).groupBy("w").count().collect()
    seen = {r[0]: r[1] for r in counted}
    idf = {w: math.log((seen.get("", 0) + 1) / (seen.get(w, 0) + 0.5)) for w in vocabulary}
    index = []
    for name, body in sorted(TEMPLATES.items()):
        words = template_words(body)
        rarest = sorted(set(words), key=lambda w: (-idf[w], w))[:rare_words]
        index += [(w, name, i, idf[w]) for i, w in enumerate(words) if w in rarest]
    return index


def scan(docs: DataFrame, index: list[tuple[str, str, int, float]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Figures of the base rule, and the method's templates with their shares, of every row."""
    spark = docs.sparkSession
    indexed = sorted({w for w, _, _, _ in index})
    # Equal ids with different texts stay apart, a null id is a value like any other.
    mark = F.xxhash64(F.col(key), F.coalesce(F.col(text), F.lit("")))
    lined = docs.select(F.col(key), mark.alias("_mark"), word_line(F.col(text)).alias("_words"))
    lined = lined.withColumn("_line", F.concat(F.lit(" "), F.col("_words"), F.lit(" ")))
    base = " (" + "|".join(PHRASES) + ")(?= )"
    pieces = F.split("_line", base, -1)

    def spaces(s: Column) -> Column:
        return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))

    # Every phrase holds this word.
    hits = F.when(F.contains("_words", F.lit("license")), F.regexp_extract_all("_line", F.lit(base), F.lit(1)))
    last = F.get("_hits", F.size("_hits") - 1)
    phrased = F.array_compact(
        F.array(*[F.when(F.contains("_line", F.lit(f" {p} ")), F.lit(name)) for name, p in sorted(MANDATORY.items())])
    )
    n_words = F.when(F.col("_words") == "", F.lit(0)).otherwise(spaces(F.col("_words")) + 1)
    # Placements count for templates whose phrase is there alone, so only those texts go further: the words of
    # the others are not kept, and the texts are read once.
    figures = (
        lined.withColumn("_hits", F.coalesce(hits, F.array().cast("array<string>"))).withColumn("_phrased", phrased)
        .withColumn("n_words", n_words.cast("long"))
        .select(
            key, "_mark", "n_words", F.size("_hits").cast("long").alias("n_base"),
            F.when(F.size("_hits") > 0, spaces(F.get(pieces, 0))).cast("long").alias("first_word"),
            F.when(
                F.size("_hits") > 0,
                F.col("n_words") - (spaces(F.get(pieces, F.size(pieces) - 1)) - 1) - spaces(last) - 1,
            ).cast("long").alias("last_word"),
            F.array_distinct(F.transform("_hits", lambda h: F.element_at(
                F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in pair]), h))).alias("base_labels"),
            "_phrased", F.when(F.size("_phrased") > 0, F.col("_words")).alias("_words"),
        )
    )
    figures = write_and_reload(figures, "licenses-figures")
    worded = figures.where("_words is not null").select("_mark", words_of(F.col("_words")).alias("_words"))
    postings = spark.createDataFrame(
        [(w, t, i) for w, t, i, _ in index], "_word string, template string, _at int"
    )  # a few words of each template
    sizes = {t: len({w for w, u, _, _ in index if u == t}) for t in TEMPLATES}
    size = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(sizes.items()) for x in pair]), F.col("template"))
    # Each file looks up all of its index words: the index has a few dozen, so no template is lost to another.
    chosen = F.array_intersect(_texts(indexed), F.col("_words"))
    placed = (
        worded.withColumn("_chosen", chosen).where(F.size("_chosen") > 1)
        .select("_mark", "_chosen", F.posexplode("_words").alias("_pos", "_word"))
        .where(F.array_contains("_chosen", F.col("_word"))).join(F.broadcast(postings), "_word")
        .groupBy("_mark", "template", (F.col("_pos") - F.col("_at")).alias("_shift"))
        .agg((F.size(F.collect_set("_word")) / size).alias("share"))
        .where(F.col("share") >= QUORUM)
        .groupBy("_mark", "template").agg(F.max("share").alias("share"))
        .groupBy("_mark").agg(F.array_sort(F.collect_list(F.struct("template", "share"))).alias("_found"))
    )
    return (
        figures.drop("_words").join(placed, "_mark", "left")
        .withColumn(
            "templates",
            F.filter(
                F.coalesce("_found", F.array().cast("array<struct<template:string,share:double>>")),
                lambda t: F.array_contains("_phrased", t["template"]),
            ),
        )
        .drop("_mark", "_found", "_phrased")
    )
