"""License notices by exact set-similarity join of text blocks with templates.

A template is matched by `WIDTH` times its words in a row, across lines, if they hold at
least `CONTAINMENT` of its distinct words. Blocks are twice the longest such window, one
window apart, so every window lies within a block. On request a block is a line of a text
instead, however long, and matches as a whole. All words of templates are ordered by the number of
documents that hold them, over the whole corpus. If a template of n words needs k of them,
a matching block holds one of its n - k + 1 rarest words, so only blocks with such a word
are joined with that template, by word. A block with too few template words for k, or
whose words after the shared one are too few, is dropped; all others are compared as sets,
and then every window of those that hold enough.

The base finds fixed phrases as consecutive words and is independent of the templates.

Everything is a built-in expression. Counting the template words sends at most one row
per template word to the driver; blocks without a rare template word never leave their
scan; the templates' prefix table is as long as the templates.

Rows: null and empty texts have no words, no labels and score 0. Repeated rows are scanned
one by one. Columns of the input other than id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words, phrases and their labels.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notices as their licenses give them.
TEMPLATES = {
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction",
    ],
    "apache-2": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ],
    "gpl-3": ["This work is licensed under the GNU General Public License, version 3"],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation",
    ],
    "mpl-2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted",
    ],
}
CONTAINMENT = 0.9
WIDTH = 2


def _separated(text: Column) -> Column:
    """The words of a text, in lower case, each with one blank before and the last after.

    Lower case is by the whole of Unicode; that changes no word border, and no character
    outside ASCII becomes a letter of a phrase or template.
    """
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BETWEEN_WORDS, " ")
    trimmed = F.trim(spaced)
    return F.when(trimmed == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), trimmed, F.lit(" ")))


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_places(docs: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """(doc_id, tag, n_words, n_base, first_word, last_word, base_labels) of each row.

    `tag` is a hash of the text. A word's number is the number of blanks before it.
    """
    spaced = docs.select("doc_id", "tag", _separated(F.col("text")).alias("_spaced"))
    counts, firsts, lasts, labels = [], [], [], []
    n_words = F.greatest(_blanks(F.col("_spaced")) - 1, F.lit(0))
    backward = F.reverse("_spaced")
    for phrase, label in phrases.items():
        held = F.contains("_spaced", F.lit(f" {phrase} "))
        counts.append(F.when(held, F.regexp_count("_spaced", F.lit(f" {phrase}(?= )"))).otherwise(0))
        before = F.substr("_spaced", F.lit(1), F.instr("_spaced", f" {phrase} ") - 1)
        after = F.substr(backward, F.lit(1), F.instr(backward, f" {phrase[::-1]} ") - 1)
        firsts.append(F.when(held, _blanks(before)))
        lasts.append(F.when(held, n_words - _blanks(after) - len(phrase.split())))
        labels.append(F.when(held, F.lit(label)))
    return spaced.select(
        "doc_id",
        "tag",
        n_words.cast("long").alias("n_words"),
        sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base_labels"),
    )


def words_of(template: str) -> list[str]:
    """Distinct words of a template (ASCII), in their order."""
    return list(dict.fromkeys(_all_words(template)))


def _all_words(template: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in template.lower()).split()


def window_of(template: str) -> int:
    """Words in a row that may match a template: its own, and as many between them."""
    return WIDTH * len(_all_words(template))


def template_matches(
    docs: DataFrame,
    templates: dict[str, list[str]] = TEMPLATES,
    containment: float = CONTAINMENT,
    lines: bool = False,
) -> DataFrame:
    """(doc_id, tag, block, label, containment): every block that meets the threshold.

    Blocks are stretches of words, looked at by windows, or else `lines`.
    """
    spark = docs.sparkSession
    known = sorted({w for texts in templates.values() for t in texts for w in words_of(t)})
    words = F.split(_separated(F.col("text")), " ")
    held = docs.select(F.explode(F.array_intersect(words, F.lit(known))).alias("word"))
    n_docs = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}
    rank = {w: i for i, w in enumerate(sorted(known, key=lambda w: (n_docs.get(w, 0), w)))}

    prefixes = []
    for label, texts in templates.items():
        for number, text in enumerate(texts):
            own = sorted(words_of(text), key=rank.__getitem__)
            needed = math.ceil(containment * len(own) - 1e-9)
            for place, word in enumerate(own[: len(own) - needed + 1]):
                prefixes.append((word, label, number, place, needed, own, window_of(text)))
    table = spark.createDataFrame(
        prefixes, "word string, label string, number int, place int, needed int, own array<string>, window int"
    )
    rare = sorted({p[0] for p in prefixes})
    least = min(p[4] for p in prefixes)

    # Words of a block that stand in templates, in the global order.
    ordered = F.lit(sorted(known, key=rank.__getitem__))
    if lines:
        cut = docs.select("doc_id", "tag", F.posexplode(F.split("text", "\n")).alias("block", "line")).select(
            "doc_id", "tag", "block", F.split(_separated(F.col("line")), " ").alias("_words")
        )
    else:
        step = max(window_of(t) for texts in templates.values() for t in texts)
        last = F.greatest(F.ceil(F.size("_all") / step).cast("int") - 2, F.lit(0))
        stretches = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("_all", i * step + 1, 2 * step))
        cut = docs.select("doc_id", "tag", words.alias("_all")).select(
            "doc_id", "tag", F.posexplode(stretches).alias("block", "_words")
        )
    blocks = cut.where(F.arrays_overlap("_words", F.lit(rare))).select(
        "doc_id", "tag", "block", "_words", F.array_intersect(ordered, "_words").alias("_held")
    )
    probes = (
        blocks.where(F.size("_held") >= least)
        .withColumn("word", F.explode(F.array_intersect("_held", F.lit(rare))))
        .withColumn("_place", F.array_position("_held", F.col("word")).cast("int") - 1)
    )
    joined = probes.join(table, "word")
    left = 1 + F.least(F.size("own") - F.col("place") - 1, F.size("_held") - F.col("_place") - 1)
    # Only the first shared word of a block and a template leads to a match, so each comes once.
    shared = F.array_intersect("_held", "own")
    matches = joined.where(
        (F.size("_held") >= F.col("needed")) & (left >= F.col("needed"))
    ).where((F.size(shared) >= F.col("needed")) & (F.get(shared, F.lit(0)) == F.col("word")))
    if lines:
        best = F.size(shared)
    else:
        starts = F.sequence(F.lit(1), F.size("_words"))
        held_from = lambda i: F.size(F.array_intersect("own", F.slice("_words", i, F.col("window"))))
        best = F.array_max(F.transform(starts, held_from))
    counted = matches.withColumn("_best", best).where(F.col("_best") >= F.col("needed"))
    return counted.select("doc_id", "tag", "block", "label", (F.col("_best") / F.size("own")).alias("containment"))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lines: bool = True) -> DataFrame:
    """Per document: words, base phrases and their places, labels of both kinds, score.

    The score is the best containment found, or 1 where a base phrase stands. With `lines`,
    a notice has to stand in one line; without, as in op6, it may be wrapped.
    """
    given = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tag"),
        F.col(text).alias("text"),
    )
    found = (
        template_matches(given, lines=lines)
        .groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"))
        .agg(F.collect_set("label").alias("_labels"), F.max("containment").alias("_best"))
    )
    base = phrase_places(given)
    joined = base.join(found, base["doc_id"].eqNullSafe(found["_id"]) & (base["tag"] == found["_tag"]), "left")
    more = F.coalesce("_labels", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )
