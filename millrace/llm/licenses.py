"""License scans: phrases, and an exact set-similarity join with license templates.

A text block is a stretch of consecutive words of about a template's length, across line ends: a
template of m words is looked for in every stretch of m words and a fifth more. A block matches if it
holds at least CONTAINMENT of the template's different words. Template words are ordered by how
many documents have them, rarest first. A block that reaches the threshold must hold one of the
first ``size - needed + 1`` words of the template, so texts join templates on places of these
prefix words only. A place is dropped by length if too few template words stand within a block's
length of it, and by position if too few of those are as common as its word or more: blocks with a
rarer word are found from that word's place. What remains is compared exactly, block by block.

The templates are the fixed set below, so their table is broadcast. Every block of every
text is looked at. Phrases are places where their words stand one after the other; phrase
labels always stay. Null and empty texts have no words, no labels and score 0. Repeated rows
are reported each; only key and text are read, so other columns do not matter.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BETWEEN_WORDS, ascii_lower, once, whole

CONTAINMENT = 0.9
#: Words of a block, as a multiple of the template's.
BLOCK_LENGTH = 1.2

# Phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# License notices as their authors publish them.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall(r"[a-z0-9]+", text.lower())))


def split(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def ordered_vocabulary(docs: DataFrame, text: str, vocabulary: list[str]) -> list[str]:
    """The templates' words, the rarest in the documents first; one row a word reaches the driver."""
    held = F.array_intersect(split(ascii_lower(whole(F.col(text).cast("string")))), F.lit(vocabulary))
    counts = {r["word"]: r["count"] for r in docs.select(F.explode(held).alias("word")).groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda word: (counts.get(word, 0), word))


def block_words(text: str) -> int:
    """Words of the blocks that are held against a template."""
    return math.ceil(BLOCK_LENGTH * len(re.findall(r"[a-z0-9]+", text.lower())) - 1e-9)


def template_rows(order: list[str], templates: list[tuple[str, str]], containment: float) -> list[tuple]:
    """``(word, at, label, needed, width, wanted)``: a row for each prefix word of a template, whose
    different words ``wanted`` are in the common order."""
    rank = {word: i for i, word in enumerate(order)}
    rows = []
    for label, text in templates:
        wanted = sorted(template_words(text), key=rank.__getitem__)
        needed = math.ceil(containment * len(wanted) - 1e-9)
        for at in range(len(wanted) - needed + 1):
            rows.append((wanted[at], at, label, needed, block_words(text), wanted))
    return rows


def places(words: Column, phrase: str) -> Column:
    """Where the words of a phrase stand one after the other."""
    parts = phrase.split()
    fits = F.size(words) >= len(parts)
    found = F.filter(
        F.sequence(F.lit(0), F.size(words) - len(parts)),
        lambda at: reduce(Column.__and__, [F.get(words, at + k) == part for k, part in enumerate(parts)]),
    )
    return F.when(fits, found).otherwise(F.array().cast("array<int>"))


def scan(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    templates: list[tuple[str, str]] | None = None,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``(key, n_words, n_base, first_word, last_word, base_labels, labels, score)`` for each row."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({word for _, notice in templates for word in template_words(notice)})
    order = ordered_vocabulary(docs, text, vocabulary)
    rows = template_rows(order, templates, containment)
    table = spark.createDataFrame(rows, "word string, at int, label string, needed int, width int, wanted array<string>")
    prefix = F.lit(sorted({row[0] for row in rows})).cast("array<string>")
    reach = max((row[4] for row in rows), default=1)

    none = F.array().cast("array<int>")
    lowered = docs.select(
        F.col(key).alias("doc"),
        once(
            lowered=ascii_lower(whole(F.col(text).cast("string"))),
            text_hash=F.xxhash64(F.col(text).cast("string")),
        ).alias("p"),
    ).select("doc", "p.*")
    words = lowered.select("doc", "text_hash", "lowered", once(words=split(F.col("lowered"))).alias("p")).select(
        "doc", "text_hash", "lowered", "p.words"
    )
    last_words = sorted({phrase.split()[-1] for phrase in PHRASES})
    may = reduce(Column.__or__, [F.contains("lowered", F.lit(word)) for word in last_words])
    # Places of prefix words, each with the words within a block's length of it.
    held = F.when(F.arrays_overlap("words", prefix), F.filter(
        F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(prefix, F.get("words", i))
    )).otherwise(none)
    found = F.transform(held, lambda i: F.struct(
        F.get("words", i).alias("word"), F.least(i, F.lit(reach - 1)).alias("lead"),
        F.slice("words", F.greatest(i - (reach - 1), F.lit(0)) + 1, 2 * reach - 1).alias("near"),
    ))
    # A place without a word, one for each document, meets no template: no document is lost.
    nowhere = F.array(F.struct(F.lit(None).cast("string").alias("word"), F.lit(0).alias("lead"), none.cast("array<string>").alias("near")))
    based = words.select(
        "doc", "text_hash", F.size("words").cast("long").alias("n_words"),
        once(
            found=found,
            **{label: F.when(may, places(F.col("words"), phrase)).otherwise(none) for phrase, label in PHRASES.items()},
        ).alias("p"),
    ).select(
        "doc", "text_hash", "n_words", F.col("p.found").alias("found"),
        F.concat(*[F.col(f"p.{label}") for label in PHRASES.values()]).alias("base"),
        F.array_compact(F.array(*[F.when(F.size(f"p.{x}") > 0, x) for x in sorted(PHRASES.values())])).alias("base_labels"),
    ).select(
        "doc", "text_hash", "n_words", "base_labels", F.size("base").cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"), F.array_max("base").cast("long").alias("last_word"),
        F.explode(F.concat(nowhere, "found")).alias("c"),
    )
    own = ["doc", "text_hash", "n_words", "base_labels", "n_base", "first_word", "last_word"]
    joined = based.select(*own, "c.*").join(F.broadcast(table), "word", "left")
    first = F.greatest(F.col("lead") - F.col("width") + 1, F.lit(0))
    close = F.slice("near", first + 1, F.col("lead") - first + F.col("width"))
    common = F.array_intersect("wanted", close)
    as_common = F.size(F.array_intersect(F.slice("wanted", F.col("at") + 1, F.size("wanted")), close))
    blocks = F.transform(
        F.sequence(first, F.col("lead")), lambda i: F.size(F.array_intersect("wanted", F.slice("near", i + 1, F.col("width"))))
    )
    likely = (F.size(common) >= F.col("needed")) & (as_common >= F.col("needed"))
    overlap = F.when(likely, F.array_max(blocks))
    met = joined.withColumn("overlap", overlap).where(F.col("word").isNull() | (F.col("overlap") >= F.col("needed"))).select(
        *own, "label", F.coalesce(F.col("overlap") / F.size("wanted"), F.lit(0.0)).alias("share")
    )
    return (
        met.groupBy(*own)
        .agg(
            F.count_if(F.col("label").isNull()).alias("copies"),
            F.array_compact(F.collect_set("label")).alias("found"), F.max("share").alias("share"),
        )
        .select(
            F.col("doc").alias(key), "n_words", "n_base", "first_word", "last_word",
            F.concat_ws(",", "base_labels").alias("base_labels"),
            F.concat_ws(",", F.array_sort(F.array_union("base_labels", "found"))).alias("labels"),
            F.when(F.col("n_base") > 0, 1.0).otherwise(F.col("share")).alias("score"),
            F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
        )
        .drop("copy")
    )
