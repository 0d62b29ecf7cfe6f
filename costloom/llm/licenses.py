"""License phrases and texts found by diagonal voting, in DataFrame operations only.

Every word position of every document is a row with its word and the ones that
follow. It is joined with the templates' positions on the hash of its rolling
k-gram; a hit votes for the diagonal (place in the document less place in the
template). Votes are summed per document, template and diagonal, neighbouring
diagonals (a word more or less) are merged, and the merged spans verified by
the share of the template they cover. Phrases must be there word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept

# Phrases of the contract.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences of public licences, and the label each stands for.
TEXTS = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc", "This work is licensed under a Creative Commons Attribution"),
    ("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced"),
]

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
K_PHRASE = 2  # words hashed for a phrase
K_TEXT = 4  # words hashed for a text: the first two and the next two
SHIFT = 3  # diagonals so far apart are one span
COVER = 0.6  # least share of a text's k-grams


def words(text: Column) -> Column:
    """Lower-cased words of a text. Folding more than A-Z changes no ASCII word and no word's bounds."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def templates(spark: SparkSession, phrases: dict[str, str], texts: list[tuple[str, str]]) -> DataFrame:
    """Rows (template, label, exact, n, pos, w1..w4) of all positions of a k-gram; w3, w4 are NULL for phrases."""
    rows = [(i, label, True, text) for i, (text, label) in enumerate(phrases.items())]
    rows += [(len(rows) + i, label, False, text) for i, (label, text) in enumerate(texts)]
    df = spark.createDataFrame(rows, "template int, label string, exact boolean, text string").withColumn("w", words(F.col("text")))
    grams = F.size("w") - F.when(F.col("exact"), K_PHRASE).otherwise(K_TEXT) + 1
    df = df.withColumn("n", grams).filter("n > 0").withColumn("pos", F.explode(F.sequence(F.lit(1), F.col("n"))))
    at = lambda i: F.get("w", F.col("pos") + (i - 1))
    later = lambda i: F.when(~F.col("exact"), at(i))
    return df.select("template", "label", "exact", "n", F.size("w").alias("size"), (F.col("pos") - 1).alias("pos"), at(0).alias("w1"), at(1).alias("w2"), later(2).alias("w3"), later(3).alias("w4")).withColumn("hash", F.xxhash64("w1", "w2"))


def matches(docs: DataFrame, table: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Positions of every row of ``docs`` that meet a template's, and one row without a template for its first place.

    Columns row (a number of its own for every row), doc_id, n_words, place, and
    those of the template. ``table`` comes from ``templates``: the given licences,
    not data, so it is broadcast. Written once, as all that follows starts here.
    """
    w = words(F.col(text))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), w.alias("w"))
    rolled = rows.select("row", "doc_id", F.size("w").alias("n_words"), F.posexplode_outer(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.size("w")).alias("b"), F.slice("w", 3, F.size("w")).alias("c"), F.slice("w", 4, F.size("w")).alias("d"))).alias("place", "g"))
    rolled = rolled.select("row", "doc_id", "n_words", "place", *[F.col(f"g.{c}").alias(c) for c in "abcd"]).withColumn("key", F.xxhash64("a", "b"))
    same = (F.col("key") == F.col("hash")) & (F.col("a") == F.col("w1")) & (F.col("b") == F.col("w2"))
    same &= F.col("exact") | ((F.col("c") == F.col("w3")) & (F.col("d") == F.col("w4")))
    found = rolled.join(F.broadcast(table), same, "left").filter("template is not null or place is null or place = 0")
    return kept(found.select("row", "doc_id", "n_words", "place", "template", "label", "exact", "n", "size", "pos"), "license-hits")


def spans(hits: DataFrame, cover: float = COVER) -> DataFrame:
    """Verified spans (row, label, exact, first, last, share) of ``matches``: words from 0, ``last`` the span's last word."""
    keys = ["row", "template", "label", "exact", "n", "size"]
    voted = hits.filter("template is not null").withColumn("diagonal", F.col("place") - F.col("pos")).groupBy(*keys, "diagonal").agg(F.count(F.lit(1)).alias("votes"), F.min("place").alias("low"), F.max("place").alias("high"))
    # Phrases stand on one diagonal; texts may lose or gain words between two.
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(by) > SHIFT), F.lit(True)).cast("int")
    chained = voted.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    merged = chained.groupBy(*keys, "span").agg(F.sum("votes").alias("votes"), F.min("low").alias("first"), F.max("high").alias("high"))
    share = F.least(F.lit(1.0), F.col("votes") / F.col("n"))
    last = F.col("high") + F.when(F.col("exact"), K_PHRASE - 1).otherwise(K_TEXT - 1)
    found = merged.withColumns({"share": share, "last": last})
    sure = F.when(F.col("exact"), F.col("votes") == F.col("n")).otherwise((F.col("share") >= cover) & (F.col("last") - F.col("first") < 2 * F.col("size")))
    return found.filter(sure).select("row", "label", "exact", "first", "last", "share")


def digest(docs: DataFrame) -> DataFrame:
    """Per document the places of phrases, their labels, all labels, and the best share of a template.

    A NULL text is an empty one; a row without an id is searched like others, and
    repeated rows give repeated results.
    """
    hits = matches(docs.select("doc_id", "text"), templates(docs.sparkSession, PHRASES, TEXTS))
    found = spans(hits)
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    best = found.groupBy("row").agg(
        F.sum(F.col("exact").cast("long")).alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("first"))).cast("long").alias("last_word"),
        labels(F.when(F.col("exact"), F.col("label"))).alias("base_labels"),
        labels(F.col("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    rows = hits.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.greatest(F.first("n_words"), F.lit(0)).cast("long").alias("n_words"))
    out = rows.join(best, "row", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
