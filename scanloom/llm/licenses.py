"""License scan by an exact set-similarity join, in DataFrame operations only.

Texts are cut into overlapping blocks of words. The tokens of all templates are ordered by their frequency in the
whole corpus, rarest first. A block that holds the asked share of a template shares one of the template's rarest
tokens (prefix), has enough tokens (length), and has enough tokens left after the first shared one (position); what
passes is verified by intersection.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.llm.base import LOWER, UPPER, documents, fresh, lower_ascii

# Characters between words, and phrases with their labels.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices, as they stand in files and on pages.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike International License"),
]
THRESHOLD_PERCENT = 85
BLOCK_WORDS = 64


def normal(text: Column) -> Column:
    """Lower-cased words with one space between them and at both ends; a lone space for a text without words."""
    return F.regexp_replace(F.concat(F.lit(" "), lower_ascii(F.coalesce(text, F.lit(""))), F.lit(" ")), GAP, " ")


def spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _phrase_places(words: Column, n_words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """Number of places of a phrase, and first words of the first and the last of them."""
    whole = f" {phrase} "
    has = F.contains(words, F.lit(whole))
    count = F.when(has, F.regexp_count(words, F.lit(f"(?<= )(?={re.escape(phrase)} )"))).otherwise(0)
    first = F.when(has, spaces(F.substring_index(words, whole, 1)))
    after = F.reverse(F.substring_index(F.reverse(words), whole[::-1], 1))
    last = F.when(has, n_words - spaces(after) - len(phrase.split()))
    return count.cast("bigint"), first.cast("bigint"), last.cast("bigint")


def template_tokens(templates: Sequence[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    """Label and distinct tokens of each template."""
    out = []
    for label, text in templates:
        lower = text.translate(str.maketrans(UPPER, LOWER))
        out.append((label, sorted({w for w in re.split(GAP, lower) if w})))
    return [t for t in out if t[1]]


def ordered_tokens(words: DataFrame, vocabulary: list[str]) -> list[str]:
    """Tokens of the templates, rarest in the corpus first; counted over all rows of ``words`` (array ``tokens``)."""
    wanted = F.array(*map(F.lit, vocabulary))
    counts = words.select(F.explode(F.array_intersect("tokens", wanted)).alias("token")).groupBy("token").count().collect()  # at most the vocabulary
    seen = {r["token"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda t: (seen.get(t, 0), t))


def similar_blocks(docs: DataFrame, id_cols: list[str], words_col: str, templates: Sequence[tuple[str, str]], percent: int = THRESHOLD_PERCENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id_cols, block, template, label, containment) of every block that holds at least ``percent`` of a template's tokens."""
    known = template_tokens(templates)
    block_words = max([block_words, *(2 * len(t) for _, t in known)])
    tokens = docs.select(*id_cols, F.split(F.trim(words_col), " ").alias("tokens"))
    vocabulary = ordered_tokens(tokens, sorted({t for _, ts in known for t in ts}))
    rank = {t: i for i, t in enumerate(vocabulary)}
    rows, prefixes = [], []
    for k, (label, ts) in enumerate(known):
        ts = sorted(ts, key=rank.__getitem__)
        need = -(-len(ts) * percent // 100)
        rows.append((k, label, ts, need))
        prefixes += [(t, k, i, len(ts), need) for i, t in enumerate(ts[:len(ts) - need + 1])]
    spark = docs.sparkSession
    table = spark.createDataFrame(rows, "template int, label string, wanted array<string>, need int")
    prefix = spark.createDataFrame(prefixes, "token string, template int, at int, n int, need int")
    ordered = F.array(*map(F.lit, vocabulary))
    first = F.array(*map(F.lit, sorted({p[0] for p in prefixes})))

    step = block_words // 2
    number = F.greatest(F.ceil(F.size("tokens") / step) - 1, F.lit(1)).cast("int")
    blocks = tokens.filter(F.arrays_overlap("tokens", first)).select(
        *id_cols, F.explode(F.transform(F.sequence(F.lit(0), number - 1), lambda i: F.struct(i.alias("block"), F.slice("tokens", i * step + 1, block_words).alias("own")))).alias("x"))
    held = blocks.select(*id_cols, "x.block", F.array_intersect(ordered, F.col("x.own")).alias("own")).filter(F.arrays_overlap("own", first))
    listed = held.select(*id_cols, "block", "own", F.posexplode("own").alias("place", "token"))
    left = F.least(F.col("n") - F.col("at"), F.size("own") - F.col("place"))
    candidates = listed.join(prefix, "token").filter((left >= F.col("need")) & (F.size("own") >= F.col("need"))).select(*id_cols, "block", "own", "template").distinct()
    shared = F.size(F.array_intersect("own", "wanted"))
    return candidates.join(table, "template").withColumn("shared", shared).filter("shared >= need").select(
        *id_cols, "block", "template", "label", (F.col("shared") / F.size("wanted")).alias("containment"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None, templates: Sequence[tuple[str, str]] | None = None, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``id_col``, n_words, n_base, first_word, last_word, base_labels, labels, score, and matched (block, label and
    containment of each similar block) for every row.

    Null and empty texts have no words. Rows that repeat id and text share their blocks; a null id is an id of its
    own. ``score`` is 1 where a phrase stands, else the largest containment that reaches the threshold, else 0.
    Other columns are ignored. Empty table: no rows.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rows = docs.select(F.col(id_col), key.alias("_id"), F.xxhash64(text_col).alias("_copy"), normal(F.col(text_col)).alias("_words"))
    n = spaces(F.col("_words")) - 1
    places = [(label, *_phrase_places(F.col("_words"), F.col("n_words"), p)) for p, label in sorted(phrases.items(), key=lambda x: x[1])]
    counts = rows.withColumn("n_words", F.greatest(n, F.lit(0)).cast("bigint")).select(
        id_col, "_id", "_copy", "n_words",
        F.array(*[F.struct(F.lit(label).alias("label"), c.alias("n"), f.alias("first"), l.alias("last")) for label, c, f, l in places]).alias("_found"))
    similar = similar_blocks(rows.filter("_words <> ' '"), ["_id", "_copy"], "_words", templates, percent).groupBy("_id", "_copy").agg(
        F.collect_set(F.struct("block", "label", "containment")).alias("matched"), F.max("containment").alias("_best"))
    joined = counts.join(similar, ["_id", "_copy"], "left")
    hit = F.filter("_found", lambda x: x["n"] > 0)
    base = F.array_distinct(F.transform(hit, lambda x: x["label"]))
    n_base = F.aggregate(hit, F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    more = F.coalesce(F.transform("matched", lambda x: x["label"]), F.array().cast("array<string>"))
    return joined.select(
        id_col, "n_words", n_base.alias("n_base"), F.array_min(F.transform(hit, lambda x: x["first"])).alias("first_word"),
        F.array_max(F.transform(hit, lambda x: x["last"])).alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"), F.coalesce("matched", F.array().cast("array<struct<block:int,label:string,containment:double>>")).alias("matched"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).drop("matched")
