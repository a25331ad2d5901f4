"""License scan by diagonal voting, with DataFrame functions only.

Words: ASCII letters lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. All rolling
``K``-word grams of every text are hashed and joined to the positions of the
templates' grams. A match at text position i and template position j votes for the
diagonal i - j; votes are aggregated by document, template and diagonal. Neighbouring
diagonals (at most ``MERGE`` apart: words were inserted or dropped) are merged, and a
merged span is verified by its distinct template grams: a phrase needs all of them on one
diagonal, a longer notice at least ``LEAST_SHARE`` of them.

Templates are constants of this module, a few hundred grams in all, so their table is
broadcast. The texts are read twice, once for the grams and once for the word counts;
only matches are shuffled, after partial aggregation.

Defined results: null and empty texts have no words and no matches (score 0); repeated
rows each get the result of their text, as votes count distinct positions; extra columns
are ignored; a document is known by its id and the hash of its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.sources.seeds import literal_frame

from .common import materialize

K = 3
MERGE = 4
LEAST_SHARE = 0.6

# Base phrases with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Longer notices of common licenses with their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the"
     " gnu general public license as published by the free software foundation", "gpl"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and"
     " associated documentation files the software to deal in the software without restriction", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted"
     " provided that the following conditions are met", "bsd"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
)


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _grams(words: str) -> Column:
    """(position, gram hash) of all rolling grams, by zipping the words with their successors."""
    n = F.greatest(F.size(words) - (K - 1), F.lit(0))
    parts = [F.slice(words, i + 1, n) for i in range(K)]
    return F.posexplode(F.arrays_zip(*[p.alias(f"w{i}") for i, p in enumerate(parts)]))


def template_grams(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per template gram: gram, template, label, base, t_pos, t_grams."""
    rows = [(i, text, label, i < len(phrases)) for i, (text, label) in enumerate((*phrases, *notices))]
    texts = literal_frame(spark, rows, T.StructType.fromDDL("template int, text string, label string, base boolean"))
    return (
        texts.withColumn("words", words_of(F.col("text")))
        .select("template", "label", "base", (F.size("words") - (K - 1)).alias("t_grams"), _grams("words").alias("t_pos", "g"))
        .select("template", "label", "base", "t_grams", "t_pos", _hash().alias("gram"), F.col("g").alias("t_words"))
    )


def _hash() -> Column:
    return F.xxhash64(*[F.col(f"g.w{i}") for i in range(K)])


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: DataFrame | None = None) -> DataFrame:
    """Verified spans: doc_id, text_key, label, base, first_word, last_word, share.

    ``first_word`` and ``last_word`` are word positions from 0, both inclusive.
    """
    templates = template_grams(docs.sparkSession) if templates is None else templates
    grams = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), words_of(F.col(text)).alias("words")).select(
        "doc_id", "text_key", _grams("words").alias("pos", "g")
    )
    votes = materialize(
        grams.select("doc_id", "text_key", "pos", _hash().alias("gram"), "g")
        .join(F.broadcast(templates), "gram").where("g = t_words")  # verify on the words
        .groupBy("doc_id", "text_key", "template", "label", "base", "t_grams", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
        .agg(F.collect_set("t_pos").alias("hits")),  # at most the template's length
        "license-votes",
    )
    key = ["doc_id", "text_key", "template"]
    phrase = votes.where("base and size(hits) = t_grams").select(
        "doc_id", "text_key", "label", "base", F.col("diagonal").alias("first_word"),
        F.expr(f"diagonal + t_grams + {K - 2}").alias("last_word"), F.lit(1.0).alias("share"),
    )
    # neighbouring diagonals form one span; a gap of more than MERGE starts the next
    w = Window.partitionBy(*key).orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(w)
    merged = (
        votes.where("not base")
        .withColumn("opens", F.when(gap > MERGE, 1).otherwise(0))
        .withColumn("span", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "label", "base", "t_grams", "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("voted"),
            F.min(F.col("diagonal") + F.array_min("hits")).alias("first_word"),
            (F.max(F.col("diagonal") + F.array_max("hits")) + (K - 1)).alias("last_word"),
        )
    )
    notice = merged.withColumn("share", F.col("voted") / F.col("t_grams")).where(F.col("share") >= LEAST_SHARE).select(
        "doc_id", "text_key", "label", "base", "first_word", "last_word", "share"
    )
    return phrase.unionByName(notice)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: DataFrame | None = None) -> DataFrame:
    """One row per document: counts, first and last base place, labels, score (the
    largest verified share)."""
    found = (
        find_spans(docs, doc_id, text, templates).groupBy("doc_id", "text_key")
        .agg(
            F.count_if("base").alias("n_base"),
            F.min(F.when(F.col("base"), F.col("first_word"))).alias("first_word"),
            F.max(F.when(F.col("base"), F.col("first_word"))).alias("last_word"),
            F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
            F.collect_set("label").alias("labels"),
            F.max("share").alias("score"),
        )
        .withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"})
    )
    counted = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.size(words_of(F.col(text))).cast("long").alias("n_words"),
    )
    listed = lambda c: F.coalesce(F.concat_ws(",", F.array_sort(c)), F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    return counted.join(found, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        listed("base_labels").alias("base_labels"), listed("labels").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
