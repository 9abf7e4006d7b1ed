"""License scans by diagonal voting.

Every rolling k-gram of a document's words meets the positions of the template k-grams it equals; a match votes for its
diagonal, the document position minus the template position. Votes are counted per diagonal, neighbouring diagonals are
merged (a word more or less shifts the diagonal by one), and a merged span is verified by the share of the template's
words that it covers. Next to that the places of fixed phrases are found word by word.

Defined results: null or empty text has no words, no places, empty labels and score 0. Rows that share an id are
scanned each by its own text; equal rows stay as many as they were. Very long texts are scanned whole. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import plain_words, repeated, text_mark, with_window_hashes

K = 3
# Diagonals at most this far apart belong to one span, and a span must cover this share of its template's words.
NEIGHBOUR = 3
MIN_COVER = 0.7

# Phrases that name a license, as words, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Openings of public license notices as words, with their labels.
TEMPLATES = (
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction", "mit"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


def template_grams(spark: SparkSession, templates: tuple[tuple[str, str], ...] = TEMPLATES, k: int = K) -> DataFrame:
    """(gram_hash, gram, template, at, label, template_words) for each position; as many rows as the templates have words."""
    rows = [(i, text.split(), label) for i, (text, label) in enumerate(templates)]
    df = spark.createDataFrame(rows, "template int, words array<string>, label string")
    hashed = with_window_hashes(df, "words", (k,))
    placed = hashed.select("template", "label", "words", F.size("words").alias("template_words"), F.posexplode(f"w{k}").alias("at", "gram_hash"))
    return placed.withColumn("gram", F.array_join(F.slice("words", F.col("at") + 1, k), " ")).drop("words")


def phrase_places(words: str, phrases: dict[str, str] = PHRASES) -> Column:
    """(at, label) of every place where a phrase's words stand one after the other."""
    firsts = sorted({p.split()[0] for p in phrases})

    def label(at: Column) -> Column:
        chosen = None
        for phrase, name in phrases.items():
            parts = phrase.split()
            here = F.lit(True)
            for j, word in enumerate(parts):
                here = here & (F.get(words, at + j) == word)
            chosen = F.when(here, name) if chosen is None else chosen.when(here, name)
        return chosen

    starts = F.filter(F.transform(words, lambda w, i: F.when(w.isin(firsts), i)), lambda i: i.isNotNull())
    return F.filter(F.transform(starts, lambda i: F.struct(i.cast("long").alias("at"), label(i).alias("label"))), lambda p: p["label"].isNotNull())


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, k: int = K, min_cover: float = MIN_COVER,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, places (at, label) of phrases, spans (start, end, label, cover) of templates."""
    grams = template_grams(docs.sparkSession, templates, k)
    itself = docs.sparkSession.range(1).select(F.lit(-1).alias("template"), F.lit(None).cast("string").alias("label"), F.lit(0).alias("template_words"),
                                               F.lit(-1).alias("at"), F.lit(0).cast("long").alias("gram_hash"), F.lit("").alias("gram"))
    grams = F.broadcast(grams.unionByName(itself))
    words = docs.select(F.col(id_col).alias("id"), text_mark(F.col(text_col)).alias("mark"), plain_words(F.col(text_col)).alias("words"))
    hashed = with_window_hashes(words, "words", (k,)).withColumn("places", phrase_places("words"))
    rows = hashed.select("id", "mark", "words", "places", F.posexplode(F.concat(F.array(F.lit(0).cast("long")), F.col(f"w{k}"))).alias("place", "doc_hash"))
    same = F.col("gram") == F.array_join(F.slice("words", F.greatest(F.col("place"), F.lit(1)), k), " ")
    votes = rows.join(grams, (F.col("doc_hash") == F.col("gram_hash")) & F.when(F.col("place") == 0, F.col("template") == -1)
                      .otherwise((F.col("template") >= 0) & same))
    own = F.col("template") == -1
    votes = votes.select("id", "mark", "template", "label", "template_words", "at", (F.col("place") - 1).alias("pos"),
                         F.when(own, F.size("words")).alias("n_words"), F.when(own, F.col("places")).alias("places"),
                         F.when(~own, F.col("place") - 1 - F.col("at")).alias("diagonal")).repartition("id", "mark")
    diagonals = votes.groupBy("id", "mark", "template", "diagonal").agg(
        F.count("*").alias("votes"), F.collect_set("at").alias("ats"), F.min("pos").alias("first"), F.max("pos").alias("last"),
        F.max("label").alias("label"), F.max("template_words").alias("template_words"), F.max("n_words").alias("n_words"),
        F.first("places", ignorenulls=True).alias("places"))
    order = Window.partitionBy("id", "mark", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > NEIGHBOUR).cast("int")
    merged = diagonals.withColumn("apart", F.coalesce(apart, F.lit(0))).withColumn("band", F.sum("apart").over(order))
    bands = merged.groupBy("id", "mark", "template", "band").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.flatten(F.collect_list("ats")).alias("ats"),
        F.max("label").alias("label"), F.max("template_words").alias("template_words"), F.max("n_words").alias("n_words"),
        F.first("places", ignorenulls=True).alias("places"), F.max("votes").alias("votes"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + k - 1)))))
    judged = bands.withColumn("cover", F.when(F.col("template") >= 0, covered / F.col("template_words")))
    span = F.struct(F.col("first").cast("long").alias("start"), (F.col("last") + k).cast("long").alias("end"), "label", "cover")
    # The row of the document itself votes once for each of its equal rows.
    per_doc = judged.groupBy("id", "mark").agg(
        F.max(F.when(F.col("template") == -1, F.col("votes"))).alias("copies"), F.max("n_words").alias("n_words"),
        F.first("places", ignorenulls=True).alias("places"),
        F.array_sort(F.collect_list(F.when((F.col("template") >= 0) & (F.col("cover") >= min_cover), span))).alias("spans"))
    return repeated(per_doc, "copies").select(F.col("id").alias(id_col), F.col("n_words").cast("long"), "places", "spans")
