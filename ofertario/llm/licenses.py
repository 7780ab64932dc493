r"""License scan by diagonal voting, in DataFrame functions only.

Every text becomes its words; the rolling hashes of k following words are joined
with the positions that the templates have them at. A hit votes for the diagonal
text position - template position. Votes are summed by diagonal, neighbouring
diagonals are merged (a word put in or left out shifts the diagonal by one), and a
merged span counts if the template's words are covered well enough. Where repeated words
chain diagonals to more than a notice's width, each diagonal is a span of its own.
Templates have any length.

Words: A-Z lower-cased, runs without ASCII marks and white space. Base phrases must
stand consecutively, which is a full diagonal; their labels are always kept.

Defined results: null and empty texts have no words, no places, empty labels and
score 0; rows that repeat doc_id and text get equal rows; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ofertario.llm.common import only
from ofertario.session import written

#: Words in a rolling hash: the shortest phrase has two.
K = 2
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases whose places are counted, and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Wordings of license notices, matched in part, and their labels.
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("gnu lesser general public license", "lgpl"),
    ("this program is free software you can redistribute it and or modify it under the terms", "gpl"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("all rights reserved", "all-rights-reserved"),
]


def words_of(text: Column) -> Column:
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, SEPARATORS), "")


def template_grams(spark: SparkSession, base: list, notices: list, k: int) -> DataFrame:
    """template, label, is_base, grams, place, gram: a row for each k-gram of each template."""
    rows = []
    for number, (phrase, label) in enumerate([*base, *notices]):
        words = phrase.split()
        grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
        if not grams:
            raise ValueError(f"a template needs {k} words: {phrase}")
        rows += [(number, label, number < len(base), len(grams), i, g) for i, g in enumerate(grams)]
    kinds = "template int, label string, is_base boolean, grams int, place int, template_gram string"
    return spark.createDataFrame(rows, kinds)


def scan(
    docs: DataFrame,
    base: list = BASE,
    notices: list = NOTICES,
    k: int = K,
    slack: int = 2,
    cover: float = 0.75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Verified spans: doc_id, text_hash, label, is_base, start, end (words), score.

    ``slack``: diagonals up to so far apart are neighbours. ``cover``: the share of a
    notice's k-grams that a span must have; base phrases need all on one diagonal.
    """
    cols = only(docs, doc_id=id_col, text=text_col)
    # As many rows as the templates have k-grams.
    templates = F.broadcast(
        template_grams(docs.sparkSession, base, notices, k).withColumn("hash", F.xxhash64("template_gram"))
    )
    worded = cols.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    gram = lambda i: F.concat_ws(" ", *[F.get("words", i + j) for j in range(k)])
    grams = F.transform(F.sequence(F.lit(0), F.size("words") - k), gram)
    rolled = worded.where(F.size("words") >= k).select("doc_id", "text_hash", F.posexplode(grams).alias("at", "gram"))
    hits = rolled.withColumn("hash", F.xxhash64("gram")).join(templates, "hash")
    hits = hits.where(F.col("gram") == F.col("template_gram"))
    doc, template = ["doc_id", "text_hash"], ["template", "label", "is_base", "grams"]
    diagonals = hits.groupBy(*doc, *template, (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("covered"), F.min("at").alias("start"), F.max("at").alias("last")
    )
    diagonals = diagonals.where(~F.col("is_base") | (F.size("covered") == F.col("grams")))
    in_order = Window.partitionBy(*doc, *template).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(in_order)
    alone = F.col("is_base") | F.coalesce(apart > slack, F.lit(True))
    merged = diagonals.withColumn("alone", alone.cast("int")).withColumn("span", F.sum("alone").over(in_order))
    together = Window.partitionBy(*doc, *template, "span")
    wide = F.max("last").over(together) + k - F.min("start").over(together) > 2 * (F.col("grams") + k)
    merged = merged.withColumn("piece", F.when(wide, F.col("diagonal")))
    spans = merged.groupBy(*doc, *template, "span", "piece").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("covered"),
        F.min("start").cast("long").alias("start"),
        (F.max("last") + k).cast("long").alias("end"),
    )
    score = F.col("covered") / F.col("grams")
    return (
        spans.withColumn("score", score)
        .where(F.col("score") >= cover)
        .select(*doc, "label", "is_base", "start", "end", "score")
    )


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    cols = only(docs, doc_id=id_col, text=text_col)
    spans = scan(docs, id_col=id_col, text_col=text_col, **options)
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    of_base = lambda c: F.when(F.col("is_base"), F.col(c))
    found = spans.groupBy("doc_id", "text_hash").agg(
        F.count(of_base("start")).alias("n_base"),
        F.min(of_base("start")).alias("first_word"),
        F.max(of_base("start")).alias("last_word"),
        listed(of_base("label")).alias("base_labels"),
        listed("label").alias("labels"),
        F.max("score").alias("score"),
    )
    found = written(found, "licenses").withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    counted = cols.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    return counted.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
