"""License scans by diagonal voting. DataFrame functions only.

Every text is lower-cased (A-Z) and split into words; all rolling word pairs and triples are hashed and joined to the positions of
the same grams in the templates (a broadcast table of fixed size). A hit votes for the diagonal word position - template
position. Votes are counted by (document, template, diagonal); diagonals at most ``SHIFT`` words apart are merged, so an
inserted or lost word does not break a match; a merged span is verified by the share of the template's grams that it holds and
by its length. The base phrases are templates of one gram: each of their votes is a place.

Rows of one doc_id and one text share their votes, which are counted as sets, so repeated rows get the same answer each.
Defined cases: null or empty text has no words and no labels; a null doc_id is matched as a value; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SHIFT = 3
SHARE = 0.6             # of a template's grams in a verified span
LENGTHS = (0.6, 1.5)    # of a span, against its template
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases, as (label, words)
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
#: Openings of public license texts and notices, as (label, words)
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
            "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
            "merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
               "you may obtain a copy of the license at"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
            "published by the free software foundation"),
    ("gpl", "distributed under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
            "conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
            "that the above copyright notice and this permission notice appear in all copies"),
    ("cc", "this work is licensed under a creative commons attribution"),
)


def lowered(text: Column) -> Column:
    """A-Z to a-z. lower() also turns the Kelvin sign and the dotted capital I into ASCII letters; texts with those go by letter."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(text.rlike("[Kİ]"), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(lowered(text), F.lit("")), SEPARATORS), "")


def template_grams(spark: SparkSession, templates=TEMPLATES, base=BASE) -> DataFrame:
    """h, at: each gram's hash with all its places (tpl, label, tpos, gram, grams of the template, words of it, base or not)."""
    rows = []
    for n, (is_base, label, text) in enumerate([(True, *x) for x in base] + [(False, *x) for x in templates]):
        w = text.split()
        k = len(w) if is_base else 3
        for i in range(len(w) - k + 1):
            rows.append((n, label, i, w[i], w[i + 1], w[i + 2] if k > 2 else None, len(w) - k + 1, len(w), is_base))
    t = spark.createDataFrame(rows, "tpl int, label string, tpos int, g0 string, g1 string, g2 string, grams int, words int, base boolean")
    at = F.struct("tpl", "label", "tpos", "g0", "g1", "g2", "grams", "words", "base")
    return t.select(F.xxhash64("g0", "g1", "g2").alias("h"), at.alias("at")).groupBy("h").agg(F.collect_list("at").alias("at"))


def votes(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """doc_id, th, pos, at.*: every gram of every text that stands in a template."""
    w = docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("w"))
    n = F.size("w")
    zipped = F.arrays_zip(F.col("w").alias("w0"), F.slice("w", F.lit(2), n).alias("w1"), F.slice("w", F.lit(3), n).alias("w2"))
    rolled = w.filter(n > 1).select("doc_id", "th", F.posexplode(zipped).alias("pos", "g")).select(
        "doc_id", "th", "pos", F.col("g.w0").alias("w0"), F.col("g.w1").alias("w1"), F.col("g.w2").alias("w2"))
    pairs = F.broadcast(grams.filter(F.exists("at", lambda a: a.g2.isNull())).select(F.col("h").alias("h2"), F.col("at").alias("at2")))
    triples = F.broadcast(grams.filter(F.exists("at", lambda a: a.g2.isNotNull())).select(F.col("h").alias("h3"), F.col("at").alias("at3")))
    hit = (rolled.join(pairs, F.xxhash64("w0", "w1", F.lit(None).cast("string")) == F.col("h2"), "left")
           .join(triples, F.xxhash64("w0", "w1", "w2") == F.col("h3"), "left").filter("h2 IS NOT NULL OR h3 IS NOT NULL"))
    none = F.array().cast(grams.schema["at"].dataType)
    both = F.concat(F.coalesce("at2", none), F.coalesce("at3", none))
    same = (F.col("a.g0") == F.col("w0")) & (F.col("a.g1") == F.col("w1")) & (F.col("a.g2").isNull() | (F.col("a.g2") == F.col("w2")))
    return hit.select("doc_id", "th", "pos", "w0", "w1", "w2", F.explode(both).alias("a")).filter(same).select(
        "doc_id", "th", F.col("pos").cast("bigint").alias("pos"), "a.tpl", "a.label", "a.tpos", "a.grams", "a.words", "a.base")


def spans(found: DataFrame) -> DataFrame:
    """doc_id, th, label, share: verified spans of templates that are not base phrases."""
    diagonal = found.filter("NOT base").groupBy("doc_id", "th", "tpl", "label", "grams", "words", (F.col("pos") - F.col("tpos")).alias("diag")).agg(
        F.collect_set("tpos").alias("held"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    w = W.partitionBy("doc_id", "th", "tpl").orderBy("diag")
    new = F.when(F.col("diag") - F.lag("diag").over(w) <= SHIFT, 0).otherwise(1)
    run = diagonal.withColumn("new", new).withColumn("run", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    merged = run.groupBy("doc_id", "th", "tpl", "run", "label", "grams", "words").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"), (F.max("last") - F.min("first") + 3).alias("length"))
    ok = (F.col("held") >= F.ceil(F.col("grams") * SHARE)) & F.col("length").between(
        F.floor(F.col("words") * LENGTHS[0]), F.ceil(F.col("words") * LENGTHS[1]) + SHIFT)
    return merged.filter(ok).select("doc_id", "th", "label", (F.col("held") / F.col("grams")).alias("share"))


def op8_licenses(docs: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of ``docs``."""
    found = votes(docs, template_grams(docs.sparkSession, templates, base))
    places = found.filter("base").groupBy("doc_id", "th", "pos", "label").agg(F.lit(1).alias("n"))
    per_base = places.select("doc_id", "th", "label", "pos", F.lit(True).alias("base"), F.lit(1.0).alias("share"))
    per_span = spans(found).select("doc_id", "th", "label", F.lit(None).cast("bigint").alias("pos"), F.lit(False).alias("base"), "share")
    said = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    per_doc = per_base.union(per_span).groupBy("doc_id", "th").agg(
        F.count("pos").cast("bigint").alias("n_base"), F.min("pos").alias("first_word"), F.max("pos").alias("last_word"),
        said(F.when(F.col("base"), F.col("label"))).alias("base_labels"), said("label").alias("labels"), F.max("share").alias("score"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))
    hits = per_doc.withColumnsRenamed({"doc_id": "hit_id", "th": "hit_th"})
    out = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("th") == F.col("hit_th")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word", "last_word",
                      F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score"))
