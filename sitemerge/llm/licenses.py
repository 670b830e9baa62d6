"""License scan by diagonal voting.

Words are the runs of ASCII digits, letters and non-ASCII characters of the text
with A-Z lower-cased.  Every rolling word 2-gram and 3-gram of a document is
hashed, exploded and joined to the positions of the templates' grams (a
parameter, a few hundred rows).  A hit votes for its diagonal, document position minus
template position; all grams of a phrase on one diagonal are a place where the
phrase stands.  For license texts, neighbouring diagonals (inserted or deleted
words) are merged, and the span under the strongest diagonal is verified
against the template by edit distance.

A document's hits and one marker row are the only rows that are shuffled, by a
row number, so one document's hits meet in a task and no text is shuffled.

Defined results: a null or empty text has 0 words, no label and score 0; every
row is a document, repeated or not; null ids stay; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import long_list, string_list, text_slices

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 bytes with A-Z lower-cased
SHORT, LONG = 2, 3  # gram sizes; phrases of two words need the short one
CLOSE = 10  # a text of fewer words must stand exactly: one word tells licenses apart
MARK = -1  # gram hash of the marker row
MIX = {SHORT: 0x9E3779B97F4A7C15, LONG: 0xC2B2AE3D27D4EB4F}


@dataclass(frozen=True)
class Template:
    """``exact``: a phrase, each place counts.  Else a text to find nearly."""

    label: str
    text: str
    exact: bool = False


# The base phrases and their labels.
BASE = (Template("cc-by", "cc by", True), Template("gpl", "general public license", True),
        Template("reserved", "all rights reserved", True))
# Usual notices of public licenses.
NOTICES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "you may not use this file except in compliance with the License"),
    Template("mit", "Released under the MIT License"),
    Template("mit", "Licensed under the MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                    "software and associated documentation files"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, "
                    "are permitted provided that the following conditions are met"),
    Template("gpl-notice", "This work is licensed under the GNU General Public License"),
    Template("gpl-notice", "This program is free software: you can redistribute it and/or modify it under "
                           "the terms of the GNU General Public License"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    Template("cc-by-4.0", "Licensed under CC BY 4.0"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)


def words_of(text: str | None) -> list[bytes]:
    return WORDS.findall((text or "").encode().lower())


class _WordHash(dict):
    """Word -> 64-bit hash, remembered; emptied when large."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, from their word hashes (uint64)."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=np.uint64)
        for i in range(k):
            out = (out ^ words[i:i + n]) * np.uint64(MIX[k])
            out ^= out >> np.uint64(29)
    return out


def _grams(batches):
    """(doc_id, text) -> doc_id, words, n_words, grams: the marker, then all
    2-grams, then all 3-grams."""
    known = _WordHash()
    mark = np.array([MARK], dtype=np.int64)
    for batch in batches:
        for part in text_slices(batch, "text", 1 << 20):
            words, counts, grams, sizes = [], [], [], []
            for text in part.column("text").to_pylist():
                ws = words_of(text)
                h = np.fromiter(map(known.__getitem__, ws), dtype=np.uint64, count=len(ws))
                made = [mark, gram_hashes(h, SHORT).view(np.int64), gram_hashes(h, LONG).view(np.int64)]
                words += ws
                counts.append(len(ws))
                grams += made
                sizes.append(sum(map(len, made)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), string_list(words, np.array(counts)), pa.array(counts, pa.int64()),
                 long_list(np.concatenate(grams), np.array(sizes))],
                names=["doc_id", "words", "n_words", "grams"])


def template_grams(templates) -> list[tuple]:
    """(hash, template number, position, gram size) of all template grams;
    phrases and texts of two words use 2-grams, all others 3-grams."""
    known, out = _WordHash(), []
    for t, template in enumerate(templates):
        h = np.array([known[w] for w in words_of(template.text)], dtype=np.uint64)
        if len(h) < SHORT:
            raise ValueError(f"template {template.text!r} has fewer than {SHORT} words")
        k = min(LONG, len(h))
        out += [(int(g), t, i, k) for i, g in enumerate(gram_hashes(h, k).view(np.int64))]
    return out


def find_spans(docs: DataFrame, templates, id_col: str = "doc_id", text_col: str = "text",
               similarity: float = 0.8, slack: int = 3) -> DataFrame:
    """One row per document and, where templates are found, per span: ``_row``,
    doc_id, n_words and template (number; null on the document's marker row),
    start (word, from 0), score."""
    spark = docs.sparkSession
    sizes = [len(words_of(t.text)) for t in templates]
    if len(templates) > 10_000:
        raise ValueError("the gram table is broadcast: 10,000 templates at most")
    grams = spark.createDataFrame(template_grams(templates), "hash long, t int, at int, k int")
    texts = spark.createDataFrame(
        [(i, s, " ".join(w.decode() for w in words_of(t.text)), t.exact)
         for i, (t, s) in enumerate(zip(templates, sizes))],
        "t int, size int, body string, exact boolean")
    grams = grams.join(F.broadcast(texts.select("t", "size", "exact")), "t")
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(_grams, docs_schema(docs, id_col))
            .withColumn("_row", F.monotonically_increasing_id()))
    hit = rows.select("_row", "doc_id", "n_words", "words", F.posexplode("grams").alias("i", "hash"))
    hit = hit.join(F.broadcast(grams), "hash", "left").where("t is not null or i = 0")
    # element 0 is the marker, then n_words - 1 2-grams (none for n_words < 2)
    pos = F.when(F.col("k") == SHORT, F.col("i") - 1).otherwise(
        F.col("i") - 1 - F.greatest(F.col("n_words") - 1, F.lit(0)))
    fits_k = (F.col("k") == SHORT) == (F.col("i") <= F.greatest(F.col("n_words") - 1, F.lit(0)))
    diag = (pos - F.col("at")).cast("int")
    window = F.when(~F.col("exact"), F.array_join(
        F.slice("words", F.greatest(diag, F.lit(0)) + 1, F.col("size")), " "))
    votes = (hit.where("t is null or i > 0").select(
        "_row", "doc_id", "n_words", "t", "size", "exact", "k", diag.alias("diag"), pos.alias("pos"),
        window.alias("window"), F.coalesce(fits_k, F.lit(True)).alias("ok")).where("ok")
        .repartition("_row"))
    by_diag = votes.groupBy("_row", "doc_id", "n_words", "t", "size", "exact", "k", "diag").agg(
        F.count(F.lit(1)).alias("hits"), F.max("window").alias("window"))
    # neighbouring diagonals of a text are one island; phrases stay apart
    w = Window.partitionBy("_row", "t").orderBy("diag")
    gap = F.col("diag") - F.lag("diag").over(w)
    islands = by_diag.withColumn("new", F.when(F.col("exact") | gap.isNull() | (gap > slack), 1).otherwise(0))
    islands = islands.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy("_row", "doc_id", "n_words", "t", "size", "exact", "k", "island").agg(
        F.sum("hits").alias("hits"),
        F.max(F.struct("hits", F.col("diag"), "window")).alias("best"))
    spans = spans.join(F.broadcast(texts.select(F.col("t").alias("_t"), "body")),
                       F.col("t") == F.col("_t"), "left")
    grams_in = F.col("size") - F.col("k") + 1
    enough = F.col("hits") * 3 >= grams_in
    found = F.col("best.window")
    near = 1 - F.levenshtein(found, F.col("body")) / F.greatest(F.length(found), F.length("body"), F.lit(1))
    score = (F.when(F.col("exact"), F.when(F.col("hits") == grams_in, F.lit(1.0)).otherwise(F.lit(0.0)))
             .when(enough, near).otherwise(F.lit(0.0)))
    spans = spans.withColumn("score", score)
    # rejected spans keep no template, but a document's marker row stays
    needed = F.when(F.col("size") < CLOSE, F.lit(1.0)).otherwise(F.lit(similarity))
    return spans.where(F.col("t").isNull() | (F.col("score") >= needed)).select(
        "_row", "doc_id", "n_words", F.col("t").alias("template"),
        F.greatest(F.col("best.diag"), F.lit(0)).alias("start"), "score")


def docs_schema(docs: DataFrame, id_col: str) -> str:
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    return f"doc_id {kind}, words array<string>, n_words long, grams array<long>"


def _labels(names: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(names)), ",")


def scan_licenses(docs: DataFrame, base=BASE, notices=NOTICES, id_col: str = "doc_id",
                  text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score and ``spans`` (label, start, score)."""
    templates = [*base, *notices]
    spans = find_spans(docs, templates, id_col, text_col, similarity)
    label = F.when(F.col("template").isNotNull(), F.get(
        F.array(*[F.lit(t.label) for t in templates]), F.col("template")))
    is_base = F.col("template") < len(base)
    got = spans.withColumn("label", label)
    return got.groupBy("_row", "doc_id", "n_words").agg(
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
        _labels(F.collect_set(F.when(is_base, F.col("label")))).alias("base_labels"),
        _labels(F.collect_set("label")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("template").isNotNull(), F.col("score"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("template").isNotNull(), F.struct(
            F.col("start"), F.col("label"), F.col("score"))))).alias("spans"),
    ).drop("_row")
