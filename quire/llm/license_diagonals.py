"""License scan by diagonal voting.

Templates (phrases, notices and whole license texts) are cut into rolling word pairs, a
table of one row per template position. Every rolling word pair of every document is joined
to it by hash (the words themselves are compared too, so a vote is exact). A hit of document
place p on template place t votes for the diagonal p - t. Words put in or left out shift the
diagonal, so neighbouring diagonals are merged: a band is a diagonal and all those up to
``width`` after it, about half the template's length (none for a phrase). A band is verified
by the distinct template positions its votes cover: all of them for a phrase, the share
``COVERAGE`` for others; a position counts once however often it is hit. Overlapping verified
bands are one span. No vote is dropped before bands are merged.

Everything is DataFrame expressions. The template table is a constant of a few hundred
rows; only hits, a small part of the pairs, are shuffled, once, by document.

Defined results: a null or empty text has no words and no labels; every place of a
phrase counts, overlapping or repeated; a null ``doc_id`` stays null; repeated rows give
a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.batches import documents

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COVERAGE = 0.6

# The phrases whose places are reported, and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Openings of widely used public license notices, and their labels.
NOTICES = [
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl"),
]

# Whole license texts without title and copyright line, and their labels.
TEXTS = [
    (
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
        COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "mit",
    ),
    (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
        ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.""",
        "isc",
    ),
    (
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
        LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
        "bsd",
    ),
]


def template_words(text: str) -> list[str]:
    return [w for w in re.split(NOT_WORD, text.translate(str.maketrans(UPPER, LOWER))) if w]


def templates() -> list[tuple[int, str, bool, list[str]]]:
    """``(number, label, is a phrase, words)``."""
    rows = [(t, label, True) for t, label in PHRASES] + [(t, label, False) for t, label in NOTICES + TEXTS]
    return [(i, label, phrase, template_words(t)) for i, (t, label, phrase) in enumerate(rows)]


def band_width(phrase: bool, words: int) -> float:
    """How far the diagonals of a band may lie apart: half the pairs, down to a power of two
    (so ``diagonal / width`` is exact), at least 4; below 1, that is none, for a phrase."""
    return 0.5 if phrase else float(max(4, 1 << ((words - 1) // 2).bit_length() - 1))


def template_positions(spark) -> DataFrame:
    rows = [
        (i, label, phrase, len(w) - 1, band_width(phrase, len(w)), at, a, b)
        for i, label, phrase, w in templates() for at, (a, b) in enumerate(zip(w, w[1:]))
    ]
    df = spark.createDataFrame(rows, "template int, label string, phrase boolean, pairs int, width double, t int, t_a string, t_b string")
    return df.withColumn("gram", F.xxhash64("t_a", "t_b"))


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, NOT_WORD), lambda w: w != "")


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score`` and ``spans``, the verified spans
    ``(label, first word, template, coverage)``."""
    docs = documents(df, id_col, text_col).select("doc_id", F.monotonically_increasing_id().alias("row"), words_of(F.col("text")).alias("words"))
    n = F.size("words")
    pair = lambda a, b: F.struct(F.xxhash64(a, b).alias("gram"), a.alias("a"), b.alias("b"))
    pairs = F.when(n > 1, F.zip_with(F.slice("words", F.lit(1), n - 1), F.slice("words", F.lit(2), n - 1), pair))
    # The first entry, a null, stands for the document itself.
    empty = F.array(F.lit(None).cast("struct<gram:bigint,a:string,b:string>"))
    rolled = docs.select("doc_id", "row", n.cast("long").alias("n_words"), F.posexplode(F.concat(empty, F.coalesce(pairs, F.array()))).alias("p", "x"))
    hits = (
        rolled.join(F.broadcast(template_positions(df.sparkSession)), F.col("x.gram") == F.col("gram"), "left")
        .where("x is null or (x.a = t_a and x.b = t_b)")
        .select("row", "doc_id", "n_words", "template", "label", "phrase", "pairs", "width", "t", (F.col("p") - 1 - F.col("t")).alias("diagonal"))
        .repartition("row")
    )
    need = F.when(F.col("phrase"), 1.0).otherwise(COVERAGE)
    covered = lambda over: F.size(F.collect_set("t").over(over)) / F.col("pairs")
    whole = Window.partitionBy("row", "template")
    band = whole.orderBy(F.col("diagonal") / F.col("width")).rangeBetween(Window.currentRow, 1)
    itself = F.col("template").isNull()
    # A document that lacks too many positions anywhere has no band of the template.
    able = hits.withColumn("coverage", covered(whole)).where(itself | (F.col("coverage") >= need))
    bands = (
        able.withColumn("coverage", covered(band))
        .where(itself | (F.col("coverage") >= need))
        .groupBy("row", "template", "diagonal")
        .agg(*[F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "phrase", "width", "coverage")])
    )
    # Overlapping bands are one span; a phrase's place stands alone.
    beside = whole.orderBy("diagonal")
    opens = F.coalesce(F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(beside) > F.col("width")), F.lit(True)).cast("int")
    spans = (
        bands.withColumn("opens", opens)
        .withColumn("span", F.sum("opens").over(beside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("row", "template", "span")
        .agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("label").alias("label"),
            F.first("phrase").alias("phrase"), F.min("diagonal").alias("at"), F.max("coverage").alias("coverage"),
        )
    )
    base = F.when(F.col("phrase"), F.greatest(F.col("at"), F.lit(0)).cast("long"))
    found = F.when(F.col("template").isNotNull(), F.struct(F.col("label"), F.col("at"), F.col("template"), F.col("coverage")))
    return spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.count(base).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(found)).alias("spans"),
    ).drop("row")
