"""License scan by diagonal voting.

Every rolling word k-gram of every text is hashed and joined with the
positions that it has in templates. A match at word p of the text and word q of
a template votes for the diagonal p - q, which is where that template would
start. Votes are counted by (text, template, diagonal); neighbouring diagonals
of a template are merged (words put in or left out move the diagonal a little).
A merged span is verified by its words: those that its k-grams agree in must be a
large enough share of the template's, and few other words may stand between
them. Where spans overlap, each word of the text goes to the span with most
words of its template (then the larger share of them); a span that keeps less
than half of its words doesn't hold, so of two notices that differ by a word only
the one that is there does.

Phrases and notices of few words use bigrams, longer notices four-word grams.
Phrases of the base rule hold only whole, so each of their places is one diagonal
with all votes; they don't compete. The templates are a fixed list, so their
table (one row per k-gram) is broadcast; texts' k-grams are joined where they
are made and only matches, and one row per text, are shuffled, by text.

Defined results: null and empty texts have no words, no places and score 0;
repeated rows each get a row; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltway.llm.words import WordHashes, rolling, word_hash

# The phrases of the base rule and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Well-known license notices, label and text.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND',
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Text is available under the Creative Commons Attribution-ShareAlike License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
    ),
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

SHORT, LONG = 2, 4
#: Notices of at least so many words use long grams.
MANY_WORDS = 16
#: A span holds with at least this share of its template's words; diagonals so near are merged.
SHARE, GAP = 0.7, 3
#: Lower-cases A-Z and makes every byte outside words a space.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isdigit() or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
GRAMS = "row long, doc_id long, n_words long, hashes array<long>"
MOST_WORDS = 400_000
#: Joins with one row of the templates' table, so that each text keeps a row.
PRESENT = 1


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def templates() -> list[tuple[int, int, int, int, int, str, bool]]:
    """(hash, k, position, words of the template, template number, label, base) rows."""
    rows = [(PRESENT, 0, 0, 0, -1, "", False)]
    listed = [(label, text, True) for text, label in PHRASES.items()] + [(label, text, False) for label, text in NOTICES]
    for number, (label, text, base) in enumerate(listed):
        words = words_of(text.encode())
        k = LONG if len(words) >= MANY_WORDS else SHORT
        grams = rolling(np.array([word_hash(w) for w in words], np.uint64), k)
        rows += [(int(h), k, at, len(words), number, label, base) for at, h in enumerate(grams)]
    return rows


TEMPLATES = "hash long, k int, at int, size int, template int, label string, base boolean"
#: One row of a text and one template.
OF_TEMPLATE = ("row", "doc_id", "n_words", "template", "label", "base", "k", "size")


def grams(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """row, doc_id, n_words and the hashes of all its bigrams, then of all its four-word grams, then PRESENT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()

        def made(rows: list, docs: list, counts: list, parts: list) -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, parts)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts)))
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(docs, pa.int64()), pa.array(counts, pa.int64()), lists], names=["row", "doc_id", "n_words", "hashes"])

        for batch in batches:
            rows, docs, counts, parts = [], [], [], []
            for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_binary()).to_pylist(), strict=True):
                words = words_of(text)
                own = known.of(words)
                rows.append(row)
                docs.append(doc)
                counts.append(len(words))
                parts.append(np.concatenate([rolling(own, SHORT), rolling(own, LONG), np.array([PRESENT], np.int64)]))
                if sum(counts) > MOST_WORDS:
                    yield made(rows, docs, counts, parts)
                    rows, docs, counts, parts = [], [], [], []
            if rows:
                yield made(rows, docs, counts, parts)

    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(run, GRAMS)


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(templates(), TEMPLATES)


def votes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """OF_TEMPLATE, diagonal and positions (of the template's k-grams found on it)."""
    spread = grams(docs, id_column, text_column).select("row", "doc_id", "n_words", F.posexplode("hashes").alias("index", "hash"))
    shorts = F.greatest(F.col("n_words") - (SHORT - 1), F.lit(0))
    word = F.when(F.col("k") == LONG, F.col("index") - shorts).otherwise(F.col("index"))
    hits = spread.join(F.broadcast(template_table(docs.sparkSession)), "hash").select(
        *OF_TEMPLATE, F.when(F.col("k") == 0, 0).otherwise(word - F.col("at")).alias("diagonal"), "at"
    )
    return hits.groupBy(*OF_TEMPLATE, "diagonal").agg(F.collect_set("at").alias("positions"))


def spans(docs: DataFrame, share: float = SHARE, gap: int = GAP, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Verified spans, overlapping ones too: OF_TEMPLATE, span, start, first, last (words of the text), found, coverage.

    A row of template -1 stands for each text.
    """
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > F.when(F.col("base"), 0).otherwise(gap)).cast("int")
    numbered = votes(docs, id_column, text_column).withColumn("span", F.sum(F.coalesce(apart, F.lit(0))).over(order))
    words = F.flatten(F.transform("positions", lambda at: F.sequence(at, at + F.greatest(F.col("k"), F.lit(1)) - 1)))
    merged = numbered.groupBy(*OF_TEMPLATE, "span").agg(
        F.min("diagonal").alias("start"),
        F.min(F.col("diagonal") + F.array_min("positions")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("positions") + F.col("k") - 1).alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list(words)))).alias("found"),
    )
    foreign = F.col("last") - F.col("first") + 1 - F.col("found")
    held = F.when(F.col("template") < 0, True).when(F.col("base"), F.col("found") == F.col("size"))
    held = held.otherwise((F.col("found") >= share * F.col("size")) & (foreign <= (1 - share) * F.col("size") + gap))
    coverage = F.when(F.col("template") < 0, 0.0).otherwise(F.col("found") / F.col("size"))
    return merged.filter(held).withColumn("coverage", coverage)


def settled(found: DataFrame) -> DataFrame:
    """The spans, but for those of notices that lose more than half of their words to better ones."""
    own = (F.col("template") < 0) | F.col("base")
    key = F.struct("template", "span")
    placed = found.withColumn("word", F.explode(F.when(own, F.array(F.lit(None).cast("long"))).otherwise(F.sequence("first", "last"))))
    place = Window.partitionBy("row", "word", F.when(own, key))
    best = F.max(F.struct("found", "coverage", (-F.col("template")).alias("template"), (-F.col("span")).alias("span"))).over(place)
    wins = (best["template"] == -F.col("template")) & (best["span"] == -F.col("span"))
    counted = placed.withColumn("won", wins.cast("int")).groupBy(*OF_TEMPLATE, "span", "start", "first", "last", "found", "coverage")
    return counted.agg(F.sum("won").alias("won"), F.count("*").alias("words")).filter("2 * won >= words").drop("won", "words")


def scanned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base_start = F.when(F.col("base"), F.col("start"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    real = F.when(F.col("template") >= 0, F.col("label"))
    return (
        settled(spans(docs, id_column=id_column, text_column=text_column))
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.count(base_start).alias("n_base"),
            F.min(base_start).cast("long").alias("first_word"), F.max(base_start).cast("long").alias("last_word"),
            joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined(real).alias("labels"), F.max("coverage").alias("score"),
        )
        .drop("row")
    )
