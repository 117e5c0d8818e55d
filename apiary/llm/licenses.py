"""License scans by diagonal voting.

Words of a text (runs of letters, digits and characters beyond ASCII, A-Z
lower-cased) form rolling pairs; the hash of each pair is joined to the
positions of the same pair in the license templates (a fixed table of a few
hundred rows, broadcast). A match votes for its diagonal, word number minus
template position. Votes are summed by document, template and diagonal;
neighbouring diagonals (words inserted or left out) are merged into a span. A span
is verified by the share of the template's places it holds, each counted once
however often its pair is repeated, and by its length: a span much longer than the
template counts with its best diagonal alone. Matches compare the words themselves
next to the hash, so no vote is false.

Base phrases must stand word for word: all pairs of the phrase on one
diagonal. The longer templates are found from ``LEAST`` of their pairs.

DataFrame functions only; one shuffle, of the votes.

Defined cases: a null text counts as empty; without words all counts are 0 and
the labels are empty strings; overlapping places all count; repeated rows each
give a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apiary.llm.common import ascii_lower

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Well-known sentences of public license notices, in the scan's words.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-notice",
    "this work is licensed under a creative commons attribution": "creative-commons",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
    "on an as is basis without warranties or conditions of any kind either express or implied": "apache-2.0",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose": "gpl-notice",
}
# Least share of a notice's pairs that a span holds, and how far apart diagonals may lie to merge.
LEAST = 0.8
NEIGHBOUR = 3
# Words of a template, at most; its places are kept as bits of numbers of MARK bits.
MARK = 62
LONGEST = 2 * MARK


def template_pairs(spark: SparkSession, base: Mapping[str, str], notices: Mapping[str, str]) -> DataFrame:
    """One row per word pair of each template."""
    rows = []
    for number, (phrase, label, is_base) in enumerate(
        [(p, x, True) for p, x in base.items()] + [(p, x, False) for p, x in notices.items()]
    ):
        words = phrase.split()
        if len(words) < 2:
            raise ValueError(f"a template needs two words: {phrase!r}")
        if len(words) > LONGEST:
            raise ValueError(f"a template has at most {LONGEST} words: {phrase!r}")
        rows += [(number, label, is_base, len(words) - 1, i, words[i], words[i + 1]) for i in range(len(words) - 1)]
    return spark.createDataFrame(
        rows, "_template int, _label string, _base boolean, _pairs int, _at int, _w0 string, _w1 string"
    ).withColumn("_hash", F.xxhash64("_w0", "_w1"))


def scan(docs: DataFrame, base: Mapping[str, str] = BASE_PHRASES, notices: Mapping[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    spark = docs.sparkSession
    pairs = template_pairs(spark, base, notices)
    words = F.filter(F.split(ascii_lower(text_col), SEPARATORS), lambda w: w != "")
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), words.alias("_words")
    ).withColumn("_n", F.size("_words").cast("long"))
    # The pair that starts at word i; the last entry (an empty second word) pairs with nothing and keeps the document.
    second = F.concat(F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))), F.array(F.lit("")))
    zipped = F.arrays_zip(F.concat("_words", F.when(F.size("_words") == 0, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))).alias("_w0"), second.alias("_w1"))
    rolling = rows.select("_row", "_id", "_n", F.posexplode(zipped).alias("_i", "_pair")).select(
        "_row", "_id", "_n", "_i", F.col("_pair._w0").alias("_w0"), F.col("_pair._w1").alias("_w1")
    )
    matched = rolling.withColumn("_hash", F.xxhash64("_w0", "_w1")).join(
        F.broadcast(pairs), ["_hash", "_w0", "_w1"], "left"
    ).where("_template is not null or _i = 0")
    # Which places of the template a diagonal has met, as bits.
    marks = [
        F.when(F.col("_at").between(k * MARK, k * MARK + MARK - 1), F.expr(f"shiftleft(1L, _at - {k * MARK})"))
        for k in range(LONGEST // MARK)
    ]
    votes = matched.groupBy("_row", "_template", "_label", "_base", "_pairs", (F.col("_i") - F.col("_at")).alias("_diagonal")).agg(
        F.count("_at").alias("_votes"),
        *[F.bit_or(mark).alias(f"_seen{k}") for k, mark in enumerate(marks)],
        F.min("_i").alias("_from"),
        F.max("_i").alias("_to"),
        F.first("_id").alias("_id"),
        F.first("_n").alias("_n"),
    )
    by_diagonal = Window.partitionBy("_row", "_template").orderBy("_diagonal")
    apart = F.col("_diagonal") - F.lag("_diagonal").over(by_diagonal) > F.when(F.col("_base"), 0).otherwise(NEIGHBOUR)
    spans = (
        votes.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("_span", F.sum("_new").over(by_diagonal))
        .groupBy("_row", "_template", "_label", "_base", "_pairs", "_span")
        .agg(
            F.max("_votes").alias("_votes"),
            sum(F.bit_count(F.coalesce(F.bit_or(f"_seen{k}"), F.lit(0).cast("long"))) for k in range(len(marks))).alias("_places"),
            (F.max("_to") - F.min("_from") + 1).alias("_long"),
            F.min("_diagonal").alias("_diagonal"),
            F.first("_id").alias("_id"),
            F.first("_n").alias("_n"),
        )
    )
    # A span counts each place of its template once, and must not be much longer than it; of a longer one
    # the best diagonal alone counts.
    met = F.when(F.col("_long") <= 2 * F.col("_pairs") + NEIGHBOUR, F.col("_places")).otherwise(F.col("_votes"))
    share = met / F.col("_pairs")
    place = F.col("_base") & (F.col("_votes") == F.col("_pairs"))
    found = place | (~F.col("_base") & (share >= LEAST))
    out = spans.groupBy("_row").agg(
        F.first("_id").alias("doc_id"),
        F.first("_n").alias("n_words"),
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("_diagonal").cast("long"))).alias("first_word"),
        F.max(F.when(place, F.col("_diagonal").cast("long"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(place, F.col("_label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(found, F.col("_label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(found, F.when(F.col("_base"), F.lit(1.0)).otherwise(share))), F.lit(0.0)).alias("score"),
    )
    return out.drop("_row")
