"""License scan by diagonal voting, as DataFrame operations only.

Every rolling word k-gram of every document is hash-joined to the positions at
which license templates hold that k-gram. A hit votes for the diagonal
(document position minus template position). Votes are summed per diagonal,
neighbouring diagonals of one template are merged (so inserted or missing words
do not break a match), and a span counts when it covers enough of its template.
The k-gram words themselves are compared in the join, so a full diagonal is an
exact occurrence of its template.

The template table has a fixed size (the templates below), so it is broadcast.

Defined cases: a null or empty text has no words, no places and empty labels; a
repeated row is a document of its own (one result row each); null ids are kept;
any other columns of the input are ignored, whatever their names; an empty table
gives an empty result; a document of one word has no k-gram and so no hit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 2
#: Least share of a template's k-grams that a merged span must cover.
COVERAGE = 0.6
#: Diagonals of one template this many words apart or less are merged.
NEIGHBOUR = 3

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases of the contract, each counted at every exact place.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Openings of well-known public license notices, as plain words.
NOTICES = [
    (
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation",
        "gpl",
    ),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license",
        "apache",
    ),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
        "mit",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        "bsd",
    ),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
]


def template_rows(k: int = K) -> list[tuple]:
    """(template, label, is_phrase, n_grams, position, w0..wk-1) of every template k-gram."""
    out = []
    for i, (text, label) in enumerate(PHRASES + NOTICES):
        ws = text.split()
        for p in range(len(ws) - k + 1):
            out.append((i, label, i < len(PHRASES), len(ws) - k + 1, p, *ws[p : p + k]))
    return out


def lower_ascii(text):
    """Lower-case A-Z. ``lower`` also maps other letters, which never makes a
    word of plain letters out of one that was not, but for U+212A (it becomes
    'k'), which is replaced by another letter first."""
    return F.lower(F.replace(text, F.lit("K"), F.lit("ĸ")))


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score and spans (template label, start, end, coverage)."""
    spark, k = docs.sparkSession, K
    grams = ", ".join(f"w{i} string" for i in range(k))
    templates = spark.createDataFrame(
        template_rows(k), f"template int, label string, is_phrase boolean, n_grams int, t_pos int, {grams}"
    ).withColumn("h", F.xxhash64(*[f"w{i}" for i in range(k)]))

    ws = docs.select(
        F.col(id_col).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD), F.lit(0)).alias("ws"),
    ).select("doc_id", "row", "ws", F.size("ws").cast("long").alias("n_words"))
    shifted = [F.col("ws") if i == 0 else F.slice("ws", i + 1, F.greatest(F.size("ws"), F.lit(1))) for i in range(k)]
    rolled = ws.select(
        "doc_id",
        "row",
        "n_words",
        F.posexplode_outer(F.arrays_zip(*[c.alias(f"g{i}") for i, c in enumerate(shifted)])).alias("pos", "g"),
    ).select("doc_id", "row", "n_words", "pos", F.xxhash64(*[f"g.g{i}" for i in range(k)]).alias("gh"), "g")
    exact = F.col("gh") == F.col("h")
    for i in range(k):
        exact &= F.col(f"g.g{i}") == F.col(f"w{i}")
    # the first position (or the empty row) of a document stands for it when it has no hit
    votes = (
        rolled.join(F.broadcast(templates), exact, "left")
        .filter("template is not null or pos is null or pos = 0")
        .groupBy("row", "doc_id", "n_words", "template", "label", "is_phrase", "n_grams", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
        .agg(F.collect_set("t_pos").alias("covered"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    )
    by_template = Window.partitionBy("row", "template").orderBy("diagonal")
    near = F.col("is_phrase") | ((F.col("diagonal") - F.lag("diagonal").over(by_template)) > NEIGHBOUR)
    spans = (
        votes.withColumn("run", F.sum(F.coalesce(near, F.lit(True)).cast("int")).over(by_template))
        .groupBy("row", "doc_id", "n_words", "template", "label", "is_phrase", "n_grams", "run")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("n_covered"),
            F.min("low").cast("long").alias("start"),
            (F.max("high") + k).cast("long").alias("end"),
        )
        .withColumn("part", F.round(F.col("n_covered") / F.col("n_grams"), 6))
        # a span much longer than its template is scattered words, not a notice
        .withColumn(
            "verified",
            F.when(F.col("is_phrase"), F.col("n_covered") == F.col("n_grams")).otherwise(
                (F.col("part") >= coverage) & (F.col("end") - F.col("start") <= 2 * (F.col("n_grams") + k - 1))
            ),
        )
    )
    base = F.col("verified") & F.col("is_phrase")

    def joined(values):
        return F.concat_ws(",", F.array_sort(values))

    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).cast("long").alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set(F.when(F.col("verified"), F.col("label")))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("verified"), F.col("part"))), F.lit(0.0)).alias("score"),
        F.array_sort(
            F.collect_list(F.when(F.col("verified"), F.struct("start", "end", "label", F.col("part").alias("coverage"))))
        ).alias("spans"),
    ).drop("row")
