"""License scans by diagonal voting.

Every rolling word k-gram of every text is looked up among the grams of the license
templates.  A gram at word p of a text and word t of a template votes for the diagonal
p - t.  A diagonal with a vote from each gram is the template word for word; neighbouring
diagonals are merged (a few words put in or left out), and the share of the template's
grams found over a merged run is its score.  Votes compare the words, not only hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postloom.llm.shared import key_filter, numbered, python_batches, small, staged
from postloom.llm.words import gram_hashes, in_filter, lists, owner, pieces, words_of

GRAM = 3
SLACK = 4  # words by which neighbouring diagonals may differ
LEAST = 0.8  # share of a template's grams from which a run counts
WHOLE = 12  # templates of fewer grams must be there whole: one word tells versions apart

# Phrases that are labels by contract.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Notices of public licenses, in the words of those licenses.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
_WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def template_words() -> list[tuple[int, str, bool, list[str]]]:
    """(number, label, base, words) of each template."""
    rows = [(label, True, text) for label, text in BASE] + [(label, False, text) for label, text in TEMPLATES]
    return [(i, label, base, _WORD.findall(text.lower())) for i, (label, base, text) in enumerate(rows)]


def default_templates(spark: SparkSession) -> DataFrame:
    """template, label, base, text."""
    rows = [(i, label, base, " ".join(words)) for i, label, base, words in template_words()]
    return spark.createDataFrame(rows, "template bigint, label string, base boolean, text string")


def rolling_grams(texts: DataFrame, gram: int, only=None) -> DataFrame:
    """uid, id, n_words and the grams of rows (uid, id, text): hash, place, words; with ``only``, those it may hold."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                w = words_of(some.column("text"))
                hashes = gram_hashes(w.hashes, gram)
                place = np.flatnonzero(in_filter(only.value, hashes)) if only else np.arange(len(hashes))
                text = owner(w.first, place)
                inside = place + gram <= w.first[text + 1]
                place, text = place[inside], text[inside]
                rows = pa.StructArray.from_arrays(
                    [pa.array(hashes[place].view(np.int64)), pa.array(place - w.first[text]), pa.array([w.joined(p, p + gram) for p in place.tolist()], pa.string())],
                    names=["hash", "place", "words"],
                )
                grams = lists(rows, np.bincount(text, minlength=len(w.first) - 1))
                yield pa.RecordBatch.from_arrays([some.column("uid"), some.column("id"), pa.array(np.diff(w.first).astype(np.int64)), grams], names=["uid", "id", "n_words", "grams"])

    python_batches(texts.sparkSession)
    return texts.mapInArrow(scan, "uid bigint, id bigint, n_words bigint, grams array<struct<hash: bigint, place: bigint, words: string>>")


def license_scan(docs: DataFrame, templates: DataFrame | None = None, gram: int = GRAM, slack: int = SLACK, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """(documents, runs).

    Documents: uid, doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.
    Runs, one per accepted place: uid, label, base, start and end (words), score.
    ``docs`` needs doc_id and text; other columns are ignored.  Null and empty texts have no
    words: zero counts, null places, empty labels, score 0.  Null or repeated doc_ids: each row
    is a document of its own.  Templates of fewer than ``gram`` words cannot vote.
    """
    spark = docs.sparkSession
    templates = default_templates(spark) if templates is None else templates
    known = rolling_grams(templates.select(F.col("template").alias("uid"), F.col("template").alias("id"), "text"), gram)
    known = known.filter(F.size("grams") > 0).select(F.col("id").alias("template"), F.size("grams").alias("n_grams"), F.explode("grams").alias("g"))
    known = known.join(templates.select("template", "label", "base"), "template")
    known = staged(known.select("template", "label", "base", "n_grams", "g.hash", F.col("g.place").alias("at"), F.col("g.words").alias("expected")), "templates")
    only = key_filter(known.select("hash"))
    rows = numbered(docs, F.col("doc_id").cast("bigint").alias("id"), "text")
    scanned = staged(rolling_grams(rows, gram, only), "grams")
    hits = scanned.select("uid", F.explode("grams").alias("g")).select("uid", "g.*")
    votes = hits.join(small(known), "hash").filter(F.col("words") == F.col("expected"))
    diagonal = (F.col("place") - F.col("at")).alias("diagonal")
    names = ["uid", "template", "label", "base", "n_grams"]
    lines = votes.groupBy(*names, diagonal).agg(F.collect_set("at").alias("seen"), F.min("place").alias("start"), F.max("place").alias("end"))
    exact = lines.filter(F.col("base") & (F.size("seen") == F.col("n_grams")))

    # Diagonals of one text and template, at most as many as the text has words.
    by = Window.partitionBy("uid", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(by) > slack).cast("int")
    merged = (
        lines.filter(~F.col("base")).withColumn("apart", F.coalesce(apart, F.lit(0)))
        .withColumn("run", F.sum("apart").over(by))
        .groupBy(*names, "run")
        .agg(F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"), F.min("start").alias("start"), F.max("end").alias("end"))
    )
    share = F.size("seen") / F.col("n_grams")
    method = merged.withColumn("score", share).filter(F.col("score") >= F.when(F.col("n_grams") < WHOLE, 1.0).otherwise(least))
    base = exact.withColumn("score", F.lit(1.0))
    columns = ["uid", "label", "base", "start", (F.col("end") + gram).alias("end"), "score"]
    runs = staged(base.select(*columns).union(method.select(*columns)), "license-runs")

    is_base = F.col("base")
    per_doc = runs.groupBy("uid").agg(
        F.count_if(is_base).alias("n_base"), F.min(F.when(is_base, F.col("start"))).alias("first_word"), F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    out = scanned.select("uid", F.col("id").alias("doc_id"), "n_words").join(per_doc, "uid", "left")
    return out.select(
        "uid", "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    ), runs
