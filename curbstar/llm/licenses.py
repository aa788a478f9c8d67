"""License scan by diagonal voting.

All rolling word k-gram hashes of every document are met with the k-gram positions of license
templates. A hit at word ``p`` of the document and ``q`` of the template votes for the diagonal
``p - q``; diagonals that lie close together are merged, so that a few inserted or lost words do
not break a span; and a span is verified by how much of the template it covers and how much of
itself is covered. Phrases that settle a label on their own are found as exact runs of words.

The templates are a fixed, small list: their hashes go to every task, which drops all other
k-grams at once. Only hits are joined and aggregated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbstar.llm.common import WordRuns, pieces, plain_words
from curbstar.sources.scratch import stored

GRAM = 4
#: Diagonals closer than this are one span.
SLACK = 4
LEAST_COVERAGE = 0.6

# Phrases of the base labels and the texts that the licenses prescribe.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("lgpl-3", "licensed under the GNU Lesser General Public License, version 3"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)

SCANNED = (
    "row long, doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "hits array<struct<p:long,h:long>>"
)


def _hashes(texts: list[str], k: int) -> list[np.ndarray]:
    """K-gram hashes of each text, as signed 64-bit numbers."""
    runs = WordRuns([plain_words(t) for t in texts])
    at, h = runs.runs(k)
    bounds = np.searchsorted(at, runs.first)
    return [h[a:b].view(np.int64) for a, b in zip(bounds, bounds[1:], strict=False)]


def _scan(phrases: tuple, templates: tuple, gram: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unique(np.concatenate(_hashes([t for _, t in templates], gram) or [np.empty(0, np.int64)]))
        by_length: dict[int, list[tuple[int, str]]] = {}
        for text, label in phrases:
            k = len(plain_words(text))
            by_length.setdefault(k, []).append((int(_hashes([text], k)[0][0]), label))
        for batch in batches:
            for piece in pieces(batch):
                yield results(piece, wanted, by_length)

    def results(batch: pa.RecordBatch, wanted: np.ndarray, by_length: dict) -> pa.RecordBatch:
        n = batch.num_rows
        runs = WordRuns([plain_words(t) for t in batch.column("text").to_pylist()])
        starts, labels = [np.empty(0, dtype=np.int64)], [[] for _ in range(n)]
        for k, own in by_length.items():
            at, h = runs.runs(k)
            for value, label in own:
                found = at[h.view(np.int64) == value]
                starts.append(found)
                for d in np.unique(np.searchsorted(runs.first, found, side="right") - 1):
                    labels[d].append(label)
        start = np.sort(np.concatenate(starts))
        doc = np.searchsorted(runs.first, start, side="right") - 1
        lo, hi = np.searchsorted(doc, np.arange(n)), np.searchsorted(doc, np.arange(n), side="right")
        none = lo == hi
        place = start - runs.first[doc]
        padded = np.append(place, 0)
        at, h = runs.runs(gram)
        hit = np.isin(h.view(np.int64), wanted)
        at, h = at[hit], h.view(np.int64)[hit]
        bounds = np.searchsorted(at, runs.first)
        owner = np.searchsorted(runs.first, at, side="right") - 1
        hits = pa.StructArray.from_arrays([pa.array(at - runs.first[owner]), pa.array(h)], names=["p", "h"])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("row"), batch.column("doc_id"), pa.array(runs.n_words), pa.array(hi - lo),
                pa.array(padded[lo], mask=none), pa.array(padded[hi - 1], mask=none),
                pa.array([sorted(set(x)) for x in labels], pa.list_(pa.string())),
                pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), hits),
            ],
            names=["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "hits"],
        )

    return scan


def scanned_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: tuple = PHRASES, templates: tuple = TEMPLATES, gram: int = GRAM) -> DataFrame:
    """A stored row per input row: places of phrases, and the k-grams that some template has."""
    docs = documents.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stored(docs.mapInArrow(_scan(phrases, templates, gram), SCANNED), "licenses")


def template_spans(scanned: DataFrame, templates: tuple = TEMPLATES, gram: int = GRAM, slack: int = SLACK, least: float = LEAST_COVERAGE) -> DataFrame:
    """Verified spans: row, label, first_word, last_word, coverage (of the template), votes."""
    spark = scanned.sparkSession
    places = [(i, label, int(q), int(h), len(plain_words(t))) for i, (label, t) in enumerate(templates) for q, h in enumerate(_hashes([t], gram)[0])]
    table = F.broadcast(spark.createDataFrame(places, "template int, label string, q long, h long, length int"))
    hits = scanned.select("row", F.explode("hits").alias("x")).select("row", "x.p", "x.h").join(table, "h")
    diagonals = hits.groupBy("row", "template", "label", "length", (F.col("p") - F.col("q")).alias("diagonal")).agg(F.sort_array(F.collect_set("q")).alias("qs"))
    # A diagonal holds at most one hit per template place. Neighbours start a new span after a gap.
    in_order = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(in_order) >= slack
    merged = diagonals.withColumn("new", F.coalesce(gap, F.lit(True)).cast("int")).withColumn("span", F.sum("new").over(in_order))
    place = F.struct(F.min(F.col("diagonal") + F.get("qs", F.lit(0))).alias("first"), F.max(F.col("diagonal") + F.element_at("qs", -1) + gram - 1).alias("last"))
    covered = lambda starts: F.array_distinct(F.flatten(F.transform(starts, lambda q: F.sequence(q, q + gram - 1))))
    spans = merged.groupBy("row", "template", "label", "length", "span").agg(
        place.alias("at"), F.sum(F.size("qs")).alias("votes"),
        F.size(F.array_distinct(F.flatten(F.collect_list(covered(F.col("qs")))))).alias("of_template"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.transform(covered(F.col("qs")), lambda q: q + F.col("diagonal")))))).alias("of_text"),
    )
    spans = spans.select("row", "label", F.col("at.first").alias("first_word"), F.col("at.last").alias("last_word"), (F.col("of_template") / F.col("length")).alias("coverage"), "votes", "of_text")
    spans = spans.filter((F.col("coverage") >= least) & (F.col("of_text") >= least * (F.col("last_word") - F.col("first_word") + 1)))
    # Licenses quote each other: of spans that overlap in the text, those of the best cover stay.
    by_place = Window.partitionBy("row").orderBy("first_word", "last_word")
    reached = F.max("last_word").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.coalesce(F.col("first_word") > reached, F.lit(True)).cast("int"))
    spans = spans.withColumn("group", F.sum("new").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.max(F.struct("coverage", "votes")).over(Window.partitionBy("row", "group"))
    spans = spans.withColumn("best", best).filter((F.col("coverage") == F.col("best.coverage")) & (F.col("votes") == F.col("best.votes")))
    return spans.select("row", "label", "first_word", "last_word", "coverage", "votes")


def license_report(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the best coverage of a verified span, and 1 with a base phrase. Null and empty
    texts have no words and no labels. Repeated rows give repeated results; other columns are
    ignored; an empty table gives an empty result.
    """
    scanned = scanned_documents(documents, doc_id, text)
    found = template_spans(scanned).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("coverage").alias("coverage"))
    out = scanned.drop("hits").join(found, "row", "left")
    both = F.array_sort(F.array_union("base_labels", F.coalesce("more", F.expr("cast(array() as array<string>)"))))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("coverage", F.lit(0.0))).alias("score"),
    )
