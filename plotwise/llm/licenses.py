"""License scans by diagonal voting over rolling hashes of word runs; DataFrame functions only.

Each run of ``RUN`` words of a document is hashed and joined with the runs of the templates. A hit of a run at word p
of the document and word t of a template votes for the offset p - t, a diagonal of the two texts: a copy without
changes gives all its votes to one diagonal, inserted or missing words move the rest to a neighbouring one. Votes are
added up by diagonal; neighbouring diagonals are merged in bands of twice the template's ``drift`` that overlap by half,
so that any copy whose diagonals differ by no more than the drift lies wholly in one band. A band is verified by the
template's words that its runs cover: each run is compared word by word, and the covered share has to reach the
template's ``share``. A phrase is a template without drift whose words must all be there; names and versions that
tell two licenses apart are such phrases.

Documents are never shuffled: only hits and one row per document are, and a document with millions of hits spreads by
diagonal. The templates are broadcast up to ``BROADCAST_WORDS`` words; beyond that Spark chooses the join.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a run; shorter templates can't be found.
RUN = 3
#: Template words up to which the runs of all templates are broadcast (about 100 bytes each).
BROADCAST_WORDS = 50_000

#: All but small letters and digits of ASCII and characters beyond it.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEY = ["doc_id", "text_hash", "n_words"]


@dataclass(frozen=True)
class Template:
    """A text to be found: the share of its words that has to be there, and by how many words a copy may shift inside itself."""

    label: str
    text: str
    share: float = 0.8
    drift: int = 4
    base: bool = False


#: Phrases of the contract: fixed values.
PHRASES = [
    Template("mit", "under the mit license", 1.0, 0, True),
    Template("apache-2", "apache license version 2", 1.0, 0, True),
    Template("cc-by-nc", "cc by nc", 1.0, 0, True),
]

#: Notices of public licenses: fixed values.
NOTICES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", drift=12),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at", drift=8),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", drift=6),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", drift=8),
    Template("gpl-2", "licensed under the GNU General Public License, version 2", 1.0, 0),
    Template("gpl-3", "licensed under the GNU General Public License, version 3", 1.0, 0),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", drift=8),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    Template("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", drift=4),
    Template("unlicense", "This is free and unencumbered software released into the public domain", drift=3),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", 1.0, 0),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", 1.0, 0),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", 1.0, 0),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", drift=6),
]


def _words(text: Column) -> Column:
    """The words of a text, only A-Z in lower case; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(plain, _BETWEEN), "")


def _runs(df: DataFrame, at: str) -> DataFrame:
    """One row per word of ``words``: its place ``at``, the words of the run that begins there and their hash (null where fewer are left); one with a null place where there are no words."""
    shifted = [F.col("words"), *[F.slice("words", i + 1, F.size("words")) for i in range(1, RUN)]]
    others = [c for c in df.columns if c != "words"]
    runs = df.select(*others, F.posexplode_outer(F.arrays_zip(*[c.alias(f"w{i}") for i, c in enumerate(shifted)])).alias(at, "run"))
    words = [F.col("run").getField(f"w{i}") for i in range(RUN)]
    return runs.select(*others, at, F.when(words[-1].isNotNull(), F.xxhash64(*words)).alias("gram"), F.array(*words).alias("run_words"))


def _grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """The runs of all templates with their places, and what their template asks for."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t.label).alias("label"), F.lit(t.share).alias("share"), F.lit(t.drift).alias("drift"), F.lit(t.base).alias("base"), F.lit(t.text).alias("text")) for i, t in enumerate(templates)])
    table = spark.range(1).select(F.inline(rows)).withColumn("words", _words(F.col("text"))).drop("text").withColumn("size", F.size("words"))
    grams = _runs(table, "t").where("gram IS NOT NULL").withColumnRenamed("run_words", "template_words")
    return F.broadcast(grams) if sum(len(t.text.split()) for t in templates) <= BROADCAST_WORDS else grams


def votes(docs: DataFrame, templates: list[Template], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Hits by diagonal: the document's key, template (null: the row that stands for the document), diagonal, places (words of the template where a run was hit), copies (equal rows of documents, in the row of the document)."""
    words = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), _words(F.col(text_col).cast("string")).alias("words"),
    )
    runs = _runs(words.withColumn("n_words", F.size("words").cast("long")), "p")
    met = runs.join(_grams(docs.sparkSession, templates), "gram", "left")
    # the last word begins no run, so each document keeps exactly one row without a hit
    met = met.where((F.col("template").isNotNull() & (F.col("run_words") == F.col("template_words"))) | (F.col("template").isNull() & (F.coalesce("p", F.lit(0)) >= F.col("n_words") - 1)))
    return met.groupBy(*_KEY, "template", "label", "share", "drift", "base", "size", (F.col("p") - F.col("t")).alias("diagonal")).agg(
        F.collect_set("t").alias("places"), F.count_if(F.col("template").isNull()).alias("copies")
    )


def merged(voted: DataFrame) -> DataFrame:
    """Neighbouring diagonals in one (the row of a document stays as it is): adds first_word and end_word (of the document, end exclusive), and covered (share of the template's words) for each band."""
    wide = F.greatest("drift", F.lit(1)) * 2
    bands = F.when(F.col("drift") > 0, F.array(F.floor(F.col("diagonal") / wide) * 2, F.floor((F.col("diagonal") + F.col("drift")) / wide) * 2 + 1)).otherwise(F.array(F.col("diagonal").cast("long")))
    each = voted.withColumn("band", F.explode(bands))
    together = each.groupBy(*_KEY, "template", "label", "share", "drift", "base", "size", "band").agg(
        F.flatten(F.collect_list("places")).alias("places"), F.min(F.col("diagonal") + F.array_min("places")).alias("first_word"),
        F.max(F.col("diagonal") + F.array_max("places") + RUN).alias("end_word"), F.max("copies").alias("copies"),
    )
    # a band has two drifts of diagonals and each of them the template's places at most, so this array is bounded
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda t: F.sequence(t, t + RUN - 1)))))
    return together.withColumn("covered", covered / F.col("size")).drop("places", "band")


def spans(docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified spans: doc_id, label, first_word, end_word (exclusive, words from 0), covered. A copy may be reported by two bands with different ends."""
    found = merged(votes(docs, PHRASES + NOTICES if templates is None else templates, id_col, text_col).where("template IS NOT NULL"))
    return found.where("covered >= share").select("doc_id", "label", F.col("first_word").cast("long"), F.col("end_word").cast("long"), "covered").distinct()


def scan(docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: a row per row of ``docs``.

    ``base`` columns are those of the templates marked so, which must have no drift: all places, the smallest and the largest first word
    (null where there is none), and labels. ``labels`` are those of all templates found, distinct, sorted and
    comma-joined; ``score`` is the largest covered share of any template, found or not (0: no run in common).
    Null and empty texts have no words, no labels and score 0. Repeated rows each give a row; rows with a null doc_id
    are scanned too. An empty table gives no rows. Only the two named columns are read, so others may have any name.
    """
    templates = PHRASES + NOTICES if templates is None else templates
    found = merged(votes(docs, templates, id_col, text_col)).withColumn("found", F.col("covered") >= F.col("share"))
    place = F.col("found") & F.col("base")
    rows = found.groupBy(*_KEY).agg(
        F.max("copies").alias("copies"), F.count_if(place).alias("n_base"), F.min(F.when(place, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("first_word"))).cast("long").alias("last_word"), F.collect_set(F.when(place, F.col("label"))).alias("base_found"),
        F.collect_set(F.when(F.col("found"), F.col("label"))).alias("all_found"), F.coalesce(F.max("covered"), F.lit(0.0)).alias("score"),
    )
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select("doc_id", "n_words", "n_base", "first_word", "last_word", joined("base_found").alias("base_labels"), joined("all_found").alias("labels"), "score")
