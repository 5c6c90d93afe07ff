"""License scan by diagonal voting, all in built-in functions.

All rolling k-word hashes of a text are joined to the positions where the templates have them. A hit at
word ``pos`` of the text and ``at`` of the template votes for the diagonal ``pos - at``; votes are
counted per diagonal, diagonals at most ``band`` apart are merged (a word more or less in the text
shifts the rest to a neighbour), and a merged span is verified: its words are compared with the
template's, it has to hold ``cover`` of the template's runs, and it may be at most ``stretch`` times as
long as the template.

Words are lower-cased in A-Z only. NULL and empty texts have no words and no span. Repeated rows each get the
same result (runs are counted once per text position). A text with many places of one license keeps all. An empty table
gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import let, lower_az, parameter_table, small, split_words
from pagewright.sources.storage import stored

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 3

# Phrases that are looked for word by word.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Public license notices.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions"),
    ("mit", "Released under the MIT License."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                 "in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation, either version 3 of the License, "
              "or (at your option) any later version."),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
)


def template_words(text: str) -> list[str]:
    return [w for w in re.split(GAPS, re.sub("[A-Z]+", lambda m: m.group().lower(), text)) if w]


def template_runs(templates, k: int = K) -> list[tuple[int, str, int, int, int, str]]:
    """(template, label, words, runs, at, run) for each k-word run; templates under k words are an error."""
    rows = []
    for number, (label, text) in enumerate(templates):
        words = template_words(text)
        if len(words) < k:
            raise ValueError(f"a template needs at least {k} words: {text!r}")
        runs = len(words) - k + 1
        rows += [(number, label, len(words), runs, at, " ".join(words[at : at + k])) for at in range(runs)]
    return rows


def words_of(text: Column) -> Column:
    return split_words(lower_az(text), GAPS)


def diagonals(docs: DataFrame, templates, keys: list[str], text: str = "text", k: int = K) -> DataFrame:
    """keys, template, label, words, runs, diagonal, the voting positions of the text and the template, and
    the number of votes. Every text also votes once per row for the template -1, on the diagonal of its
    number of words, so that one pass over the texts tells both."""
    rows = [(-1, "", 0, 1, 0, ""), *template_runs(templates, k)]
    runs = parameter_table(docs.sparkSession, rows, "template int, label string, words int, runs int, at int, run string")
    runs = small(runs.withColumn("hash", F.xxhash64("run")), len(rows))

    def rolling(words: Column) -> Column:
        run = lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + j) for j in range(1, k)])
        return F.concat(F.transform(words, run), F.array(F.lit("")))

    found = docs.select(*keys, F.posexplode(let(words_of(F.col(text)), rolling)).alias("pos", "found"))
    hits = found.withColumn("hash", F.xxhash64("found")).join(runs, "hash").filter("found = run")
    diagonal = hits.withColumn("diagonal", F.col("pos") - F.col("at"))
    return diagonal.groupBy(*keys, "template", "label", "words", "runs", "diagonal").agg(
        F.collect_set("pos").alias("positions"), F.collect_set("at").alias("held"),  # at most one per run
        F.count("*").alias("votes"),
    )


def merge(found: DataFrame, keys: list[str], band: int, cover: float, stretch: float, k: int = K) -> DataFrame:
    """keys, template, label, start, end, score of the verified spans."""
    line = Window.partitionBy(*keys, "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > band, F.lit(True))
    marked = found.withColumn("fresh", fresh.cast("int"))
    marked = marked.withColumn("span", F.sum("fresh").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    # a run of diagonals at most `band` apart holds at most one position per run of the template each
    spans = marked.groupBy(*keys, "template", "label", "words", "runs", "span").agg(
        F.min(F.array_min("positions")).alias("start"),
        (F.max(F.array_max("positions")) + k).alias("end"),
        F.array_distinct(F.flatten(F.collect_set("held"))).alias("held"),
    )
    spans = spans.withColumn("score", F.size("held") / F.col("runs"))
    fits = (F.col("score") >= cover) & (F.col("end") - F.col("start") <= stretch * F.col("words"))
    return spans.filter(fits).select(*keys, "template", "label", "start", "end", "score")


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=PHRASES, notices=NOTICES,
    band: int = 3, cover: float = 0.7, stretch: float = 1.5,
) -> DataFrame:
    """Per row: n_words, places of the phrases (n_base, first_word, last_word, base_labels), labels of
    phrases and notices, and the best score."""
    templates = [*phrases, *notices]
    keyed = docs.select(key, F.xxhash64(text).alias("_text"), F.col(text).alias("_whole"))
    keys = [key, "_text"]
    found = stored(diagonals(keyed, templates, keys, "_whole"), "diagonals")
    none = [F.lit(None).cast("int").alias("start"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("score")]
    texts = found.filter("template = -1").select(*keys, *none, F.lit(False).alias("base"), F.col("diagonal").alias("n_words"), F.col("votes").alias("copies"))
    plain = [F.lit(None).cast("int").alias("n_words"), F.lit(None).cast("long").alias("copies")]
    exact = found.filter((F.col("template") >= 0) & (F.col("template") < len(phrases)) & (F.size("held") == F.col("runs")))
    exact = exact.select(*keys, F.col("diagonal").alias("start"), "label", F.lit(1.0).alias("score"), F.lit(True).alias("base"), *plain)
    spans = merge(found.filter(F.col("template") >= len(phrases)), keys, band, cover, stretch)
    spans = spans.select(*keys, "start", "label", "score", F.lit(False).alias("base"), *plain)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = F.col("base")
    out = texts.unionByName(exact).unionByName(spans).groupBy(*keys).agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined("label").alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
        F.max("copies").alias("_copies"),
    )
    # a row that was there several times comes back as often
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).drop("_copy", "_copies", "_text")
