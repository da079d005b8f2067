"""License scans by diagonal voting.

Every word of a text is a number: its place in the templates' vocabulary, 0 if it is not there. A rolling hash over
k words, a polynomial in the size of the vocabulary, is exact for template words, so a hash met is the words met.
All rolling hashes of all texts are joined to the positions of the templates' hashes. A text that contains a
template hits it along one diagonal (text position minus template position); hits are counted per diagonal,
diagonals at most REACH apart are merged, as an inserted or lost word moves the rest to the next one, and the spans
are verified: the longest chain of their hits that goes forward in the text and in the template, as a share of the
template's hashes, decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsquake.llm.automaton import words_of
from newsquake.llm.common import Shelf

K = 2  # words of a hash: as long as the shortest phrase
REACH = 3  # diagonals that still merge
SHARE = 0.85  # of a template's hashes that a span must hit

# Phrases whose words must stand consecutively, with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Wordings of well-known license notices, with the labels this method adds.
NOTICES = (
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("licensed under cc by nd", "cc-by-nd"),
    ("creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2.0"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this work is dedicated to the public domain", "public-domain"),
)


def template_rows(phrases, notices) -> list[tuple[int, str, bool, list[bytes]]]:
    """(template, label, base, words) of each template of at least K words."""
    every = [(p, label, True) for p, label in phrases] + [(n, label, False) for n, label in notices]
    rows = [(i, label, base, words_of(text.encode())) for i, (text, label, base) in enumerate(every)]
    if any(len(r[3]) < K for r in rows):
        raise ValueError(f"a template needs {K} words")
    return rows


def longest_chain(hits: Column, grams: Column) -> Column:
    """Length of the longest chain of hits in which text and template positions both grow.

    hits are (pos, back) sorted, back the negative template position: of hits at one text position the latest in the
    template comes first, so that none of them continues another. The state holds, for each template position, the
    longest chain that ends there.
    """
    none = F.transform(F.sequence(F.lit(1), grams), lambda i: F.lit(0))

    def longer(state: Column, hit: Column) -> Column:
        reached = F.coalesce(F.array_max(F.slice(state, 1, -hit["back"])), F.lit(0)) + 1
        return F.transform(state, lambda v, i: F.when(i == -hit["back"], F.greatest(v, reached)).otherwise(v))

    return F.aggregate(hits, none, longer, F.array_max)


def scan_licenses(docs: DataFrame, shelf: Shelf, phrases=PHRASES, notices=NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    n_base counts all places where a phrase stands whole and consecutive, first_word and last_word are the least
    and largest start of one. labels adds the notices found with SHARE of their hashes in order on merged diagonals;
    score is the largest share of a template found, 0 without any. spans lists (label, start, end, share), in words.
    Null and empty texts have no words and no labels. Rows that repeat are scanned each for itself; null ids stay.
    """
    templates = template_rows(phrases, notices)
    number = {w: i for i, w in enumerate(sorted({w for _, _, _, words in templates for w in words}), 1)}
    base_of = len(number) + 1

    @F.pandas_udf("n_words bigint, grams array<int>")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        get = number.get
        for texts in batches:
            rows = []
            for data in texts:
                words = words_of(data or b"")
                ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
                grams = ids[: max(0, len(ids) - K + 1)].copy()
                for k in range(1, K):
                    grams = grams * base_of + ids[k : len(ids) - K + 1 + k]
                rows.append((len(words), grams))
            yield pd.DataFrame(rows, columns=["n_words", "grams"])

    if base_of**K >= 2**31:
        raise ValueError(f"{len(number)} different words in templates are too many for hashes of 32 bits")
    one = docs.select(F.col(id_col).alias("id"), hashed(F.col(text_col).cast("binary")).alias("h")).select("id", "h.*")
    rolled = shelf.put(one.withColumn("row", F.monotonically_increasing_id()))
    places = []
    for template, label, base, words in templates:
        ids = [number[w] for w in words]
        for at in range(len(ids) - K + 1):
            gram = 0
            for k in range(K):
                gram = gram * base_of + ids[at + k]
            places.append((gram, template, at, len(ids) - K + 1, label, base))
    # As many rows as the fixed templates have words, so the broadcast does not grow.
    spots = F.broadcast(docs.sparkSession.createDataFrame(places, "gram int, template int, at int, grams int, label string, base boolean"))
    hits = rolled.select("row", F.posexplode("grams").alias("pos", "gram")).join(spots, "gram")
    diagonals = hits.groupBy("row", "template", "grams", "label", "base", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.collect_list("at").alias("ats")
    )
    diagonals = shelf.put(diagonals)  # at most one hit per place of the template each
    exact = diagonals.where("base and votes = grams").select("row", "label", "base", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("grams") + K - 1).alias("end"), F.lit(1.0).alias("share"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    near = F.col("diagonal") - F.lag("diagonal").over(along) <= REACH
    runs = diagonals.where("not base").withColumn("fresh", F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    # A run's hits are hits of one text; runs with too few places of the template hit need no verification.
    merged = runs.groupBy("row", "template", "label", "base", "run", "grams").agg(F.collect_list(F.struct("diagonal", "ats")).alias("parts"))
    merged = merged.where(F.size(F.array_distinct(F.flatten(F.col("parts.ats")))) >= SHARE * F.col("grams"))
    hit = lambda part: F.transform(part["ats"], lambda at: F.struct((at + part["diagonal"]).alias("pos"), (-at).alias("back")))
    spans = merged.withColumn("hits", F.array_sort(F.flatten(F.transform("parts", hit))))
    share = longest_chain(F.col("hits"), F.col("grams")) / F.col("grams")
    start, end = F.col("hits")[0]["pos"], F.element_at("hits", -1)["pos"] + K
    found = spans.select("row", "label", "base", start.alias("start"), end.alias("end"), share.alias("share")).where(F.col("share") >= SHARE)
    found = exact.union(found)
    only_base = lambda c: F.when(F.col("base"), F.col(c))
    told = found.groupBy("row").agg(
        F.count_if("base").alias("n_base"),
        F.min(only_base("start")).cast("bigint").alias("first_word"),
        F.max(only_base("start")).cast("bigint").alias("last_word"),
        F.array_sort(F.collect_set(only_base("label"))).alias("base_set"),
        F.array_sort(F.collect_set("label")).alias("set"),
        F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.struct("start", "end", "label", "share"))).alias("spans"),
    )
    out = rolled.select("row", "id", "n_words").join(told, "row", "left")
    return out.select(
        "id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce(F.array_join("base_set", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("set", ","), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "spans",
    )
