"""Language identification by Bayesian evidence fusion.

Four kinds of evidence on the language of a page: its visible text (a naive Bayes model over letter triples), the
language its markup declares, the suffix of its address, and what is known of its host. The text model is fitted
on a bounded sample of documents with known language. Everything else comes from grouped aggregation over all
pages of the text model's posteriors: how often a language is declared as which, and how languages spread over
suffixes and hosts. Host priors are smoothed hierarchically: a host leans on its site, a site on its suffix, a
suffix on all pages, each the more the less of its own it has seen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsquake.llm.common import Shelf
from newsquake.llm.urls import host_and_path

SAMPLE = 300  # documents of each language at most
TRIPLES = 10_000  # most frequent ones of each language's sample; bounds the model to so many rows per language
TEMPER = 0.1  # overlapping triples repeat each other's evidence
STRENGTH = 20.0  # pages' worth that the level above counts in a prior
FAITH = 2.0  # pages' worth of belief that the declared language is the true one


def triples(text: str) -> Counter:
    """Letter triples of the words, each word set between spaces."""
    words = Counter(w for w in "".join(c if c.isalpha() else " " for c in text.lower()).split())
    out: Counter = Counter()
    for word, n in words.items():
        padded = f" {word} "
        for i in range(len(padded) - 2):
            out[padded[i : i + 3]] += n
    return out


def fit_text(docs: DataFrame, shelf: Shelf, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample: int = SAMPLE) -> tuple[list[str], dict[str, np.ndarray]]:
    """(languages, log probability of each triple by language), from the first `sample` documents of each language by a
    hash of the id. Of documents with one id and language the greatest text counts; rows that repeat an id share its place.

    A triple among the `TRIPLES` most frequent of any language has a probability in all of them, so a language with
    little text keeps its model. Without labelled documents there is one language, "und", and no triple.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Ids are ranked without their texts, and Spark keeps the first of each language on the map side already.
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = known.select("lang", "id").withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample).select("lang", "id").distinct()
    ids = shelf.put(ids)
    languages = sorted(r[0] for r in ids.select("lang").distinct().collect())  # a handful of language codes
    if not languages:
        return ["und"], {}
    rows = F.broadcast(ids.select(F.col("lang").alias("l"), F.col("id").alias("i")))  # `sample` ids of each language at most
    found = known.join(rows, (F.col("lang") == F.col("l")) & F.col("id").eqNullSafe(F.col("i"))).drop("l", "i")
    chosen = shelf.put(found.groupBy("lang", "id").agg(F.max("text").alias("text")))

    @F.pandas_udf("array<struct<triple:string,n:bigint>>")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([[(t, n) for t, n in triples(x).items()] for x in texts])

    counts = chosen.select("lang", F.explode(counted("text")).alias("t")).groupBy("lang", "t.triple").agg(F.sum("t.n").alias("n"))
    counts = shelf.put(counts)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "triple"))
    most = counts.withColumn("rank", rank).where(F.col("rank") <= TRIPLES).select("triple").distinct()
    table = {}
    for r in counts.join(most, "triple").select("triple", "lang", "n").collect():
        table.setdefault(r.triple, np.full(len(languages), 0.5))[languages.index(r.lang)] += r.n
    totals = sum(table.values(), np.zeros(len(languages))) + 0.5
    return languages, {t: np.log(n / totals) for t, n in table.items()}


def visible_text(html: Column) -> Column:
    """The page without comments, scripts, styles and tags; entities are left, having no letters worth counting."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&#?\w+;", " ")


def declared_language(html: Column) -> Column:
    """The primary code of the html element's lang attribute, lower-cased; empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", 1))


def identify(pages: DataFrame, docs: DataFrame, shelf: Shelf, url_col: str = "url", html_col: str = "html", into: str = "language", keep: list[str] | None = None, **settings) -> DataFrame:
    """`pages` (or its columns `keep`) with a struct `into`: host, declared, suffix, lang, probability, text_lang.

    lang is the most probable language (ties: the first code), probability its share of the fused evidence,
    text_lang the text's own choice. A null or empty page has no text evidence, and a null url an empty host and
    suffix, which are groups of their own. Pages that repeat count each. With no labelled documents the only
    language is "und". Other columns pass through.
    """
    languages, table = fit_text(docs, shelf, **settings)

    @F.pandas_udf("array<double>")
    def likelihood(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for text in texts:
                total = np.zeros(len(languages))
                for t, n in triples(text).items():
                    row = table.get(t)
                    if row is not None:
                        total += n * row
                total *= TEMPER
                total -= total.max()
                out.append(total - math.log(np.exp(total).sum()))
            yield pd.Series(out)

    host, _ = host_and_path(F.col(url_col))
    named = pages.select(F.struct(*(keep or pages.columns)).alias("page"), host.alias("host"), declared_language(F.col(html_col)).alias("declared"), likelihood(visible_text(F.col(html_col))).alias("text"))
    named = named.withColumn("site", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)).withColumn("suffix", F.regexp_extract("host", r"([^.]+)$", 1))
    named = shelf.put(named)
    n = len(languages)
    shares = [F.sum(F.exp(F.get("text", F.lit(i)))).alias(f"s{i}") for i in range(n)]
    sums = [f"s{i}" for i in range(n)]
    # Posteriors of the text summed per host; sites, suffixes and the whole follow from these few rows.
    hosts = shelf.put(named.groupBy("suffix", "site", "host").agg(*shares))
    world = hosts.agg(*[F.sum(s).alias(s) for s in sums]).first()
    total = sum(world[s] or 0.0 for s in sums) or 1.0
    above = [F.lit(((world[s] or 0.0) + 1.0) / (total + n)) for s in sums]

    def prior(frame: DataFrame, parents: list[Column], name: str) -> DataFrame:
        seen = sum((F.col(s) for s in sums), F.lit(0.0))
        return frame.withColumn(name, F.array(*[(F.col(s) + F.lit(STRENGTH) * p) / (seen + STRENGTH) for s, p in zip(sums, parents)])).drop(*sums)

    level = lambda *keys: hosts.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
    taken = lambda name: [F.get(name, F.lit(i)) for i in range(n)]
    suffixes = prior(level("suffix"), above, "suffix_prior")
    sites = prior(level("suffix", "site").join(suffixes, "suffix"), taken("suffix_prior"), "site_prior")
    priors = prior(hosts.join(sites, ["suffix", "site"]), taken("site_prior"), "prior").select("host", "prior")
    # How a language is declared: of all pages by text, smoothed towards being declared as itself.
    said = named.groupBy("declared").agg(*shares)
    kinds = len(languages) + 1
    habit = F.array(*[
        F.ln((F.col(s) + F.when(F.col("declared") == code, FAITH).otherwise(F.lit(FAITH / kinds))) / F.lit((world[s] or 0.0) + 2 * FAITH))
        for s, code in zip(sums, languages)
    ])
    habits = shelf.put(said.select(F.col("declared").alias("d"), habit.alias("habit")))
    joined = named.join(shelf.put(priors), "host").join(habits, F.col("declared") == F.col("d"))
    # Undeclared pages say nothing by that.
    spoken = lambda i: F.when(F.col("declared") == "", F.lit(0.0)).otherwise(F.get("habit", F.lit(i)))
    fused = F.array(*[F.get("text", F.lit(i)) + F.ln(F.get("prior", F.lit(i))) + spoken(i) for i in range(n)])
    codes = F.array(*[F.lit(c) for c in languages])
    best = lambda c: F.get(codes, (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    certain = 1 / F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("fused")))
    told = joined.withColumn("fused", fused)
    out = F.struct("host", "declared", "suffix", best(F.col("fused")).alias("lang"), certain.alias("probability"), best(F.col("text")).alias("text_lang"))
    return told.select("page", out.alias(into)).select("page.*", into)
