"""Toxicity by classifier chains: categories are predicted one after the other, each linear model reading the
words of the text, their beginnings, and the probabilities of the categories before it.

Training uses a bounded sample of the labelled rows. The probabilities that later models of the chain are trained
on are out of fold: each comes from a model that did not see the row, as a fitted model is too sure of its own
training rows. The final models are then fitted on the whole sample.

The labels know one category only. The two finer ones come from the sample: its telling toxic words are split into
two groups that occur apart from each other, and a toxic row belongs to each group it has a word of.

Spark picks the sample, counts its words per class and keeps the most telling ones; the fits, a few megabytes,
run on the driver. Scoring is one scan of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsquake.llm.automaton import words_of
from newsquake.llm.common import LETTER_WORD, Shelf, free, lower_ascii

CATEGORIES = ("kind_a", "kind_b", "toxic")  # two kinds of toxic words that occur apart, then the label itself

SAMPLE = 2000  # labelled rows of each class at most; the classifier sees no more
FEATURES = 1024  # words and beginnings at most
PREFIXES = (4, 5)  # characters of a word's beginnings; a word then counts in forms the sample lacks
LEAST_SCORE = 10.8  # of the chi-square test with one degree of freedom: one word in a thousand passes by chance
LEAST_LIFT = 3.0  # times as frequent in one class as in the other; common words differ too little
FOLDS = 3
STEPS = 80
PENALTY = 0.002
LIMIT = 0.5


@dataclass
class Chain:
    """Weights over words and earlier probabilities, one model per category; picklable plain data."""

    words: list[str] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)

    def probabilities(self, words: set[str], place: dict[str, int]) -> list[float]:
        found = [place[w] for w in words if w in place]
        out: list[float] = []
        for weight in self.weights:
            n = len(self.words)
            z = weight[-1] + weight[found].sum() + sum(p * weight[n + i] for i, p in enumerate(out))
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return out


def fit(x: np.ndarray, y: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> np.ndarray:
    """Logistic regression with an L1 penalty by accelerated proximal gradient; the last weight is the intercept.

    A class without rows of both kinds gets the constant share, pulled from 0 and 1 by one row.
    """
    n, d = x.shape
    if n == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (n + 1)
        return np.concatenate((np.zeros(d), [np.log(share / (1 - share))]))
    full = np.concatenate((x, np.ones((n, 1))), axis=1).astype(np.float64)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))  # both classes count alike
    rate = 4 / max(1e-9, (full * full).sum(axis=1) @ weight)
    w = ahead = np.zeros(d + 1)
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ ahead, -30, 30)))
        new = ahead - rate * (full.T @ (weight * (p - y)))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_next * (new - w)
        w, t = new, t_next
    return w


def fit_chain(words: list[str], x: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> Chain:
    """x: rows by words; labels: rows by categories; fold: the fold of each row."""
    chain = Chain(words)
    for c in range(labels.shape[1]):
        y = labels[:, c]
        chain.weights.append(fit(x, y))
        outside = np.zeros(len(x))
        for k in range(FOLDS):
            inside = fold == k
            w = fit(x[~inside], y[~inside])
            outside[inside] = 1 / (1 + np.exp(-np.clip(x[inside] @ w[:-1] + w[-1], -30, 30)))
        x = np.concatenate((x, outside[:, None].astype(x.dtype)), axis=1)
    return chain


def split_words(words: list[str], x: np.ndarray, toxic: np.ndarray) -> tuple[list[int], list[int]]:
    """Places of the telling toxic words in two groups; x is rows by words, words marked by a star are beginnings.

    A word is toxic if it stands in more of the toxic rows than of the others. The one in most toxic rows leads the
    first group, and the one that meets it least in toxic rows, against what chance gives, leads the second. Every
    other word joins the leader it meets more, against chance; if equal, the smaller group, then the first. Ties
    between words go to the first in order. With fewer than two toxic words the second group is empty.
    """
    bad, good = x[toxic == 1].astype(np.float64), x[toxic != 1]
    if not len(bad) or not len(good):
        return [], []
    share = bad.mean(axis=0)
    own = [i for i, w in enumerate(words) if not w.endswith("*") and share[i] > good[:, i].mean()]
    own.sort(key=lambda i: -share[i])
    if len(own) < 2:
        return own, []

    def meets(i: int, j: int) -> float:
        return float((bad[:, i] * bad[:, j]).mean() / (share[i] * share[j]))

    first = own[0]
    second = min(own[1:], key=lambda i: meets(first, i))
    groups: tuple[list[int], list[int]] = ([first], [second])
    for i in own:
        if i not in (first, second):
            a, b = meets(first, i), meets(second, i)
            groups[int(b > a or (a == b and len(groups[1]) < len(groups[0])))].append(i)
    return groups


def _beginning(n: int):
    return lambda word: F.concat(F.substring(word, 1, n), F.lit("*"))


def features(data: bytes) -> set[str]:
    """Words of a UTF-8 text and their beginnings, marked by a star."""
    words = {w.decode("utf-8", "replace") for w in set(words_of(data))}
    return words.union(*({w[:n] + "*" for w in words} for n in PREFIXES))


def train(docs: DataFrame, labels: DataFrame, shelf: Shelf, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Chain:
    """A chain fitted on at most `sample` labelled rows of each class, the first by a hash of their ids.

    Labels without id or value are ignored; an id with several labels counts as toxic if one says so. Without any
    usable label the chain scores every text alike, below the limit.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    order = [F.xxhash64("id"), F.col("id")]
    picked = known.where("label = 1").orderBy(*order).limit(sample).union(known.where("label = 0").orderBy(*order).limit(sample))
    one = docs.select(F.col(id_col).alias("id"), lower_ascii(F.col(text_col)).alias("text"))
    rows = F.broadcast(shelf.put(picked))  # two times `sample` rows at most
    texts = shelf.put(one.join(rows, "id").groupBy("id").agg(F.max("label").alias("label"), F.max("text").alias("text")))
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(LETTER_WORD), F.lit(0)))
    bags = texts.select("id", "label", words.alias("full"))
    begun = [F.transform("full", _beginning(n)) for n in PREFIXES]
    bags = shelf.put(bags.select("id", "label", F.array_distinct(F.concat("full", *begun)).alias("words")))
    total, bad = bags.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not bad or bad == total:
        return Chain([], [np.array([0.0] * i + [-3.0]) for i in range(len(CATEGORIES))])  # earlier probabilities count nothing
    counted = bags.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.sum("label").cast("double").alias("a"), F.count(F.lit(1)).cast("double").alias("n"))
    # Chi-square of word against class.
    gap = F.col("a") * total - F.col("n") * F.lit(float(bad))
    score = gap * gap * total / (F.col("n") * (F.lit(float(total)) - F.col("n") + 0.5) * F.lit(float(bad) * (total - bad)))
    lift = ((F.col("a") + 0.5) / (bad + 1)) / ((F.col("n") - F.col("a") + 0.5) / (total - bad + 1))
    telling = F.abs(F.ln(lift)) >= F.ln(F.lit(LEAST_LIFT))
    told = counted.where(telling).select("word", score.alias("score")).where(F.col("score") >= LEAST_SCORE).orderBy(F.desc("score"), "word").limit(FEATURES)
    words = sorted(r.word for r in told.collect())
    place = {w: i for i, w in enumerate(words)}
    wanted = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    kept = bags.select("id", "label", F.array_intersect("words", wanted).alias("words")).orderBy("id").collect()
    x = np.zeros((len(kept), len(words)), np.float32)
    for i, r in enumerate(kept):
        x[i, [place[w] for w in r.words]] = 1
    toxic = np.array([r.label for r in kept], np.float64)
    y = np.stack([*[toxic * x[:, group].any(axis=1) for group in split_words(words, x, toxic)], toxic], axis=1)
    return fit_chain(words, x, y, np.arange(len(kept)) % FOLDS)


def score(docs: DataFrame, chain: Chain, text_col: str = "text", into: str = "scores") -> DataFrame:
    """`docs` with a struct of probabilities p_kind_a, p_kind_b, p_toxic and toxic (the last reaches the limit).

    Whole texts count; null and empty texts have no words and get the intercepts' probabilities, not toxic.
    Other columns pass through.
    """

    @F.pandas_udf(", ".join(f"p_{c} double" for c in CATEGORIES) + ", toxic boolean")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        place = {w: i for i, w in enumerate(chain.words)}
        for texts in batches:
            rows = []
            for data in texts:
                words = features(data or b"")
                p = chain.probabilities(words, place)
                rows.append((*p, bool(words) and p[-1] >= LIMIT))
            yield pd.DataFrame(rows, columns=[*[f"p_{c}" for c in CATEGORIES], "toxic"])

    return docs.withColumn(into, scored(F.col(text_col).cast("binary")))


def without_toxic(docs: DataFrame, labels: DataFrame, shelf: Shelf, text_col: str = "text", **settings) -> DataFrame:
    """The rows of `docs` whose text is not toxic, unchanged."""
    chain = train(docs, labels, shelf, text_col=text_col, **settings)
    name = free("_scores", docs)
    return score(docs, chain, text_col, into=name).where(~F.col(f"{name}.toxic")).select(*docs.columns)
