"""Quality rules by labelling lines with a linear-chain conditional random field.

Each line of a text is content or boilerplate. The field scores a line by its features and each step by the two
labels it joins; Viterbi decoding finds the best labels of all lines together, and the share of the words that
stand in content lines decides whether the text stays.

The weights are learnt from a bounded sample of labelled documents: lines of documents of good quality are
content, lines of bad ones boilerplate, except lines that look the other way round by the base counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsquake.llm.common import Shelf, utf8

SYMBOLS = "#*$%&|<>"
SAMPLE = 1000  # labelled documents of each class at most
EPOCHS = 6
CONTENT_SHARE = 0.5
LABELS = 2  # 0 boilerplate, 1 content

FEATURES = ("bias", "short", "medium", "symbols", "many symbols", "shouting", "exclaiming", "digits", "piped", "seen before", "word repeats", "ends a sentence", "long words")


def line_features(words: list[str], seen: bool) -> list[float]:
    """Of a line with words; seen: the text had it before."""
    n = len(words)
    joined = "".join(words)
    chars = len(joined)
    symbols = sum(joined.count(c) for c in SYMBOLS)
    letters = [w for w in words if len(w) > 1 and w.upper() != w.lower()]
    shouted = sum(w == w.upper() for w in letters)
    return [
        1.0,
        float(n < 4),
        float(4 <= n < 9),
        float(symbols > 0.02 * chars),
        float(symbols > 0.1 * chars),
        float(len(letters) > 1 and shouted > 0.5 * len(letters)),
        float(2 * sum(w.endswith("!") for w in words) > n),
        float(sum(map(str.isdigit, joined)) > 0.2 * chars),
        float(joined.count("|") * 3 > n),
        float(seen),
        float(n > 5 and len(set(words)) * 2 < n),
        float(joined[-1] in ".?:;"),
        float(chars > 14 * n),
    ]


def lines_of(text: str) -> tuple[np.ndarray, list[int]]:
    """Features and word counts of the lines that have a word."""
    rows, counts, seen = [], [], set()
    for line in text.split("\n"):
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        if words:
            rows.append(line_features(words, line in seen))
            counts.append(len(words))
            seen.add(line)
    return np.array(rows, np.float64).reshape(-1, len(FEATURES)), counts


def viterbi(scores: np.ndarray, steps: np.ndarray) -> list[int]:
    """The best labels; scores: lines by labels, steps: from label by to label. Ties go to content."""
    best, back = [scores[0].tolist()], []
    (aa, ab), (ba, bb) = steps.tolist()
    for s0, s1 in scores[1:].tolist():
        p0, p1 = best[-1]
        from0, from1 = int(p1 + ba >= p0 + aa), int(p1 + bb >= p0 + ab)
        back.append((from0, from1))
        best.append([s0 + (p1 + ba if from0 else p0 + aa), s1 + (p1 + bb if from1 else p0 + ab)])
    label = int(best[-1][1] >= best[-1][0])
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return out[::-1]


def _marginals(scores: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each line's label and summed probability of each step, by forward and backward passes."""
    n = len(scores)
    ahead, behind = np.zeros((n, LABELS)), np.zeros((n, LABELS))
    ahead[0] = scores[0]
    for i in range(1, n):
        ahead[i] = scores[i] + np.logaddexp(ahead[i - 1][0] + steps[0], ahead[i - 1][1] + steps[1])
    for i in range(n - 2, -1, -1):
        behind[i] = np.logaddexp(steps[:, 0] + scores[i + 1][0] + behind[i + 1][0], steps[:, 1] + scores[i + 1][1] + behind[i + 1][1])
    total = np.logaddexp(*ahead[-1])
    pairs = ahead[:-1, :, None] + steps[None] + (scores[1:] + behind[1:])[:, None, :] - total
    return np.exp(ahead + behind - total), np.exp(pairs).sum(axis=0)


def fit_field(sequences: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(weights of features by label, weights of steps) that raise the likelihood of (features, labels) sequences."""
    weights, steps = np.zeros((len(FEATURES), LABELS)), np.zeros((LABELS, LABELS))
    order = np.random.default_rng(7)
    for epoch in range(epochs):
        rate = 0.1 / (1 + epoch)
        for i in order.permutation(len(sequences)):
            x, y = sequences[i]
            p, moved = _marginals(x @ weights, steps)
            truth = np.eye(LABELS)[y]
            seen = np.zeros((LABELS, LABELS))
            np.add.at(seen, (y[:-1], y[1:]), 1)
            weights += rate * (x.T @ (truth - p) / len(x) ** 0.5 - 0.001 * weights)
            steps += rate * ((seen - moved) / len(x) ** 0.5 - 0.001 * steps)
    return weights, steps


def train_field(docs: DataFrame, labels: DataFrame, shelf: Shelf, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The field fitted on at most `sample` labelled documents of each class, the first by a hash of their ids.

    Texts of the sample are turned into features on the executors. Without documents of both classes the field
    has no weights and calls every line content.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("id"), F.col("id")]
    picked = known.where("quality = 1").orderBy(*order).limit(sample).union(known.where("quality = 0").orderBy(*order).limit(sample))

    @F.pandas_udf("array<array<double>>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([lines_of(t or "")[0].tolist() for t in texts])

    rows = F.broadcast(shelf.put(picked))  # two times `sample` rows at most
    # Stored first: a test on features would be pushed below the join and run on every document.
    texts = shelf.put(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(rows, "id"))
    told = shelf.put(texts.select("id", "quality", features("text").alias("x")))
    found = told.where(F.size("x") > 0).orderBy("id").collect()
    shelf.drop(texts)
    if len({r.quality for r in found}) < 2:
        return np.zeros((len(FEATURES), LABELS)), np.zeros((LABELS, LABELS))
    sequences = []
    again, bias = FEATURES.index("seen before"), FEATURES.index("bias")
    for r in found:
        x = np.array(r.x)
        y = np.where(x[:, again] > 0, 0, int(r.quality) * x[:, bias]).astype(int)  # a line said before adds nothing
        sequences.append((x, y))
    return fit_field(sequences)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = utf8(text).split()
    n = len(words)
    chars = len(re.sub(r"[\x20\x09-\x0D]+", "", text)) if n else 0
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = Counter(line for line in text.split("\n") if line.strip("\x20\t\n\x0b\x0c\r"))
    repeats = 0
    if n > 3:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
        size = len(number)
        if size < 1 << 21:
            windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
        else:
            pairs = np.unique(ids[:-2] * size + ids[1:-1], return_inverse=True)[1]
            windows = pairs * size + ids[2:]
        _, where, times = np.unique(windows, return_inverse=True, return_counts=True)
        start = np.concatenate((times[where] > 1, [False, False]))
        often = start.copy()
        often[1:] |= start[:-1]
        often[2:] |= start[:-2]
        repeats = int(often.sum())
    return n, chars, symbols, sum(lines.values()) - len(lines), repeats


def judge_lines(docs: DataFrame, field: tuple[np.ndarray, np.ndarray], text_col: str = "text", into: str = "quality") -> DataFrame:
    """`docs` with a struct `into`: the base counts, n_lines, n_content (lines), content_share (of words), base_failed, kept.

    base_failed: under 50 words, or over half of them in repeated three-word windows. kept: not base_failed and at
    least half of the words in content lines. Null and empty texts have no words and fail. Whole texts count.
    """
    weights, steps = field

    @F.pandas_udf("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_content bigint, content_share double, base_failed boolean, kept boolean")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                text = text or ""
                base = base_counts(text)
                x, counts = lines_of(text)
                labels = viterbi(x @ weights, steps) if counts else []
                share = sum(n for n, label in zip(counts, labels) if label) / max(1, base[0])
                failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
                rows.append((*base, len(counts), sum(labels), share, failed, not failed and share >= CONTENT_SHARE))
            yield pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_content", "content_share", "base_failed", "kept"])

    return docs.withColumn(into, judged(F.col(text_col)))
