"""Quality of texts by ordinal regression on graded ratings.

A document with grades 0 to K-1 has one latent score, linear in hashed features
of its text; ordered thresholds cut the score into grades: P(grade >= k) is the
logistic function of score - threshold k. All grades share the weights. The
thresholds are kept in order by learning the logarithms of their gaps. The
model gives the expected grade and the tail probability of a chosen grade,
by which documents are selected.

Features of a text are shares of its words: hashed words, hashed shapes (case,
digits, signs), repetition of the word before, and length. Words are read one
by one with a remembered weight each, so whole texts cost little more than
splitting them.

NULL and empty texts have the features of no words and get a score like any
other. Repeated rows get equal results, and rows that repeat a sampled doc_id
count once in training. Very long texts and words are read whole. Of grades
that are equally probable the lowest is given. Other columns are not read; an
empty table gives no rows. Without ratings of two grades every
document gets grade 0, tail probability 0, and is not selected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm import common

SAMPLE_DOCS = 4_000
BINS = 1 << 14
#: Plain features after the hashed ones: repeats, log length, no words.
PLAIN = 3
WORDS = 200_000  # words that a worker remembers
SHORT = 64  # only words of at most so many characters are remembered
#: The sample holds so many documents of each grade at least, if there are as many.
LEAST = 200
SELECT = 0.5

_KINDS = str.maketrans(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "A" * 26 + "a" * 26 + "9" * 10
)


def shape(word: str) -> str:
    """Kinds of characters in a word, runs shortened: letters a or A (other alphabets too), 9, signs as they are."""
    out = []
    for c in word.translate(_KINDS):
        if c.isalpha():
            c = "A" if c.isupper() else "a"
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out)


def bins(word: str) -> tuple[int, int]:
    """The bins of a word and of its shape; shapes have the upper half."""
    half = BINS // 2
    return (
        xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass")) % half,
        half + xxhash.xxh64_intdigest(shape(word).encode("utf-8", "surrogatepass")) % half,
    )


def plain(words: list[str]) -> list[float]:
    n = len(words)
    again = sum(a == b for a, b in zip(words, words[1:]))
    return [again / max(1, n), min(1.0, math.log1p(n) / 8), 0.0 if n else 1.0]


def features(text: str | None) -> tuple[list[int], list[float], list[float]]:
    """Hashed bins and their shares, and the plain features."""
    words = (text or "").split()
    got: dict[int, float] = {}
    for w in words:
        for b in bins(w):
            got[b] = got.get(b, 0.0) + 1.0 / len(words)
    return list(got), list(got.values()), plain(words)


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass
class OrdinalModel:
    grades: list[float]
    weights: np.ndarray | None = None
    thresholds: np.ndarray | None = None

    def tails(self, score: float) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K-1."""
        return _logistic(score - self.thresholds)

    def grade(self, score: float) -> tuple[float, int]:
        """Expected grade, and the most probable one."""
        above = np.concatenate([[1.0], self.tails(score), [0.0]])
        p = above[:-1] - above[1:]
        return float(p @ np.array(self.grades)), int(self.grades[int(p.argmax())])

    def fit(self, rows, grades: np.ndarray, steps: int = 250, rate: float = 0.1, decay: float = 1e-4) -> "OrdinalModel":
        """Cumulative-link likelihood by Adam. ``rows``: sparse (row, bin, share) and plain features."""
        (row, bin_, share), more = rows
        n, k = len(grades), len(self.grades)
        level = np.searchsorted(self.grades, grades)
        theta = np.zeros(BINS + PLAIN)
        base = np.array([np.mean(level >= j) for j in range(1, k)]).clip(1e-3, 1 - 1e-3)
        cut = -np.log(base / (1 - base))
        gaps = np.log(np.maximum(np.diff(cut), 1e-2))
        p = np.concatenate([theta, cut[:1], gaps])
        m, v = np.zeros_like(p), np.zeros_like(p)
        for step in range(1, steps + 1):
            theta, first, gaps = p[: BINS + PLAIN], p[BINS + PLAIN], p[BINS + PLAIN + 1 :]
            cuts = np.concatenate([[first], first + np.cumsum(np.exp(gaps))])
            score = np.bincount(row, weights=share * theta[bin_], minlength=n) + more @ theta[BINS:]
            upper = np.where(level > 0, _logistic(score - np.concatenate([[0.0], cuts])[level]), 1.0)
            lower = np.where(level < k - 1, _logistic(score - np.concatenate([cuts, [0.0]])[level]), 0.0)
            prob = np.maximum(upper - lower, 1e-9)
            d_up = np.where(level > 0, upper * (1 - upper), 0.0) / prob
            d_low = np.where(level < k - 1, lower * (1 - lower), 0.0) / prob
            d_score = (d_up - d_low) / n
            g_theta = np.bincount(bin_, weights=share * d_score[row], minlength=BINS + PLAIN)
            g_theta[BINS:] += more.T @ d_score
            g_cut = np.array([
                (-d_up * (level == j) + d_low * (level == j - 1)).sum() / n for j in range(1, k)
            ])
            g = np.concatenate([
                g_theta - decay * theta, [g_cut.sum()],
                [np.exp(gaps[j]) * g_cut[j + 1 :].sum() for j in range(k - 2)],
            ])
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            p = p + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.weights = p[: BINS + PLAIN]
        self.thresholds = p[BINS + PLAIN] + np.concatenate([[0.0], np.cumsum(np.exp(p[BINS + PLAIN + 1 :]))])
        return self

    def score(self, text: str | None, known: dict[str, float]) -> float:
        """The latent score; ``known`` remembers the weight of words."""
        words, total = (text or "").split(), 0.0
        for w in words:
            got = known.get(w)
            if got is None:
                a, b = bins(w)
                got = float(self.weights[a] + self.weights[b])
                if len(w) <= SHORT:
                    if len(known) >= WORDS:
                        known.clear()
                    known[w] = got
            total += got
        return total / max(1, len(words)) + float(np.dot(plain(words), self.weights[BINS:]))


def train(
    docs: DataFrame, ratings: DataFrame, grade: Column, most: int = SAMPLE_DOCS, least: int = LEAST
) -> OrdinalModel:
    """Fit on about ``most`` rated documents, at least ``least`` of each grade;
    ``grade`` is a number column of ``ratings``. Only hashed features of the
    sample reach the driver."""

    def rows(batches):
        for pdf in batches:
            found = [features(t) for t in pdf["text"]]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"], "y": pdf["y"], "bins": [f[0] for f in found],
                "shares": [f[1] for f in found], "plain": [f[2] for f in found],
            })

    got = common.labelled(docs, ratings, grade, most, least=least).mapInPandas(
        rows, "doc_id long, y double, bins array<int>, shares array<double>, plain array<double>"
    ).toPandas().sort_values("doc_id", kind="stable")
    grades = sorted(got["y"].unique().tolist())
    model = OrdinalModel(grades)
    if len(grades) < 2:
        return model
    row = np.repeat(np.arange(len(got)), got["bins"].map(len).to_numpy())
    sparse = row, np.concatenate(got["bins"].to_list()).astype(np.int64), np.concatenate(got["shares"].to_list())
    return model.fit((sparse, np.array(got["plain"].to_list(), float)), got["y"].to_numpy())


def rate(docs: DataFrame, model: OrdinalModel, tail: int = 1, select: float = SELECT) -> DataFrame:
    """doc_id, expected_grade, grade, p_tail (probability of the ``tail``-th
    grade above the lowest, or a higher one), kept (p_tail at least ``select``)."""

    def rows(batches):
        known: dict[str, float] = {}
        for pdf in batches:
            out = []
            for t in pdf["text"]:
                if model.weights is None:
                    out.append((0.0, 0, 0.0))
                    continue
                s = model.score(t, known)
                tails = model.tails(s)
                out.append((*model.grade(s), float(tails[tail - 1]) if tail <= len(tails) else 0.0))
            got = pd.DataFrame(out, columns=["expected_grade", "grade", "p_tail"])
            got.insert(0, "doc_id", pdf["doc_id"].array)
            yield got.assign(kept=got["p_tail"] >= select).astype({"grade": "int32"})

    return docs.select("doc_id", F.col("text").cast("string")).mapInPandas(
        rows, "doc_id long, expected_grade double, grade int, p_tail double, kept boolean"
    )
