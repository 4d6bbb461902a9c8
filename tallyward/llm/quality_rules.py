"""Quality rules with line labels from a linear-chain conditional random field.

Base rules count words, symbols, repeated lines and repeated five-word windows
of whole texts. A two-state chain (0 boilerplate, 1 content) then labels each
line that has a word: line features give emission scores, neighbouring lines
give transition scores, and Viterbi decoding finds the best label sequence. A
document stays if no base rule fails and content lines hold at least half of
its words.

NULL and empty texts have no words, fail the base rule and are not kept.
Repeated rows get equal verdicts, and rows that repeat a sampled doc_id count
once in training. Very long texts are counted and labelled whole. Other columns
are not read; an empty table gives no rows. Without usable labels the chain is neutral
and marks every line as content.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tallyward.llm import common

SAMPLE_DOCS = 800
#: Training looks at so many stretches of so many lines of a sampled document, spread over all of it.
STRETCHES, STRETCH = 8, 64
#: The sample holds so many documents of each label at least, if there are as many.
LEAST = 100
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_CONTENT_SHARE = 0.5
FEATURES = 10

_SYMBOLS = b"#*$%&|<>"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_SPACE = " \t\n\v\f\r"


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words inside ``width``-word windows that occur at least twice.

    Windows are compared exactly: words become numbers, and equal pairs of
    numbers become one number until a window is a single number."""
    n = len(words)
    if n <= width:
        return 0
    seen: dict[bytes, int] = {}
    one = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    window = one
    for k in range(1, width):
        _, window = np.unique(window[: n - k] * len(seen) + one[k:], return_inverse=True)
    again = (np.bincount(window) > 1)[window]
    covered = np.zeros(n, bool)
    for k in range(width):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def _without(raw: bytes, drop: bytes) -> int:
    return len(raw) - len(raw.translate(None, drop))


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split on exactly space and \t\n\v\f\r
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in _SPACE),
        _without(raw, _SYMBOLS),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x FEATURES, each 0 to 1) and words of the lines that have a word."""
    rows, sizes, earlier = [], [], set()
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        chars = len(line)
        symbols, upper = _without(line, _SYMBOLS), _without(line, _UPPER)
        rows.append((
            1.0,
            min(1.0, symbols / n),
            upper / chars,
            min(1.0, line.count(b"!") / n),
            _without(line, _DIGITS) / chars,
            min(1.0, line.count(b"|") / n),
            1.0 - len(set(words)) / n,
            1.0 / n,
            min(1.0, chars / n / 40.0),
            1.0 if line in earlier else 0.0,
        ))
        sizes.append(n)
        earlier.add(line)
    return np.array(rows, float).reshape(-1, FEATURES), np.array(sizes, np.int64)


class LineChain:
    """A linear-chain conditional random field with two states."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((FEATURES, 2)) if weights is None else weights
        if weights is None:
            self.weights[0, 1] = 1.0
        self.moves = np.zeros((2, 2)) if moves is None else moves

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The best label sequence (Viterbi); ties go to content."""
        if not len(features):
            return np.zeros(0, np.int64)
        (m00, m01), (m10, m11) = self.moves.tolist()
        scores = (features @ self.weights).tolist()
        a, b = scores[0]
        back = []
        for e0, e1 in scores[1:]:
            from0 = 1 if b + m10 >= a + m00 else 0
            from1 = 1 if b + m11 >= a + m01 else 0
            back.append((from0, from1))
            a, b = (b + m10 if from0 else a + m00) + e0, (b + m11 if from1 else a + m01) + e1
        path = [1 if b >= a else 0]
        for step in reversed(back):
            path.append(step[path[-1]])
        return np.array(path[::-1], np.int64)

    def content_share(self, text: str | None) -> float:
        features, sizes = line_features(text)
        if not len(sizes):
            return 0.0
        return float(sizes[self.decode(features) == 1].sum() / sizes.sum())

    def gradient(self, x: np.ndarray, y: np.ndarray, real: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood and its gradient by forward and backward sums.

        ``x`` docs x lines x features, ``y`` docs x lines, ``real`` marks the
        lines that exist; padding is at the end of a document."""
        docs, lines, _ = x.shape
        emit = x @ self.weights
        ahead = np.zeros((docs, lines, 2))
        ahead[:, 0] = emit[:, 0]
        for t in range(1, lines):
            nxt = np.logaddexp(ahead[:, t - 1, :1] + self.moves[0], ahead[:, t - 1, 1:] + self.moves[1]) + emit[:, t]
            ahead[:, t] = np.where(real[:, t, None], nxt, ahead[:, t - 1])
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        after = np.zeros((docs, lines, 2))
        for t in range(lines - 2, -1, -1):
            into = emit[:, t + 1] + after[:, t + 1]
            prev = np.logaddexp(self.moves[:, 0] + into[:, :1], self.moves[:, 1] + into[:, 1:])
            after[:, t] = np.where(real[:, t + 1, None], prev, 0.0)
        here = np.exp(ahead + after - total[:, None, None]) * real[..., None]
        told = np.eye(2)[y] * real[..., None]
        by_weight = np.einsum("dlf,dls->fs", x, told - here)
        by_move, score = np.zeros((2, 2)), float((emit * told).sum())
        both = (real[:, 1:] & real[:, :-1]).astype(float)
        for i in range(2):
            for j in range(2):
                pair = np.exp(
                    ahead[:, :-1, i] + self.moves[i, j] + emit[:, 1:, j] + after[:, 1:, j] - total[:, None]
                ) * both
                seen = told[:, :-1, i] * told[:, 1:, j]
                by_move[i, j] = (seen - pair).sum()
                score += self.moves[i, j] * seen.sum()
        return score - float(total.sum()), by_weight, by_move

    def fit(self, x: np.ndarray, y: np.ndarray, real: np.ndarray, steps: int = 80, decay: float = 1e-3) -> "LineChain":
        """Gradient ascent with per-weight step sizes (Adam)."""
        theta = np.concatenate([self.weights.ravel(), self.moves.ravel()])
        m, v, n = np.zeros_like(theta), np.zeros_like(theta), max(1.0, float(real.sum()))
        for step in range(1, steps + 1):
            self.weights, self.moves = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
            _, w, t = self.gradient(x, y, real)
            g = np.concatenate([w.ravel(), t.ravel()]) / n - decay * theta
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta = theta + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.weights, self.moves = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        return self


def fit_chain(
    sample: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 3, owners: list[int] | None = None
) -> LineChain:
    """Train on documents whose lines have no labels of their own.

    Lines start with the label of their document. After each fit, a document
    of poor quality takes the decoded labels where these still leave at least
    half of its words to boilerplate; documents of good quality stay content.
    ``owners`` names the document of each sequence, where one has several.
    """
    owners = [k for k, s in zip(owners or range(len(sample)), sample) if len(s[1])]
    sample = [s for s in sample if len(s[1])]
    if len({good for _, _, good in sample}) < 2:
        return LineChain()
    longest = max(len(sizes) for _, sizes, _ in sample)
    x = np.zeros((len(sample), longest, FEATURES))
    y = np.zeros((len(sample), longest), np.int64)
    real = np.zeros((len(sample), longest), bool)
    for d, (features, sizes, good) in enumerate(sample):
        x[d, : len(sizes)], y[d, : len(sizes)], real[d, : len(sizes)] = features, good, True
    chain = LineChain().fit(x, y, real)
    for _ in range(rounds - 1):
        paths, content, words = {}, Counter(), Counter()
        for d, (features, sizes, good) in enumerate(sample):
            if not good:
                paths[d] = chain.decode(features)
                content[owners[d]] += int(sizes[paths[d] == 1].sum())
                words[owners[d]] += int(sizes.sum())
        for d, path in paths.items():
            if 2 * content[owners[d]] <= words[owners[d]]:
                y[d, : len(path)] = path
        chain = LineChain().fit(x, y, real)
    return chain


def stretches(n: int, most: int, size: int) -> list[tuple[int, int]]:
    """Up to ``most`` stretches of ``size`` of n lines: all lines if there are no more, else spread evenly."""
    if n <= most * size:
        return [(at, min(n, at + size)) for at in range(0, n, size)]
    starts = [round(k * (n - size) / max(1, most - 1)) for k in range(most)]
    return [(at, at + size) for at in starts]


def train(
    docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS, least: int = LEAST, many: int = STRETCHES, size: int = STRETCH
) -> LineChain:
    """Fit the chain on about ``most`` labelled documents, at least ``least``
    of each label, and ``many`` stretches of ``size`` lines of each. Only line
    features of the sample reach the driver."""

    def features(batches):
        for pdf in batches:
            for doc_id, text, label in zip(pdf["doc_id"], pdf["text"], pdf["y"]):
                x, sizes = line_features(text)
                cuts = stretches(len(sizes), many, size) or [(0, 0)]
                yield pd.DataFrame({
                    "doc_id": doc_id, "start": [a for a, _ in cuts], "good": int(label > 0),
                    "x": [x[a:b].ravel().tolist() for a, b in cuts], "sizes": [sizes[a:b].tolist() for a, b in cuts],
                })

    chosen = common.labelled(docs, labels, F.col("quality"), most, least=least)
    got = chosen.mapInPandas(features, "doc_id long, start long, good long, x array<double>, sizes array<long>").toPandas()
    got = got.sort_values(["doc_id", "start"], kind="stable")
    return fit_chain([
        (np.asarray(x, float).reshape(-1, FEATURES), np.asarray(s, np.int64), int(good))
        for x, s, good in zip(got["x"], got["sizes"], got["good"])
    ], owners=got["doc_id"].tolist())


def verdict(chain: LineChain, text: str | None) -> bool:
    n_words, _, _, _, n_repeat = base_counts(text)
    return not base_failed(n_words, n_repeat) and chain.content_share(text) >= MIN_CONTENT_SHARE


def judge(docs: DataFrame, chain: LineChain) -> DataFrame:
    """One row per input row: doc_id, the base counts, base_failed, content_share, kept."""

    def rows(batches):
        for pdf in batches:
            counts = [base_counts(t) for t in pdf["text"]]
            out = pd.DataFrame(
                counts, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], dtype="int64"
            )
            out.insert(0, "doc_id", pdf["doc_id"].array)
            out["base_failed"] = [base_failed(c[0], c[4]) for c in counts]
            out["content_share"] = [chain.content_share(t) for t in pdf["text"]]
            out["kept"] = ~out["base_failed"].astype(bool) & (out["content_share"] >= MIN_CONTENT_SHARE)
            yield out

    return docs.select("doc_id", "text").mapInPandas(
        rows,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, content_share double, kept boolean",
    )


def keep_good(docs: DataFrame, chain: LineChain) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""

    @F.pandas_udf(BooleanType())
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series([verdict(chain, t) for t in texts], dtype="bool")

    return docs.where(good(F.col("text").cast("string")))
