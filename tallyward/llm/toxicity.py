"""Toxicity of texts that may be disguised: a noisy channel, then a word score.

A disguise replaces letters (1d1ot), repeats them (idiiiot) or spaces them out
(i d i o t). A suspicious token is read as a lattice: each character may stand
for itself or for the letters it imitates, and a run of one letter for one or
two of it. In a stretch of short fragments, and in a token with signs inside,
each separator is either skipped or ends a word. The best path under a character trigram model of the corpus, less
the costs of the channel, is the restored token (Viterbi). The trigrams are
counted over all documents.

A disguise is rare, so each pays its log-odds: a token is only read as
disguised if that is ``ODDS`` better than reading it as it stands, and the
first separator skipped in a word costs ``FIRST_SHORT`` between single letters
and ``FIRST`` elsewhere. Keeping what is written costs nothing, so plain text
comes back unchanged.

Restored words and their beginnings are features. From a bounded sample of
labelled documents, features that mark toxic documents with confidence get
their log-odds as weight; two pooled sums of a document go through a logistic
model. Labels of held-out documents are never read.

NULL and empty texts have no features and get the base rate of the model.
Repeated rows get equal scores, and rows that repeat a sampled doc_id count
once in training. Very long texts and tokens are read whole. Of readings with
equal scores the first found is taken, the same in every run. Other columns are
not read; an empty table gives no rows. Without labels of both kinds all scores
are 0.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm import common
from tallyward.session import stored_copy

SAMPLE_DOCS = 8_000
#: A feature counts if it stands in so many toxic sample documents, with this much evidence (likelihood ratio).
MIN_TOXIC = 4
MIN_EVIDENCE = 12.0
BEGINNINGS = (3, 4, 5)
#: The sample holds so many documents of each label at least, if there are as many.
LEAST = 500
PAIRS = 200_000  # pairs of short fragments whose gain a worker remembers
READINGS = 50_000  # readings in each of two generations that a worker remembers
TOXIC, OTHERS = "+", "-"  # what counts the documents of each label among the features
SHORT = 64  # only tokens of at most so many characters are remembered, or named in full as features

#: What characters imitate.
IMITATED = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}

#: The letters of the trigram model: border, the Latin alphabet, common accented letters, all others.
ALPHABET = "\0abcdefghijklmnopqrstuvwxyzàâäáãåçèéêëìíîïñòóôöõùúûüýÿß\1"
SIZE = 64
_OTHER = len(ALPHABET) - 1
_INDEX = {c: k for k, c in enumerate(ALPHABET)}
_CODE = np.full(0x180, _OTHER, np.int64)
for _c, _k in _INDEX.items():
    if _c.isalpha():
        _CODE[ord(_c)] = _k
_CODE[[ord(c) for c in "\0 \t\n\r\v\f"]] = 0

REPLACED, DROPPED, JOINED = -1.5, -1.0, -0.5  # channel costs, as log-probabilities
#: Log-odds against a disguise: of a token, of an imitation among fragments, of a word parted between
#: single letters or elsewhere (the highest gains of joining plain words are about 6 and 9).
ODDS, IMITATION, FIRST_SHORT, FIRST = 6.0, -4.0, -6.5, -9.0

_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "@$") + "¡¿…«»„“”’"
_RUN = re.compile(r"([^\W\d_])\1\1")
_LETTER = r"(?:[^\W\d_]|[0134578@$!])"
_SIGNS = r"[\s.\-_*]"
#: Fragments of up to three letters, at least two of them, whatever separates them.
_FRAGMENT = rf"(?=[@$!]*[^\W_]){_LETTER}{{1,3}}+(?![^\W_])"
_SPACED = re.compile(rf"(?<![^\s.\-_*(\"'¡¿]){_FRAGMENT}(?:{_SIGNS}{{1,3}}+{_FRAGMENT})++")
#: Single letters, at least three of them, parted by one and the same sign.
_SINGLES = re.compile(rf"(?<![^\W_]){_LETTER}({_SIGNS}){_LETTER}(?![^\W_])(?:\1{_LETTER}(?![^\W_]))++")
_GAPS = re.compile(rf"{_SIGNS}+")
#: One letter in three fragments running, or three times in one: perhaps repeated to disguise it.
_SAME = re.compile(r"([^\W\d_])(?: ?\1){2}", re.IGNORECASE)
_ALPHA = re.compile(r"[^\W\d_]")
#: Signs inside a token that imitate no letter.
_PARTS = re.compile(r"[^\w@$!|+(€£]+|_+")


def letter_counts(texts, chars: int = 1 << 20) -> np.ndarray:
    """Trigrams of letters in lower-cased texts, as one array of 64^3 counts."""
    total = np.zeros(SIZE**3, np.int64)
    held, size = [], 0
    for text in texts:
        if text:
            held.append("\0" + text.lower() + "\0\0")
            size += len(held[-1])
        if size > chars:
            total += _trigrams(held)
            held, size = [], 0
    return total + _trigrams(held)


def _trigrams(texts: list[str]) -> np.ndarray:
    if not texts:
        return np.zeros(SIZE**3, np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    k = _CODE[np.minimum(codes, len(_CODE) - 1)]
    at = (k[:-2] * SIZE + k[1:-1]) * SIZE + k[2:]
    ends = np.cumsum([len(t) for t in texts[:-1]], dtype=np.int64)
    # what starts with the last two signs of a text runs into the next
    return np.bincount(np.delete(at, np.concatenate([ends - 2, ends - 1])), minlength=SIZE**3)


class LetterModel:
    """Log-probabilities of a letter after two others, smoothed by the pair and the single letter."""

    def __init__(self, counts: np.ndarray):
        n = counts.reshape(SIZE, SIZE, SIZE).astype(float)
        used = np.zeros(SIZE)
        used[: len(ALPHABET)] = 1
        one = (n.sum(axis=(0, 1)) + 0.1) * used
        one /= one.sum()
        two = n.sum(axis=0)
        two = (two + 5 * one) / (two.sum(axis=1, keepdims=True) + 5)
        three = (n + 5 * two[None]) / (n.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(np.maximum(three, 1e-12)).astype(np.float32)
        self.flat: list[float] = []
        self.gains: dict[tuple[str, str], float] = {}

    def _table(self) -> list[float]:
        """The logarithms as one list, made once per worker: single look-ups in it are fast."""
        if not self.flat:
            self.flat = self.log.ravel().tolist()
        return self.flat

    def __getstate__(self):
        return {"log": self.log, "flat": [], "gains": {}}

    def plain(self, token: str) -> float:
        """Log-probability of a lower-case token as it stands."""
        log, a, b, total = self._table(), 0, 0, 0.0
        for c in token:
            k = 0 if c == " " else _INDEX.get(c, _OTHER)
            total += log[(a * SIZE + b) * SIZE + k]
            a, b = b, k
        return total + log[(a * SIZE + b) * SIZE]

    def join(self, parts: list[str]) -> list[str]:
        """The best reading of lower-case fragments of letters: each gap ends a
        word, or is skipped at its price. Only two states can be open after a
        fragment: the word began with it, or goes on through it."""
        if min(map(len, parts)) > 1:
            # what a gap gains then depends on its two fragments only; a word pays FIRST at least
            total, gains = 0.0, self.gains
            for pair in zip(parts, parts[1:]):
                gain = gains.get(pair)
                if gain is None:
                    if len(gains) >= PAIRS:
                        gains.clear()
                    gain = gains[pair] = max(0.0, self.plain(pair[0] + pair[1]) - self.plain(pair[0] + " " + pair[1]))
                total += gain
            if total < -FIRST:
                return parts
        log, states, steps, size = self._table(), None, [], 0
        for part in parts:
            codes = [_INDEX.get(c, _OTHER) for c in part]
            got = []
            if states is None:
                got.append((0.0, 0, 0, 0, -1))
            else:
                # a new word, from the better of the states
                score, k = max((t[0] + log[(t[1] * SIZE + t[2]) * SIZE] + log[t[2] * SIZE * SIZE + codes[0]], -i) for i, t in enumerate(states))
                got.append((score, 0, codes[0], 1, -k))
                # or on with the word, where going on is cheaper than beginning to skip
                short, more = size == 1 == len(part), JOINED * (size + len(part) - 1)
                score, k = max(
                    (t[0] + (more if t[3] else FIRST_SHORT if short else FIRST) + log[(t[1] * SIZE + t[2]) * SIZE + codes[0]], -i)
                    for i, t in enumerate(states)
                )
                t = states[-k]
                got.append((score, t[2], codes[0], 1, -k))
            states = []
            back = []
            for on, (score, a, b, at, k) in enumerate(got):
                for c in codes[at:]:
                    score += log[(a * SIZE + b) * SIZE + c]
                    a, b = b, c
                states.append((score, a, b, on))
                back.append(k)
            steps.append(back)
            size = len(part)
        k = max(range(len(states)), key=lambda i: (states[i][0] + log[(states[i][1] * SIZE + states[i][2]) * SIZE], -i))
        words: list[str] = []
        tail = ""
        for part, back in zip(reversed(parts), reversed(steps)):
            tail = part + tail
            if k == 0:
                words.append(tail)
                tail = ""
            k = back[k]
        return words[::-1]

    def restore(self, token: str, spaced: bool = False) -> str:
        return self.best(token, spaced)[0]

    def best(self, token: str, spaced: bool = False) -> tuple[str, float]:
        """The best reading of a token and its score (Viterbi over letter
        pairs). ``spaced``: of fragments parted by single spaces, each of which
        is skipped at its price or ends a word, and whose signs may also stand
        for themselves."""
        log = self._table()
        sizes = [len(part) for part in token.split(" ")] if spaced else []
        gaps = iter([(JOINED * (m + n - 1), FIRST_SHORT if m == n == 1 else FIRST) for m, n in zip(sizes, sizes[1:])])
        # states: (last two letters, whether the word has skipped) -> (score, reading as linked letters from the last one, last letter)
        states = {(0, 0, False): (0.0, None, "")}
        for c in token.lower():
            options = [(c, 0.0)] if c.isalpha() else []
            options += [(x, IMITATION if spaced else REPLACED) for x in IMITATED.get(c, "")]
            if spaced and not c.isalpha() and c != " ":
                options.append((c, 0.0))
            more, first = next(gaps) if spaced and c == " " else (DROPPED, DROPPED)
            nxt: dict[tuple[int, int, bool], tuple[float, tuple | None, str]] = {}

            def put(key, score, path, last):
                if key not in nxt or nxt[key][0] < score:
                    nxt[key] = (score, path, last)

            for (a, b, on), (score, path, last) in states.items():
                base = (a * SIZE + b) * SIZE
                if not options:  # a sign that stands for no letter
                    put((a, b, on or spaced), score + (more if on else first), path, last)
                if spaced and c == " " and b:
                    put((b, 0, False), score + log[base], (path, " "), "")
                for letter, cost in options:
                    k = _INDEX.get(letter, _OTHER)
                    put((b, k, on), score + cost + log[base + k], (path, letter), letter)
                    if last == letter and letter.isalpha():
                        put((a, b, on), score + cost + DROPPED, path, last)  # one more of the same
            states = nxt
        (a, b, _), (score, path, _) = max(states.items(), key=lambda s: s[1][0] + log[(s[0][0] * SIZE + s[0][1]) * SIZE])
        letters = []
        score += log[(a * SIZE + b) * SIZE]
        while path is not None:
            path, letter = path
            letters.append(letter)
        return "".join(reversed(letters)).strip(), score


def suspicious(word: str) -> bool:
    """Letters and imitations mixed, or three of a letter in a row."""
    return (
        any(c in IMITATED for c in word) and any(c.isalpha() for c in word)
    ) or _RUN.search(word) is not None


def features(word: str) -> list[str]:
    """A word, marked, and its beginnings. A long word is named by its hash."""
    if len(word) > SHORT:
        word = word[: BEGINNINGS[-1]] + "#" + xxhash.xxh64_hexdigest(word.encode("utf-8", "surrogatepass"))
    return ["=" + word, *[word[:n] for n in BEGINNINGS if len(word) >= n]]


@dataclass
class Reader:
    """Restores texts and gives their words; remembers readings of this worker."""

    letters: LetterModel
    known: dict[str, str] = field(default_factory=dict)
    knew: dict[str, str] = field(default_factory=dict)
    starts: set[str] | None = None  # how words with a weight begin

    def remembered(self, key: str, read) -> str:
        got = self.known.get(key)
        if got is None:
            got = self.knew.get(key)
            if got is None:
                got = read()
            if len(key) <= SHORT:
                if len(self.known) >= READINGS:
                    self.known, self.knew = {}, self.known
                self.known[key] = got
        return got

    def word(self, token: str) -> str:
        """The reading of a token; words that signs part in it are parted by spaces."""
        bare = token.strip(_EDGES)
        return self.remembered(bare, lambda: self.read(bare)) if suspicious(bare) else bare.lower()

    def read(self, token: str) -> str:
        parts = [p for p in _PARTS.split(token) if p]
        plain = " ".join(parts).lower()
        if len(parts) > 1:
            return self.letters.restore(plain, True)
        reading, score = self.letters.best(token)
        return reading if score - self.letters.plain(plain) > ODDS else plain

    def stretch(self, m: re.Match) -> str:
        """The reading of a stretch of short fragments, or itself if nothing is skipped in it."""
        text = m.group()
        if not _ALPHA.search(text):
            return text
        parts = _GAPS.split(text)
        bare = " ".join(parts)
        if all(map(str.isalpha, parts)) and not _SAME.search(bare):
            words = self.letters.join(bare.lower().split(" "))
            return text if len(words) == len(parts) else " ".join(words)
        got = self.remembered(" " + bare, lambda: self.letters.restore(bare, True))
        return text if got == bare.lower() else got

    def words(self, text: str | None) -> set[str]:
        """Different restored words of a text, spaced-out words included."""
        if not text:
            return set()
        found = {token.strip(_EDGES) for token in set(text.lower().split())}
        odd = found if _RUN.search(text) else [token for token in found if not token.isalpha()]
        for token in [token for token in odd if suspicious(token)]:
            found.remove(token)
            found.update(self.word(token).split())
        singles = list(_SINGLES.finditer(text))
        for m in singles:
            if _ALPHA.search(m.group()):
                found.add(self.letters.restore("".join(_GAPS.split(m.group()))))
                found.update(self.stretch(m).split())
        for m in _SPACED.finditer(_SINGLES.sub(self.stretch, text) if singles else text):
            got = self.stretch(m)
            if got != m.group():
                found.update(got.split())
            elif m.group().count(" ") + 1 < len(_GAPS.split(got)):
                found.update(_GAPS.split(got.lower()))  # parted by other signs than spaces
        found.discard("")
        return found

    def restored(self, text: str | None) -> str:
        """The text with disguised tokens and stretches replaced by their readings."""
        if not text:
            return ""

        def token(m: re.Match) -> str:
            bare = m.group().strip(_EDGES)
            if not suspicious(bare):
                return m.group()
            got = self.word(m.group())
            same = got.replace(" ", "") == "".join(_PARTS.split(bare)).lower()
            return m.group() if same else m.group().replace(bare, got)

        return re.sub(r"\S+", token, _SPACED.sub(self.stretch, _SINGLES.sub(self.stretch, text)))


def count_letters(docs: DataFrame) -> LetterModel:
    """Trigram counts over all documents. The driver gets at most 64^3 sums."""

    def count(batches):
        total = np.zeros(SIZE**3, np.int64)
        for pdf in batches:
            total += letter_counts(pdf["text"])
        some = np.flatnonzero(total)
        yield pd.DataFrame({"code": some, "n": total[some]})

    rows = (
        docs.select(F.col("text").cast("string")).mapInPandas(count, "code long, n long")
        .groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    )
    counts = np.zeros(SIZE**3, np.int64)
    counts[rows["code"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return LetterModel(counts)


@dataclass
class ToxicityModel:
    letters: LetterModel
    weights: dict[str, float] = field(default_factory=dict)
    logistic: np.ndarray | None = None

    def pooled(self, reader: Reader, text: str | None) -> tuple[float, float]:
        """Largest weight of a word, and the sum of the weights of all different words."""
        get, starts = self.weights.get, reader.starts
        if starts is None:
            starts = reader.starts = {f.removeprefix("=")[:3] for f in self.weights}
        held = [max([get(f, 0.0) for f in features(w)]) for w in reader.words(text) if w[:3] in starts]
        return max(held, default=0.0), math.log1p(math.fsum(held))  # whatever order the set has

    def score(self, pooled: tuple[float, float]) -> float:
        if self.logistic is None:
            return 0.0
        z = float(self.logistic @ np.array([1.0, *pooled]))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _evidence(n1: np.ndarray, n0: np.ndarray, all1: float, all0: float) -> np.ndarray:
    """Likelihood ratio of a feature's share in toxic and other documents, one-sided."""
    p1, p0 = n1 / all1, n0 / all0
    p = (n1 + n0) / (all1 + all0)

    def ll(k, n, q):
        q = np.clip(q, 1e-12, 1 - 1e-12)
        return k * np.log(q) + (n - k) * np.log(1 - q)

    g = 2 * (ll(n1, all1, p1) + ll(n0, all0, p0) - ll(n1, all1, p) - ll(n0, all0, p))
    return np.where(p1 > p0, g, 0.0)


def train(
    docs: DataFrame, labels: DataFrame, allowed: Column, most: int = SAMPLE_DOCS, least: int = LEAST
) -> ToxicityModel:
    """Count letters over all documents, then learn from about ``most``
    labelled documents for whose label rows ``allowed`` holds, at least
    ``least`` of each label."""
    letters = count_letters(docs)
    sample = stored_copy(common.labelled(docs, labels, F.col("toxic"), most, allowed, least), "toxicity-sample")

    def present(batches):
        reader = Reader(letters)
        for pdf in batches:
            for at in range(0, len(pdf), 64):
                part = pdf.iloc[at : at + 64]
                found = [{f for w in reader.words(t) for f in features(w)} for t in part["text"]]
                toxic = (part["y"].to_numpy() > 0).astype(np.int64)
                yield pd.DataFrame({
                    "f": [f for fs in found for f in fs], "y": np.repeat(toxic, [len(f) for f in found]),
                })
                yield pd.DataFrame({"f": np.where(toxic > 0, TOXIC, OTHERS), "y": 0})

    counted = sample.mapInPandas(present, "f string, y long").groupBy("f").agg(
        F.sum("y").alias("n1"), F.count("*").alias("n")
    )
    rows = counted.where((F.col("n1") >= MIN_TOXIC) | F.col("f").isin(TOXIC, OTHERS)).toPandas()
    sizes = dict(zip(rows["f"], rows["n"]))
    all0, all1 = float(sizes.get(OTHERS, 0)), float(sizes.get(TOXIC, 0))
    model = ToxicityModel(letters)
    if not all0 or not all1:
        return model
    rows = rows[~rows["f"].isin([TOXIC, OTHERS])]
    n1, n0 = rows["n1"].to_numpy(float), (rows["n"] - rows["n1"]).to_numpy(float)
    odds = np.log((n1 + 0.5) / (all1 + 1)) - np.log((n0 + 0.5) / (all0 + 1))
    strong = (_evidence(n1, n0, all1, all0) >= MIN_EVIDENCE) & (odds >= 1.0)
    model.weights = dict(zip(rows["f"].to_numpy()[strong].tolist(), odds[strong].tolist()))

    def pooled(batches):
        reader = Reader(letters)
        for pdf in batches:
            found = [model.pooled(reader, t) for t in pdf["text"]]
            yield pd.DataFrame({"a": [f[0] for f in found], "b": [f[1] for f in found], "y": (pdf["y"] > 0).astype("double")})

    got = sample.mapInPandas(pooled, "a double, b double, y double").toPandas().sort_values(["a", "b", "y"])
    x = np.column_stack([np.ones(len(got)), got["a"], got["b"]])
    model.logistic = _newton(x, got["y"].to_numpy())
    return model


def _newton(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton's method."""
    theta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -50, 50)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(theta)), x.T @ (y - p) - ridge * theta
        )
        theta += step
        if np.abs(step).max() < 1e-9:
            break
    return theta


def score(docs: DataFrame, model: ToxicityModel, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted. Only the text is an input of a score."""

    def rows(batches):
        reader = Reader(model.letters)
        for pdf in batches:
            found = np.array([model.score(model.pooled(reader, t)) for t in pdf["text"]], float)
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].array, "held_out": pdf["held_out"].array, "score": found,
                "predicted": (found >= 0.5).astype("int32"),
            })

    return docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string")).mapInPandas(
        rows, "doc_id long, held_out boolean, score double, predicted int"
    )
