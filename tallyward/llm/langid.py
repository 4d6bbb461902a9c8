"""Language of texts by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in windows of ``WINDOW`` bytes,
once forwards and once backwards. Both states at a byte give probabilities of
the languages at this byte; a document's probabilities are the mean over all
its bytes, in all its windows. It is trained in numpy by backpropagation
through time on windows of a bounded sample of documents, so many of each
language, however rare it is, and only the trained weights travel to the
executors.

A document without a letter, or NULL, has the language ``und`` and score 0.
Repeated rows get equal predictions, and rows that repeat a doc_id count once
in training. Of languages that are equally probable the first in order is
given. Very long texts are read whole, in windows; other columns are not read;
an empty table gives no rows. If no document can be learned from,
every prediction is ``und``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm import common

HIDDEN = 8
WINDOW = 64
#: Windows that the network reads at once.
BATCH = 2048
#: The sample: so many documents of smallest hash of each language, and windows of each.
PER_LANGUAGE = 150
PER_DOC = 4
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Direction:
    """One gated recurrent layer: update gate, reset gate, candidate state."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.look = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)  # input weights of each byte, and biases
        self.gates = rng.normal(0, 0.3, (hidden, 2 * hidden)).astype(np.float32)
        self.state = rng.normal(0, 0.3, (hidden, hidden)).astype(np.float32)

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.look, self.gates, self.state]

    def run(self, x: np.ndarray, real: np.ndarray | None, back: bool, keep: bool = False):
        """States (steps x batch x hidden) for bytes (steps x batch). Padding
        stands at the end; read backwards, the state stays zero on it."""
        steps, batch = x.shape
        h = len(self.state)
        out = np.empty((steps, batch, h), np.float32)
        s, cache = np.zeros((batch, h), np.float32), []
        for t in range(steps - 1, -1, -1) if back else range(steps):
            a = self.look[x[t]]
            zr = _sigmoid(a[:, : 2 * h] + s @ self.gates)
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(a[:, 2 * h :] + (r * s) @ self.state)
            new = s + z * (c - s)
            if back and real is not None:
                new *= real[t][:, None]
            if keep:
                cache.append((t, s, z, r, c))
            s = out[t] = new
        return out, cache

    def gradients(self, x: np.ndarray, cache: list, by_out: np.ndarray, real: np.ndarray | None, back: bool):
        """Backpropagation through time: gradients of the weights."""
        h = len(self.state)
        g_look, g_gates, g_state = (np.zeros_like(w) for w in self.weights)
        later = np.zeros(by_out.shape[1:], np.float32)
        for t, s, z, r, c in reversed(cache):
            d = by_out[t] + later
            if back and real is not None:
                d = d * real[t][:, None]
            dz = d * (c - s) * z * (1 - z)
            dc = d * z * (1 - c * c)
            rs = r * s
            d_rs = dc @ self.state.T
            dr = d_rs * s * r * (1 - r)
            both = np.concatenate([dz, dr], axis=1)
            np.add.at(g_look, x[t], np.concatenate([both, dc], axis=1))
            g_gates += s.T @ both
            g_state += rs.T @ dc
            later = d * (1 - z) + d_rs * r + both @ self.gates.T
        return [g_look, g_gates, g_state]


class ByteNetwork:
    """Both directions and the output layer."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.behind = Direction(rng, hidden), Direction(rng, hidden)
        self.out = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def _states(self, x: np.ndarray, real: np.ndarray | None, keep: bool = False):
        a, ca = self.ahead.run(x, real, False, keep)
        b, cb = self.behind.run(x, real, True, keep)
        return a, b, ca, cb

    def positions(self, x: np.ndarray, real: np.ndarray | None = None) -> np.ndarray:
        """Language probabilities at each byte (steps x batch x languages)."""
        a, b, _, _ = self._states(x, real)
        h = a.shape[2]
        logit = a @ self.out[:h] + b @ self.out[h:] + self.bias
        logit -= logit.max(axis=2, keepdims=True)
        np.exp(logit, out=logit)
        logit /= logit.sum(axis=2, keepdims=True)
        return logit

    def step(self, x: np.ndarray, y: np.ndarray, real: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over the real positions, and gradients of all weights."""
        a, b, ca, cb = self._states(x, real, True)
        states = np.concatenate([a, b], axis=2)
        logit = states @ self.out + self.bias
        logit -= logit.max(axis=2, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(axis=2, keepdims=True)
        n = real.sum()
        batch = np.arange(x.shape[1])
        loss = float(-(np.log(p[:, batch, y] + 1e-12) * real).sum() / n)
        d = p.copy()
        d[:, batch, y] -= 1
        d *= (real / n)[..., None]
        g_out = np.einsum("tbh,tbl->hl", states, d)
        ds = d @ self.out.T
        h = a.shape[2]
        return loss, [
            *self.ahead.gradients(x, ca, ds[..., :h], real, False),
            *self.behind.gradients(x, cb, ds[..., h:], real, True),
            g_out,
            d.sum(axis=(0, 1)),
        ]

    def fit(self, x: np.ndarray, y: np.ndarray, real: np.ndarray, epochs: int = 9, batch: int = 64, rate: float = 0.02):
        """Adam over shuffled batches. ``x`` and ``real`` are windows x steps."""
        weights = [*self.ahead.weights, *self.behind.weights, self.out, self.bias]
        m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        rng, k = np.random.default_rng(11), 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                _, grads = self.step(x[some].T, y[some], real[some].T)
                k += 1
                for w, g, mm, vv in zip(weights, grads, m, v):
                    g = np.clip(g, -1, 1)
                    mm += 0.1 * (g - mm)
                    vv += 0.01 * (g * g - vv)
                    w -= rate * (mm / (1 - 0.9**k)) / (np.sqrt(vv / (1 - 0.99**k)) + 1e-7)
        return self

    def document_sums(self, texts: list[bytes]) -> np.ndarray:
        """Sums of the position probabilities of each text (texts x languages)."""
        total = np.zeros((len(texts), len(self.languages)))
        for x, real, owner in _batches(texts):
            p = self.positions(x, real)
            if real is not None:
                p *= real[..., None]
            np.add.at(total, owner, p.sum(axis=0, dtype=np.float64))
        return total

    def label_positions(self, text: str) -> list[str]:
        """The language label of every byte of a text."""
        raw, out = text.encode("utf-8", "surrogatepass"), []
        for x, real, _ in _batches([raw]):
            best = self.positions(x, real).argmax(axis=2)
            out += best.T.ravel().tolist()
        return [self.languages[i] for i in out[: len(raw)]]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its pooled probability for each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        named = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        raw = [texts[i].encode("utf-8", "surrogatepass") for i in named]
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        sums = self.document_sums(raw)
        for i, r, row in zip(named, raw, sums):
            best = int(row.argmax())
            lang[i], score[i] = self.languages[best], float(min(1.0, row[best] / len(r)))
        return lang, score


def _batches(texts: list[bytes]):
    """(bytes as steps x batch, mask or None, owners): all windows of all
    texts, ``BATCH`` at a time."""
    x, owner, short, filled = np.zeros((BATCH, WINDOW), np.uint8), np.zeros(BATCH, np.int64), np.full(BATCH, WINDOW), 0

    def ready():
        real = None
        if (short[:filled] < WINDOW).any():
            real = (np.arange(WINDOW)[:, None] < short[:filled]).astype(np.float32)
        return np.ascontiguousarray(x[:filled].T), real, owner[:filled].copy()

    for k, raw in enumerate(texts):
        data = np.frombuffer(raw, np.uint8)
        at = 0
        while at < len(data):
            room = BATCH - filled
            part = data[at : at + room * WINDOW]
            whole, left = divmod(len(part), WINDOW)
            x[filled : filled + whole] = part[: whole * WINDOW].reshape(whole, WINDOW)
            short[filled : filled + whole] = WINDOW
            if left:
                x[filled + whole, :left], x[filled + whole, left:] = part[whole * WINDOW :], 0
                short[filled + whole] = left
            used = whole + (left > 0)
            owner[filled : filled + used] = k
            filled += used
            at += len(part)
            if filled == BATCH:
                yield ready()
                filled = 0
    if filled:
        yield ready()


def train(
    docs: DataFrame, allowed: Column, epochs: int = 9, per_language: int = PER_LANGUAGE, per_doc: int = PER_DOC
) -> ByteNetwork:
    """Fit on ``per_doc`` windows, spread over the text, of ``per_language``
    documents of each language, of those for which ``allowed`` holds. ``docs``
    has doc_id, text and lang."""
    named = docs.where(allowed).where("lang is not null and doc_id is not null").select("doc_id", "lang").distinct()
    chosen = common.smallest_of_each(named, "lang", per_language).toPandas()  # a bounded number for each language
    chosen = chosen.sort_values(["lang", "doc_id"]).drop_duplicates("doc_id")
    languages = sorted(chosen["lang"].unique())
    if not languages:
        return ByteNetwork([])
    picked = docs.sparkSession.createDataFrame(chosen[["doc_id", "lang"]].astype({"doc_id": "int64"}), "doc_id long, lang string")

    def windows(batches):
        for pdf in batches:
            rows = []
            for i, lang, text in zip(pdf["doc_id"], pdf["lang"], pdf["text"]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                if text and any(map(str.isalpha, text)):
                    starts = sorted({round(k * max(0, len(raw) - WINDOW) / per_doc) for k in range(per_doc)})
                    rows += [(i, lang, s, raw[s : s + WINDOW]) for s in starts]
            yield pd.DataFrame(rows, columns=["doc_id", "lang", "start", "raw"])

    sample = (
        common.texts_of(docs, picked, "lang")
        .mapInPandas(windows, "doc_id long, lang string, start long, raw binary").toPandas()
        .sort_values(["doc_id", "start", "lang"], kind="stable")
    )
    if not len(sample):
        return ByteNetwork([])
    x = np.zeros((len(sample), WINDOW), np.uint8)
    real = np.zeros((len(sample), WINDOW), np.float32)
    for k, raw in enumerate(sample["raw"]):
        x[k, : len(raw)], real[k, : len(raw)] = np.frombuffer(bytes(raw), np.uint8), 1
    y = np.array([languages.index(v) for v in sample["lang"]])
    return ByteNetwork(languages).fit(x, y, real, epochs)


def identify(docs: DataFrame, model: ByteNetwork, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Only the text is an input of a prediction."""

    def rows(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at : at + 512]
                lang, score = model.predict(part["text"].tolist())
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].array, "held_out": part["held_out"].array, "lang_pred": lang, "score": score
                })

    return docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string")).mapInPandas(
        rows, "doc_id long, held_out boolean, lang_pred string, score double"
    )
