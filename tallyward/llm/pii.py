"""Personal data: base patterns, and more spans by weak supervision.

Base spans come from four fixed patterns and always stay. Looser patterns
propose further spans: local phone numbers, spelled-out mail addresses, card
numbers that fail the checksum, and secrets. Five labelers vote on every
proposed and every base span (yes, no, or no vote): the strict pattern, the
validity of the value, gazetteers (domains, calling codes, issuers, key
prefixes), words before the span, and the characters at its edges.

Votes of all documents are counted per kind and vote pattern. On this small
table, expectation-maximisation estimates how reliable each labeler is and
how probable each pattern is to be personal data; a logistic classifier over
votes, digits and length is then trained on these probabilities. A proposed
span is added if the classifier gives it at least one half and it overlaps no
base span and no added span that starts before it.

Two passes over the texts: the first counts, the second classifies. NULL and
empty texts have no spans. Repeated rows give repeated result rows, and count
again. Of proposals that start at one place the one that ends first is added.
Offsets count code points, ends are exclusive. All scans are linear in the
text, so very long texts are read whole. Only doc_id and text are read, masking
keeps all other columns; an empty table gives no rows and accepts no proposals.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
LABELERS = 5
SIZES = 4  # classes of digits, and of length
CONTEXT = 40  # characters before a span that the context labeler reads

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_SPELLED = re.compile(r"[ ]?(?:\[at\]|\(at\))[ ]?([A-Za-z0-9-]++(?:(?:\.|[ ]?(?:\[dot\]|\(dot\))[ ]?)[A-Za-z0-9-]++)+)")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{4}(?![0-9])")
_SECRET = re.compile(
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
    r"|(?:password|passwd|token|secret|api_key)[ ]?[=:][ ]?\"?[^\s\"]{8,}+)"
)

# Gazetteers and context words.
_TOP_LEVEL = frozenset("com org net edu gov io co uk de fr es eu us ca au".split())
_CALLING = ("+1", "+33", "+34", "+44", "+49", "+39", "+31", "+61", "+81", "+86")
_ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
_SECRETS = ("AKIA", "password=", "token =", "secret=", "api_key=")
_BEFORE = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "call", "tel", "fax", "mobile"),
    "secret": ("key", "secret", "login", "credential"),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Every @ with a local part before it and a domain after it, from the left."""
    spans, low = [], 0
    at = text.find("@")
    while at >= 0:
        before = text[low:at]
        start = low + len(before.rstrip(_LOCAL))
        low = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            spans.append((start, m.end()))
            low = m.end()
        at = text.find("@", low)
    return spans


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the four base patterns, by kind and start."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [
            ("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups())
        ]
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start():
            d = _digits(m.group())
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def proposed_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the looser patterns."""
    if not text:
        return []
    out = []
    if "(at)" in text or "[at]" in text:
        low = 0
        for m in _SPELLED.finditer(text):
            start = low + len(text[low : m.start()].rstrip(_LOCAL))
            if start < m.start():
                out.append(("email", start, m.end()))
            low = m.end()
    if _DIGIT.search(text):
        for m in _CARD.finditer(text):
            if 13 <= m.end() - m.start() and 13 <= len(d := _digits(m.group())) <= 19 and not luhn(d):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
    if "AKIA" in text or "=" in text or ":" in text:
        out += [("secret", *m.span()) for m in _SECRET.finditer(text)]
    return out


def votes(text: str, kind: str, start: int, end: int, strict: bool) -> tuple[int, ...]:
    """What each labeler says of a span: 1 yes, 2 no, 0 no vote; then the
    classes of its digits and length."""
    span = text[start:end]
    digits = _digits(span)
    if kind == "card":
        valid = luhn(digits)
        known = digits.startswith(_ISSUERS)
    elif kind == "phone":
        valid = 9 <= len(digits) <= 15
        known = span.startswith(_CALLING)
    elif kind == "email":
        valid = len(span) <= 254
        known = re.split(r"[^A-Za-z]", span)[-1].lower() in _TOP_LEVEL
    elif kind == "ip":
        valid = span.split(".")[0] not in ("0", "255")
        known = not span.startswith(("127.", "10.", "192.168."))
    else:
        valid = any(c.isdigit() for c in span)
        known = span.startswith(_SECRETS)
    before = text[max(0, start - CONTEXT) : start].lower()
    glued = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    return (
        1 if strict else 0,
        1 if valid else 2,
        1 if known else 0,
        1 if any(w in before for w in _BEFORE[kind]) else 0,
        2 if glued else 1,
        min(SIZES - 1, len(digits) // 6),
        min(SIZES - 1, len(span) // 12),
    )


def _covered(spans: list[tuple[str, int, int]]) -> list[list[int]]:
    """The stretches that spans cover, apart and in order."""
    out: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def spans_with_votes(text: str | None) -> list[tuple[str, int, int, bool, tuple[int, ...]]]:
    """Base spans, and the proposed spans that overlap none of them, with their votes."""
    base = base_spans(text)
    taken, more, i = _covered(base), [], 0
    for k, a, b in sorted(proposed_spans(text), key=lambda s: s[1:]):
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if i == len(taken) or taken[i][0] >= b:
            more.append((k, a, b))
    return [(k, a, b, True, votes(text, k, a, b, True)) for k, a, b in base] + [
        (k, a, b, False, votes(text, k, a, b, False)) for k, a, b in more
    ]


def pattern(kind: str, said: tuple[int, ...]) -> int:
    """A kind and its votes as one number; there are at most 5 * 3^5 * 16 of them."""
    code = KINDS.index(kind)
    for v in said[:LABELERS]:
        code = code * 3 + v
    return (code * SIZES + said[LABELERS]) * SIZES + said[LABELERS + 1]


def _read(code: int) -> tuple[int, list[int], int, int]:
    code, length = divmod(code, SIZES)
    code, digits = divmod(code, SIZES)
    said = []
    for _ in range(LABELERS):
        code, v = divmod(code, 3)
        said.append(v)
    return code, said[::-1], digits, length


def reliabilities(said: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for one kind. ``said`` patterns x labelers,
    ``n`` how often each pattern occurs. Returns the probability that each
    pattern is personal data, and P(vote | class) as labelers x 2 x 3."""
    p = 1 / (1 + np.exp(-((said == 1).sum(1) - (said == 2).sum(1) - 0.5)))
    told = np.zeros((said.shape[1], 2, 3))
    for _ in range(rounds):
        prior = np.clip(((n * p).sum() + 1) / (n.sum() + 2), 1e-6, 1 - 1e-6)
        for k in range(said.shape[1]):
            for v in range(3):
                hit = said[:, k] == v
                told[k, 1, v] = (n * p * hit).sum() + 1
                told[k, 0, v] = (n * (1 - p) * hit).sum() + 1
        told /= told.sum(axis=2, keepdims=True)
        log1 = np.log(prior) + sum(np.log(told[k, 1, said[:, k]]) for k in range(said.shape[1]))
        log0 = np.log(1 - prior) + sum(np.log(told[k, 0, said[:, k]]) for k in range(said.shape[1]))
        p = 1 / (1 + np.exp(np.clip(log0 - log1, -50, 50)))
    return p, told


def _features(kind: int, said: list[int], digits: int, length: int) -> np.ndarray:
    x = np.zeros(len(KINDS) * (1 + 2 * LABELERS + 2 * SIZES))
    at = kind * (1 + 2 * LABELERS + 2 * SIZES)
    x[at] = 1
    for k, v in enumerate(said):
        if v:
            x[at + 1 + 2 * k + (v - 1)] = 1
    x[at + 1 + 2 * LABELERS + digits] = 1
    x[at + 1 + 2 * LABELERS + SIZES + length] = 1
    return x


class SpanClassifier:
    """Logistic regression over vote patterns; ``accepted`` are the patterns at one half or more."""

    def __init__(self, counts: dict[int, int], steps: int = 300):
        codes = sorted(counts)
        read = [_read(c) for c in codes]
        self.accepted: frozenset[int] = frozenset()
        self.reliability: dict[str, np.ndarray] = {}
        if not codes:
            return
        soft, n = np.zeros(len(codes)), np.array([counts[c] for c in codes], float)
        for kind in range(len(KINDS)):
            rows = [i for i, r in enumerate(read) if r[0] == kind]
            if rows:
                p, told = reliabilities(np.array([read[i][1] for i in rows]), n[rows])
                soft[rows] = p
                self.reliability[KINDS[kind]] = told
        x = np.array([_features(*r) for r in read])
        weight, theta, step = np.log1p(n), np.zeros(x.shape[1]), 4.0
        for _ in range(steps):
            p = 1 / (1 + np.exp(-x @ theta))
            theta += step * (x.T @ (weight * (soft - p)) / weight.sum() - 1e-4 * theta)
        p = 1 / (1 + np.exp(-x @ theta))
        self.accepted = frozenset(c for c, v in zip(codes, p) if v >= 0.5)

    def spans(self, text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Base spans and all spans, each by kind and start."""
        found = spans_with_votes(text)
        base = [(k, a, b) for k, a, b, own, _ in found if own]
        more = sorted(
            (a, b, k) for k, a, b, own, said in found if not own and pattern(k, said) in self.accepted
        )
        added, end = [], -1
        for a, b, k in more:
            if a >= end:
                added.append((k, a, b))
                end = b
        return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def train(docs: DataFrame) -> SpanClassifier:
    """Count vote patterns over all documents and fit. The driver gets one row
    per pattern, whatever the number of documents."""

    def count(batches):
        n: Counter[int] = Counter()
        for pdf in batches:
            for t in pdf["text"]:
                n.update(pattern(k, said) for k, _, _, _, said in spans_with_votes(t))
        yield pd.DataFrame({"code": list(n.keys()), "n": list(n.values())}, dtype="int64")

    counted = docs.select(F.col("text").cast("string")).mapInPandas(count, "code long, n long")
    rows = counted.groupBy("code").agg(F.sum("n").alias("n")).collect()
    return SpanClassifier({r["code"]: r["n"] for r in rows})


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, model: SpanClassifier) -> DataFrame:
    """doc_id, base counts per kind, base_sha256, spans."""

    def rows(batches):
        for pdf in batches:
            out = []
            for t in pdf["text"]:
                base, every = model.spans(t)
                n = Counter(k for k, _, _ in base)
                out.append((*(n[k] for k in BASE_KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            got = pd.DataFrame(out, columns=[*(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])
            got.insert(0, "doc_id", pdf["doc_id"].array)
            yield got.astype({f"n_{k}": "int64" for k in BASE_KINDS})

    return docs.select("doc_id", F.col("text").cast("string")).mapInPandas(
        rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )


def masked(text: str | None, model: SpanClassifier) -> str | None:
    """The text with every span replaced by its kind in angle brackets; of
    overlapping spans the joint stretch is replaced once, by the first kind."""
    if not text:
        return text
    _, every = model.spans(text)
    if not every:
        return text
    out, at = [], 0
    for kind, a, b in sorted(every, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, model: SpanClassifier) -> DataFrame:
    """``docs`` with personal data masked in ``text``; all columns and rows stay."""

    @F.pandas_udf(StringType())
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t, model) for t in texts], dtype=object)

    text = clean(F.col("text").cast("string"))
    return docs.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
