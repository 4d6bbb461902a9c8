"""Document fingerprints from prefix polynomial hashes.

``Prefixes`` holds, for two moduli below 2^31, the sums of code point times
power of the base up to each place of a text. The hash of any span is the
difference of two sums, shifted to a common power, so spans of any texts are
compared in one step, and the longest common extension of two places, forward
or backward, is found by binary search. ``shared_spans`` locates the passages
that two texts share with these two operations.

A fingerprint is a sample of these arrays, so that texts need not be kept: the
length, the hash of the whole text, the hashes of the beginnings and of the
ends of the text at multiples of a step (the least power of two that gives at
most ``ANCHORS`` of them), and a sketch of the spans of ``SPAN`` code points
(least hash in each of ``BINS`` classes). ``likeness`` finds the longest common
beginning and the longest common end of two fingerprints by binary search over
the places that both have, and the share of classes with equal least hashes;
it is the greater of the two shares. It is 1 only if the whole hashes and
lengths agree, which texts do that are equal (others with a probability of
about 2^-62). Common beginnings and ends are rounded down to a step, a sixteenth of
the longer text at most (32 code points and more; exact for shorter ones).

Texts are hashed in blocks of ``BLOCK`` code points, so that a very long text
needs no more memory than its characters.

NULL and empty texts have length 0 and one fingerprint, equal to each other's
(likeness 1) and unlike all others (0). Repeated rows have equal fingerprints;
only doc_id and text are read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.session import stored_copy

MODULI = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003_769, 911_382_323)
ANCHORS = 32
SPAN = 24
BINS = 32
BLOCK = 1 << 17
#: What mixes a span's hash so that its high bits class it.
MIX = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


class Powers:
    """Powers of a base and of its inverse, made as far as they are asked for, up to one block."""

    def __init__(self, modulus: int, base: int):
        self.modulus, self.base, self.inverse = modulus, base, pow(base, -1, modulus)
        self.up = self._table(base)
        self.down = self._table(self.inverse)

    def _table(self, base: int) -> np.ndarray:
        out, step = np.ones(1, np.int64), base
        while len(out) <= BLOCK:
            out = np.concatenate([out, out * step % self.modulus])
            step = step * step % self.modulus
        return out[: BLOCK + 1]

    def inverses(self, exponents: np.ndarray) -> np.ndarray:
        """The inverse powers of many exponents."""
        if len(exponents) and exponents.max() > BLOCK:
            return np.array([self.at(-int(k)) for k in exponents], np.int64)
        return self.down[exponents]

    def at(self, exponent: int) -> int:
        return pow(self.base if exponent >= 0 else self.inverse, abs(exponent), self.modulus)


POWERS = [Powers(m, b) for m, b in zip(MODULI, BASES)]


def _sums(codes: np.ndarray, powers: Powers, before: int = 0, at: int = 0) -> np.ndarray:
    """Sums of (code + 1) * base^place after each code of one block, modulo the
    modulus. ``before``: the sum up to the block, ``at``: its first place."""
    terms = (codes.astype(np.int64) + 1) * powers.up[: len(codes)] % powers.modulus
    terms = terms.cumsum() % powers.modulus  # 2^17 terms below 2^31
    return (terms * powers.at(at) + before) % powers.modulus if at else terms


class Prefixes:
    """Prefix arrays of one text: spans are compared in constant time."""

    def __init__(self, text: str | None):
        codes = code_points(text)
        self.length = len(codes)
        self.sums = []
        for p in POWERS:
            sums = np.zeros(len(codes) + 1, np.int64)
            for at in range(0, len(codes), BLOCK):
                part = codes[at : at + BLOCK]
                sums[at + 1 : at + 1 + len(part)] = _sums(part, p, int(sums[at]), at)
            self.sums.append(sums)

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Hash of the code points from ``start`` up to ``end``, wherever they stand."""
        return tuple(
            (int(s[end]) - int(s[start])) * p.at(-start) % p.modulus for s, p in zip(self.sums, POWERS)
        )

    def same(self, start: int, other: Prefixes, at: int, length: int) -> bool:
        return self.span(start, start + length) == other.span(at, at + length)

    def extension(self, start: int, other: Prefixes, at: int) -> int:
        """Length of the longest common extension forward from two places."""
        return _longest(min(self.length - start, other.length - at), lambda k: self.same(start, other, at, k))

    def extension_back(self, end: int, other: Prefixes, at: int) -> int:
        """Length of the longest common extension backward from two places."""
        return _longest(min(end, at), lambda k: self.same(end - k, other, at - k, k))

    def windows(self, width: int) -> np.ndarray:
        """One number per span of ``width``: equal spans have equal numbers."""
        n = max(0, self.length - width + 1)
        out = np.zeros(n, np.int64)
        for s, p in zip(self.sums, POWERS):
            got = np.empty(n, np.int64)
            for at in range(0, n, BLOCK):
                end = min(n, at + BLOCK)
                part = (s[at + width : end + width] - s[at:end]) % p.modulus
                got[at:end] = part * p.down[: end - at] % p.modulus * p.at(-at) % p.modulus
            out = out << 31 | got
        return out


def _longest(most: int, agree) -> int:
    """The largest k up to ``most`` for which ``agree(k)`` holds, if it holds for all smaller."""
    low, high = 0, most
    while low < high:
        k = (low + high + 1) // 2
        low, high = (k, high) if agree(k) else (low, k - 1)
    return low


def shared_spans(a: Prefixes, b: Prefixes, width: int) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of passages of at least 2 * ``width``
    - 1 code points that stand in both texts, each as long as possible.

    Every such passage covers a whole span of a that starts at a multiple of
    ``width``; these spans are looked up among all spans of b, and each place
    found is extended both ways. A span that stands more than once in b gives
    each of its passages."""
    at_b = b.windows(width)
    order = np.argsort(at_b, kind="stable")
    starts = np.arange(0, max(0, a.length - width + 1), width)
    keys = a.windows(width)[starts] if len(starts) else np.zeros(0, np.int64)
    low, high = np.searchsorted(at_b[order], keys, "left"), np.searchsorted(at_b[order], keys, "right")
    reached: dict[int, int] = {}  # by offset between the texts: how far in a the last passage went
    out = []
    for start, l, h in zip(starts.tolist(), low.tolist(), high.tolist()):
        for at in order[l:h].tolist():
            if reached.get(at - start, -1) >= start + width:
                continue
            back, ahead = a.extension_back(start, b, at), a.extension(start, b, at)
            reached[at - start] = start + ahead
            if back + ahead >= 2 * width - 1:
                out.append((start - back, at - back, back + ahead))
    return out


def _step(length: int) -> int:
    step = 1
    while length // step > ANCHORS:
        step *= 2
    return step


def fingerprint(codes: np.ndarray) -> str:
    """Length, whole, beginnings, ends, sketch, in hexadecimal: 16 digits, then 8
    a number, and 4 a number in the sketch. The length tells how many there are."""
    n, step = len(codes), _step(len(codes))
    places = np.arange(step, n + 1, step)
    anchors = np.zeros((2, len(places)), np.int64)  # sums up to each place, and up to its mirror image
    whole = [0, 0]
    least = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    tail = np.zeros(0, np.int64)
    p = POWERS[0]
    mirror = n - places[::-1]
    for at in range(0, n, BLOCK):
        part = codes[at : at + BLOCK]
        sums = _sums(part, p, whole[0], at)
        for row, where in ((0, places), (1, mirror)):
            i, j = np.searchsorted(where, [at + 1, at + len(part) + 1])
            anchors[row, i:j] = sums[where[i:j] - at - 1]
        # spans that end in this block, from SPAN places before it on
        joined = np.concatenate([tail, [whole[0]], sums])
        if len(joined) > SPAN:
            first = at - len(tail)
            spans = (joined[SPAN:] - joined[:-SPAN]) % p.modulus
            cut = min(len(spans), BLOCK)
            spans[:cut] = spans[:cut] * p.down[:cut] % p.modulus
            spans[cut:] = spans[cut:] * p.down[: len(spans) - cut] % p.modulus * p.down[BLOCK] % p.modulus
            _classes(spans * p.at(-first) % p.modulus, least)
        tail = joined[-SPAN:-1]
        whole = [int(sums[-1]), int(_sums(part, POWERS[1], whole[1], at)[-1])]
    if 0 < n < SPAN:
        _classes(np.array([whole[0]]), least)
    ends = (whole[0] - anchors[1][::-1]) % p.modulus * p.inverses(n - places) % p.modulus
    found = least < np.iinfo(np.uint64).max
    sketch = np.where(found, np.maximum(least >> np.uint64(27) & np.uint64(0xFFFF), 1), 0)  # 0: no span of this class
    return _hex([n], 8) + _hex(whole, 4) + _hex(anchors[0], 4) + _hex(ends, 4) + _hex(sketch, 2)


def _hex(numbers, width: int) -> str:
    return np.asarray(numbers).astype(f">u{width}").tobytes().hex()


def _classes(spans: np.ndarray, least: np.ndarray) -> None:
    """Lower ``least`` to the least mixed hash of each class."""
    mixed = spans.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(15))) * MIX
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
    np.minimum.at(least, (mixed >> np.uint64(59)).astype(np.int64), mixed)


def _parts(print_: str) -> tuple[int, str, str, str, str]:
    n = int(print_[:16], 16)
    wide = 8 * (n // _step(n))
    return n, print_[16:32], print_[32 : 32 + wide], print_[32 + wide : 32 + 2 * wide], print_[32 + 2 * wide :]


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, from 0 to 1."""
    (m, wa, pa, ea, sa), (n, wb, pb, eb, sb) = _parts(a), _parts(b)
    if (m, wa) == (n, wb):
        return 1.0
    if not m or not n:
        return 0.0
    step = max(_step(m), _step(n))
    i, j = step // _step(m), step // _step(n)  # every i-th anchor of a stands where every j-th of b does

    def common(x: str, y: str) -> int:
        def agree(k: int) -> bool:
            return x[8 * (k * i - 1) : 8 * k * i] == y[8 * (k * j - 1) : 8 * k * j]

        return step * _longest(min(m, n) // step, agree)

    ends = min(common(pa, pb) + common(ea, eb), min(m, n)) / max(m, n)
    both = [(sa[k : k + 4], sb[k : k + 4]) for k in range(0, 4 * BINS, 4)]
    used = [(x, y) for x, y in both if x != "0000" or y != "0000"]
    spans = sum(x == y for x, y in used) / max(1, len(used))
    return min(max(ends, spans), 1 - 1e-9)


def prints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint of every row."""

    def rows(batches):
        for pdf in batches:
            codes = [code_points(t) for t in pdf["text"]]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].array, "n_chars": np.array([len(c) for c in codes], np.int64),
                "fingerprint": [fingerprint(c) for c in codes],
            })

    return docs.select("doc_id", F.col("text").cast("string")).mapInPandas(
        rows, "doc_id long, n_chars long, fingerprint string"
    )


def passages(pairs: DataFrame, width: int = 100) -> DataFrame:
    """left_id, right_id, left_start, right_start, length: passages shared by
    the texts of each row (left_id, left, right_id, right), see ``shared_spans``."""

    def rows(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                found = shared_spans(Prefixes(r.left), Prefixes(r.right), width)
                if found:
                    yield pd.DataFrame(found, columns=["left_start", "right_start", "length"]).assign(
                        left_id=r.left_id, right_id=r.right_id
                    )[["left_id", "right_id", "left_start", "right_start", "length"]]

    return pairs.select("left_id", "left", "right_id", "right").mapInPandas(
        rows, "left_id long, right_id long, left_start long, right_start long, length long"
    )


def edited(text: str, after: str) -> str:
    """The last third of ``text`` (rounded down) replaced by the beginning of ``after``."""
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


_PAIR = "kind string, part int, doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, text string"


def _chain(batches):
    """Rows of one sorted partition, each compared with the next; the first and
    the last are also passed on with their texts."""
    part, held = TaskContext.get().partitionId(), None
    blank = {"edited_sha256": None, "edited_fingerprint": None, "near_edited": None, "near_next": None}

    def end(kind, row):
        return {"kind": kind, "part": part, "doc_id": row[0], "n_chars": len(row[1]), "fingerprint": row[2], "text": row[1]} | blank

    for pdf in batches:
        out = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            text = text or ""
            row = (None if pd.isna(doc_id) else int(doc_id), text, fingerprint(code_points(text)))
            if held is None:
                out.append(end("first", row))
            else:
                out.append({"kind": "row", "part": part} | _compared(held, row) | {"text": None})
            held = row
        yield _frame(out)
    if held is not None:
        yield _frame([end("last", held)])


def _compared(row, after) -> dict:
    doc_id, text, own = row
    changed = edited(text, after[1])
    print_ = own if changed == text else fingerprint(code_points(changed))
    return {
        "doc_id": doc_id, "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": own, "edited_fingerprint": print_,
        "near_edited": likeness(own, print_), "near_next": likeness(own, after[2]),
    }


def _frame(rows: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in _PAIR.split(", ")])
    for name in _DIGESTS:
        out[name] = [None if v is None else bytes.fromhex(v) for v in out[name]]
    return out.astype({"doc_id": "Int64", "part": "int32", "n_chars": "int64", "near_edited": float, "near_next": float})


_DIGESTS = ["edited_sha256", "fingerprint", "edited_fingerprint"]  # half as long in the table between
_RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def edit_prints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that of the next smaller doc_id; rows without doc_id
    come last, rows of equal doc_id in the order of a hash of their texts (of
    equal rows any order gives the same), and the first row follows the last. A
    single row follows itself.

    Texts are sorted once, by ranges of ids; each row meets the next in its
    partition, and of each partition only the first and the last row go on to be
    matched across its border. One number per task reaches the driver.
    """
    digest = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    # the number of the row parts rows that are repeated whole; equal keys would stay in one task
    order = [F.col("doc_id").desc_nulls_last(), F.col("digest"), F.col("place")]
    rows = docs.select("doc_id", F.col("text").cast("string"), digest.alias("digest"), F.monotonically_increasing_id().alias("place"))
    chained = stored_copy(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInPandas(_chain, _PAIR), "fingerprints"
    )
    spark = docs.sparkSession
    parts = sorted(r["part"] for r in chained.where("kind = 'first'").select("part").collect())  # one number per task
    next_part = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    def said(name):
        return F.lower(F.hex(name))

    last = chained.where("kind = 'last'").join(F.broadcast(next_part), "part")
    first = chained.where("kind = 'first'").select(
        F.col("part").alias("next"), F.col("text").alias("after"), said("fingerprint").alias("after_print")
    )

    def compare(batches):
        for pdf in batches:
            out = [
                _compared((None if pd.isna(r.doc_id) else int(r.doc_id), r.text, r.fingerprint), (None, r.after, r.after_print))
                for r in pdf.itertuples()
            ]
            yield pd.DataFrame(out, columns=_RESULT).astype({"doc_id": "Int64"})

    borders = last.join(first.hint("merge"), "next").select("doc_id", "text", said("fingerprint").alias("fingerprint"), "after", "after_print").mapInPandas(
        compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    rows = chained.where("kind = 'row'").select(*[said(c).alias(c) if c in _DIGESTS else F.col(c) for c in _RESULT])
    return rows.unionByName(borders)
