"""Byte-pair encoding by backtracking over longest token matches, and decoding by offsets.

An Aho-Corasick automaton finds, in one pass over a piece of text, the longest
vocabulary token that starts at each byte. The encoder walks the piece with
these tokens. It may put token b after token a only if the merge rules would
leave a boundary between them; this is looked up in a pair-compatibility
table. If not, it takes the next shorter token that is a prefix, and if none is
left it steps back and marks the position as dead. Each position is left at
most once for each token length, so the work is linear in the piece, and the
result is the one that the merges give.

Decoding gathers token bytes from one block of bytes by an offset table.

NULL texts count as empty: no tokens. Special tokens of the file that stand in
a text are encoded as their own ids. Repeated rows give repeated result rows.
Very long texts and pieces are encoded whole; only doc_id and text are read; an
empty table gives no rows. Equal texts have equal tokens, there are no ties.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

PIECES = 150_000  # pieces in each of two generations whose tokens a worker remembers
SHORT = 48  # only pieces of at most so many characters are remembered
PAIRS = 150_000  # pairs in each of two generations whose compatibility a worker remembers


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: visible
    Latin-1 characters stand for themselves, the rest follow from U+0100."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


class Encoder:
    """A byte-level vocabulary: ``rank`` counts single bytes first, then merges in their order."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = {letter: b for b, letter in enumerate(byte_letters())}
        vocab = spec["model"]["vocab"]
        made = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        names = [n for n in vocab if len(n) == 1] + [a + b for a, b in made]
        rank_of = {name: r for r, name in enumerate(names)}
        self.token = [bytes(letters[c] for c in name) for name in names]
        self.id = [vocab[name] for name in names]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        single = len(names) - len(made)
        self.parts = [(r, r) for r in range(single)] + [(rank_of[a], rank_of[b]) for a, b in made]
        self.merged = {pair: single + k for k, pair in enumerate(self.parts[single:])}
        by_bytes = {t: r for r, t in enumerate(self.token)}
        self.shorter = [
            next((by_bytes[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in by_bytes), -1) for t in self.token
        ]
        self.automaton = ahocorasick.Automaton()
        self.byte_rank = [by_bytes[bytes([b])] for b in range(256)]  # the shortest match at every place is its byte
        for r, t in enumerate(self.token):
            if len(t) > 1:
                self.automaton.add_word(t.decode("latin-1"), (r, len(t) - 1))
        self.automaton.make_automaton()
        self.pattern = regex.compile(pattern)
        self.stops = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        size = max([*self.id, *self.special.values()]) + 1
        by_id = [b""] * size
        for r, i in enumerate(self.id):
            by_id[i] = self.token[r]
        for content, i in self.special.items():
            by_id[i] = content.encode()
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.splitter = ByteLevel(add_prefix_space=False)
        self.sizes = [len(t) for t in self.token]
        self.names = [str(i) for i in self.id]
        self.old: set[str] = set()
        # the younger generation, and the one before it: what is asked for again moves up
        self.fits: dict[int, bool] = {}
        self.fitted: dict[int, bool] = {}
        self.known: dict[str, str] = {}
        self.knew: dict[str, str] = {}

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether the merges leave a boundary between two adjacent tokens.

        Merges are undone in reverse order, always of the token made later,
        down to the bytes at the boundary. If at some time the two neighbours
        have a merge of their own that comes before the one just undone, it
        would have been applied."""
        before = len(self.token)
        while True:
            rank = self.merged.get((left, right))
            if rank is not None and rank < before:
                return False
            inner, outer = self.parts[left][1], self.parts[right][0]
            if inner == left and outer == right:
                return True
            if outer == right or (inner != left and left > right):
                before, left = left, inner
            else:
                before, right = right + 1, outer

    def compatible(self, left: int, right: int) -> bool:
        """``_stay_apart``, looked up in the table of pairs."""
        pair = left * len(self.token) + right
        got = self.fits.get(pair)
        return self._fit(pair, left, right) if got is None else got

    def _fit(self, pair: int, left: int, right: int) -> bool:
        got = self.fitted.get(pair)
        if got is None:
            got = self._stay_apart(left, right)
        if len(self.fits) >= PAIRS:
            self.fits, self.fitted = {}, self.fits
        self.fits[pair] = got
        return got

    def ranks(self, raw: bytes) -> list[int]:
        """Tokens of one piece."""
        n = len(raw)
        longest = list(map(self.byte_rank.__getitem__, raw))
        for end, (rank, back) in self.automaton.iter(raw.decode("latin-1")):
            longest[end - back] = rank  # later matches that start here are longer
        sizes, shorter, many, at = self.sizes, self.shorter, len(self.token), 0
        alive, out = None, []  # positions from which no way was found yet; made at the first step back
        pick = longest[0] if n else -1
        while at < n:
            end = at + sizes[pick]
            fits = alive is None or alive[end]
            if fits and out:
                pair = out[-1] * many + pick
                fits = self.fits.get(pair)
                if fits is None:
                    fits = self._fit(pair, out[-1], pick)
            if fits:
                out.append(pick)
                at = end
                pick = longest[at] if at < n else -1
                continue
            pick = shorter[pick]
            while pick < 0:
                if alive is None:
                    alive = bytearray(b"\1") * (n + 1)
                alive[at] = 0
                pick = out.pop()
                at -= sizes[pick]
                pick = shorter[pick]
        return out

    def _split(self, text: str) -> list[str]:
        """Pieces that merges never cross. The pattern knows more recent letters
        and digits than the tokenizers library; a text with characters that are
        new to Python too is split by the library."""
        if not text.isascii():
            for c in set(text):
                if c not in self.old and unicodedata.category(c) == "Cn":
                    return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
                self.old.add(c)
        return self.pattern.findall(text)

    def _piece(self, piece: str) -> str:
        """Ids of one piece, joined by commas; remembered if it is short."""
        got = self.knew.get(piece)
        if got is None:
            names = self.names
            got = ",".join([names[r] for r in self.ranks(piece.encode("utf-8", "surrogatepass"))])
        if len(piece) <= SHORT:
            if len(self.known) >= PIECES:
                self.known, self.knew = {}, self.known
            self.known[piece] = got
        return got

    def _said(self, text: str | None) -> str:
        """Ids of a whole text, joined by commas."""
        said, at = [], 0
        text = text or ""
        cuts = [(m.start(), m.end()) for m in self.stops.finditer(text)] if self.stops else []
        for start, end in [*cuts, (len(text), len(text))]:
            pieces = self._split(text[at:start] if cuts else text)
            got = list(map(self.known.get, pieces))
            if None in got:
                got = [self._piece(p) if g is None else g for p, g in zip(pieces, got)]
            said += got
            if end > start:
                said.append(str(self.special[text[start:end]]))
            at = end
        return ",".join(said)

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text."""
        return self._ids(self._said(text))

    def _ids(self, said: str) -> np.ndarray:
        return np.fromstring(said, np.int32, sep=",") if said else np.zeros(0, np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids; bytes that are no UTF-8 become U+FFFD."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return ""
        where = np.repeat(self.offsets[ids] - ends + sizes, sizes) + np.arange(ends[-1])
        return self.bytes[where].tobytes().decode("utf-8", "replace")

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of tokens, hash of the ids, hash of the decoded text."""
        said = self._said(text)
        ids = self._ids(said)
        back = self.decode(ids).encode("utf-8")
        return len(ids), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(back).hexdigest()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)


def tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the token ids of every text."""

    def rows(batches):
        own = encoder(path)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [own.encode(t) for t in pdf["text"]]})

    return docs.select("doc_id", F.col("text").cast("string")).mapInPandas(rows, "doc_id long, ids array<int>")


def texts(ids: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of every row of token ids."""

    def rows(batches):
        own = encoder(path)
        for pdf in batches:
            found = [own.decode(np.asarray([] if i is None else i, np.int64)) for i in pdf["ids"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": found})

    return ids.select("doc_id", "ids").mapInPandas(rows, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded and decoded again."""

    def rows(batches):
        own = encoder(path)
        for pdf in batches:
            found = [own.digests(t) for t in pdf["text"]]
            out = pd.DataFrame(found, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", pdf["doc_id"].array)
            yield out.astype({"n_tokens": "int64"})

    return docs.select("doc_id", F.col("text").cast("string")).mapInPandas(
        rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
