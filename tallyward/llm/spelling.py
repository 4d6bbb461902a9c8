"""Spelling variants of the words of a corpus, found by K-d trees over letter counts.

Two words are near if one code point is inserted, deleted or replaced. Such an
edit moves the vector of letter counts by at most two: a replacement keeps the
length and moves one count up and one down; an insertion moves one count up.
So words are searched by pairs of lengths, L with L and L with L + 1. A K-d
tree cuts the vectors of one length, and a search leaves out each box from
which the query is too many counts up or down. What is left is verified letter
by letter.

The tree has two levels. Upper trees, one for each length, are grown on the
driver from ``SAMPLE`` words of smallest hash, with a cell for about ``CELL``
words. They only deal out the work: every word goes to its own cell as a
member, and to each cell that its search reaches as a query. The sizes of all
cells are then counted, and a cell with more members or queries than a task
should hold is dealt out again by hash, so that words with the same letters,
which no cut can part, do not meet in one task. Each group grows its own lower
tree over all its members. Every member of a cell meets every query of it once,
so no pair is lost and none is counted twice. A group sends one row per word
that has near words, with their number and the best of them.

Words and counts are taken from whole texts. NULL and empty texts have no
words, a NULL doc_id counts as empty text, repeated rows count again, and an
empty table gives no words. Ties between near words of equal number go to the
smallest in code-point order. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.session import stored_copy

#: Words whose letters shape the upper trees.
SAMPLE = 32_768
#: Members of a cell, and queries that meet them in one group.
CELL = 8_192
QUERIES = 65_536
#: Characters of the words in one group.
CHARS = 1 << 24
#: Words under one leaf of a lower tree.
LEAF = 8
#: Different words, and their characters, that a task counts before it sends them.
HELD, HELD_CHARS = 200_000, 1 << 23

#: Maximal runs of these letters are words.
LETTERS = "A-Za-zÀ-ÿ"
LOWER = {upper: upper + 32 for upper in range(65, 91)}

#: The place of a letter in a vector of counts.
PLACE = np.zeros(256, np.int64)
PLACE[97:123] = np.arange(26)
PLACE[192:256] = 26 + np.arange(64)
DIM = 90


def slips(doc_id: str, runs: set[str], every: int) -> dict[str, str]:
    """The runs of one document for which ``every`` divides the crc32 of
    ``<doc_id>:<run>``, each without its letter at crc32 % length."""
    start, crc, runs, out = zlib.crc32(f"{doc_id}:".encode()), zlib.crc32, list(runs), {}
    raws = " ".join(runs).encode("utf-8").split(b" ")
    for k in [k for k, raw in enumerate(raws) if crc(raw, start) % every == 0]:
        at = crc(raws[k], start) % len(runs[k])
        out[runs[k]] = runs[k][:at] + runs[k][at + 1 :]
    return out


def word_counts(docs: DataFrame, slip: int = 0, shortest: int = 6, fewest: int = 5) -> DataFrame:
    """(word, n) of all words with at least ``shortest`` letters and ``fewest``
    occurrences. Only A-Z are lower-cased. ``slip``: see ``slips``."""
    runs = re.compile(f"[{LETTERS}]{{{shortest},}}")  # shorter runs make no word

    def frame(held: Counter) -> pd.DataFrame:
        kept = {w: n for w, n in held.items() if len(w) >= shortest}
        return pd.DataFrame({"word": pd.Series(list(kept), dtype=object), "n": pd.Series(list(kept.values()), dtype="int64")})

    def count(batches):
        held, chars = Counter(), 0
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                found = runs.findall(text.translate(LOWER)) if text else None
                if not found:
                    continue
                lost = slips(doc_id or "", set(found), slip) if slip else None
                held.update([lost.get(w, w) for w in found] if lost else found)
                chars += len(text)
                # no more is held than was read, so few words are measured
                if len(held) > HELD or (chars > HELD_CHARS and sum(map(len, held)) > HELD_CHARS):
                    yield frame(held)
                    held, chars = Counter(), 0
                elif chars > HELD_CHARS:
                    chars = 0
        yield frame(held)

    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    counted = rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= fewest)


def codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """One row of counts per row of letters."""
    n = len(letters)
    flat = np.arange(n)[:, None] * DIM + PLACE[letters]
    return np.bincount(flat.ravel(), minlength=n * DIM).reshape(n, DIM).astype(np.int32)


@dataclass
class Tree:
    """Inner nodes: (letter, cut, left, right), where a child k >= 0 is an inner
    node and k < 0 the leaf -1 - k. Counts up to the cut go left."""

    nodes: list[tuple[int, int, int, int]]
    leaves: list[np.ndarray]

    @classmethod
    def grow(cls, x: np.ndarray, most: int) -> Tree:
        """Cut the widest letter at its median until at most ``most`` rows, or
        only equal rows, are left. The rows of a leaf are its members."""
        nodes, leaves = [], []
        stack = [(np.arange(len(x)), -1, 0)]
        while stack:
            at, parent, side = stack.pop()
            own = x[at]
            spread = own.var(axis=0) if len(at) > most else np.zeros(DIM)
            letter = int(spread.argmax())
            if spread[letter] > 0:
                values = own[:, letter]
                cut = min(int(np.median(values)), int(values.max()) - 1)
                low = values <= cut
                child = len(nodes)
                nodes.append((letter, cut, 0, 0))
                stack += [(at[low], child, 2), (at[~low], child, 3)]
            else:
                child = -1 - len(leaves)
                leaves.append(at)
            if parent >= 0:
                nodes[parent] = tuple(child if k == side else v for k, v in enumerate(nodes[parent]))
        return cls(nodes, leaves)

    def reach(self, x: np.ndarray, up: int, down: int):
        """(leaf, rows of x): the leaves whose boxes hold a vector that has at
        most ``up`` counts more and at most ``down`` counts fewer than the row."""
        by_letter = np.ascontiguousarray(x.T)
        none = np.zeros(len(x), np.int32)
        stack = [(0 if self.nodes else -1, np.arange(len(x)), none, none, {})]
        while stack:
            node, at, more, fewer, box = stack.pop()
            if not len(at):
                continue
            if node < 0:
                yield -1 - node, at
                continue
            letter, cut, left, right = self.nodes[node]
            low, high = box.get(letter, (0, 1 << 30))
            have = by_letter[letter][at]
            needed = fewer + np.maximum(have - cut, 0) - np.maximum(have - high, 0)
            go = needed <= down
            stack.append((left, at[go], more[go], needed[go], box | {letter: (low, cut)}))
            needed = more + np.maximum(cut + 1 - have, 0) - np.maximum(low - have, 0)
            go = needed <= up
            stack.append((right, at[go], needed[go], fewer[go], box | {letter: (cut + 1, high)}))


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one replaced letter or, where ``b`` is
    one longer, by one inserted letter."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    front = np.minimum.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    back = np.minimum.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= n


def near_pairs(members: np.ndarray, queries: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(query, member): rows that are one edit apart; members are as long as the queries or one longer."""
    tree = Tree.grow(letter_counts(members), leaf)
    down = 1 if members.shape[1] == queries.shape[1] else 0
    found, left, right, held = [], [], [], 0
    room = max(1, (1 << 24) // members.shape[1])

    def verify():
        nonlocal left, right, held
        q, m = np.concatenate(left), np.concatenate(right)
        for at in range(0, len(q), room):
            a, b = q[at : at + room], m[at : at + room]
            good = one_edit(queries[a], members[b])
            found.append((a[good], b[good]))
        left, right, held = [], [], 0

    for k, rows in tree.reach(letter_counts(queries), 1, down):
        for at in range(0, len(rows), room):
            some, own = rows[at : at + room], tree.leaves[k]
            left.append(np.repeat(some, len(own))), right.append(np.tile(own, len(some)))
            held += len(left[-1])
            if held >= room:
                verify()
    if held:
        verify()
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (none, none)


def _by_length(words: pd.Series):
    """(length, places) of a column of words."""
    for length, at in words.groupby(words.str.len()).indices.items():
        yield int(length), at


MEMBER, SAME, INSERT = 0, 1, 2


def _reached(words: pd.Series, trees: dict[int, Tree]):
    """(role, length of the tree, cell, places of the words that go there)."""
    for length, at in _by_length(words):
        vectors = letter_counts(codes(words.iloc[at].tolist()))
        for role, size, up, down in ((MEMBER, length, 0, 0), (SAME, length, 1, 1), (INSERT, length + 1, 1, 0)):
            if size in trees:
                for cell, rows in trees[size].reach(vectors, up, down):
                    yield role, size, cell, at[rows]


def upper_trees(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> dict[int, Tree]:
    """A tree for each length of ``words``. At most ``sample`` vectors of
    letter counts, and one count per length, reach the driver."""
    sizes = {r["size"]: r["n"] for r in words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("n")).collect()}
    share = min(1.0, sample / max(1, sum(sizes.values())))
    place = F.pmod(F.xxhash64("word"), F.lit(1 << 40))
    near = words.where(place.cast("double") <= F.lit(2.0 * share * (1 << 40))).orderBy(place, "word").limit(sample)

    def vectors(batches):
        for pdf in batches:
            for length, at in _by_length(pdf["word"]):
                x = letter_counts(codes(pdf["word"].iloc[at].tolist()))
                yield pd.DataFrame({"size": length, "x": [row.tobytes() for row in x]}).astype({"size": "int32"})

    rows = near.select("word").mapInPandas(vectors, "size int, x binary").toPandas().sort_values(["size", "x"])
    own = {int(size): np.frombuffer(b"".join(part["x"]), np.int32).reshape(-1, DIM) for size, part in rows.groupby("size")}
    trees = {}
    for size, n in sizes.items():
        x = own.get(size, np.zeros((0, DIM), np.int32))
        tree = Tree.grow(x, max(1, -(-len(x) // max(1, -(-n // cell)))))
        trees[size] = Tree(tree.nodes, [np.zeros(0, np.int64) for _ in tree.leaves])  # only the cuts are sent out
    return trees


def _cells(words: DataFrame, trees: dict[int, Tree]) -> pd.DataFrame:
    """Members and queries of every cell: one row per cell reaches the driver."""

    def count(batches):
        held = Counter()
        for pdf in batches:
            for role, size, cell, at in _reached(pdf["word"], trees):
                held[size, cell, role == MEMBER] += len(at)
        rows = [(*key, n) for key, n in held.items()]
        yield pd.DataFrame(rows, columns=["size", "cell", "member", "n"]).astype(
            {"size": "int32", "cell": "int32", "member": "bool", "n": "int64"}
        )

    n = F.sum(F.when(F.col("member"), F.col("n")).otherwise(0)), F.sum(F.when(F.col("member"), 0).otherwise(F.col("n")))
    return words.select("word").mapInPandas(count, "size int, cell int, member boolean, n long").groupBy("size", "cell").agg(
        n[0].alias("members"), n[1].alias("queries")
    ).toPandas()


def near_words(words: DataFrame, sample: int = SAMPLE, cell: int = CELL, queries: int = QUERIES) -> DataFrame:
    """(word, n_near, form, form_n) of each word (``words``: word, n; different
    words) that has near words: their number and the one of largest n."""
    trees = upper_trees(words, sample, cell)
    blocks = {}
    for r in _cells(words, trees).itertuples():
        room = max(1, CHARS // int(r.size))
        blocks[int(r.size), int(r.cell)] = (
            max(1, -(-int(r.members) // min(2 * cell, room))), max(1, -(-int(r.queries) // min(queries, room)))
        )
    groups = sum(a * b for a, b in blocks.values())
    if not groups:
        return words.select("word", F.lit(0).cast("long").alias("n_near"), F.col("word").alias("form"), F.col("n").alias("form_n")).where("false")

    def deal(batches):
        for pdf in batches:
            hashes, out = pdf["h"].to_numpy(), []
            for role, size, k, at in _reached(pdf["word"], trees):
                subs, asks = blocks[size, k]
                own, copies = (hashes[at] % subs, asks) if role == MEMBER else (hashes[at] % asks, subs)
                for other in range(copies):
                    sub, ask = (own, np.full(len(at), other)) if role == MEMBER else (np.full(len(at), other), own)
                    out.append((np.full((len(at), 3), (size, k, role)), sub, ask, at))
            if not out:
                continue
            where, sub, ask, at = (np.concatenate(c) for c in zip(*out))
            yield pd.DataFrame({
                "size": where[:, 0], "cell": where[:, 1], "sub": sub, "ask": ask, "role": where[:, 2],
                "word": pdf["word"].to_numpy()[at], "n": pdf["n"].to_numpy()[at],
            }).astype({c: "int32" for c in ("size", "cell", "sub", "ask", "role")})

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("word", ignore_index=True)  # places are then in code-point order
        role, n = pdf["role"].to_numpy(), pdf["n"].to_numpy()
        members = np.flatnonzero(role == MEMBER)
        owner, other = [], []
        for ask in (SAME, INSERT):
            asked = np.flatnonzero(role == ask)
            if not len(asked) or not len(members):
                continue
            q, m = near_pairs(codes(pdf["word"].iloc[members].tolist()), codes(pdf["word"].iloc[asked].tolist()))
            owner.append(asked[q]), other.append(members[m])
            if ask == INSERT:
                owner.append(members[m]), other.append(asked[q])
        if not owner:
            return pd.DataFrame({"word": [], "n_near": [], "form": [], "form_n": []})
        owner, other = np.concatenate(owner), np.concatenate(other)
        order = np.lexsort((other, -n[other], owner))
        owner, other = owner[order], other[order]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        word = pdf["word"].to_numpy()
        return pd.DataFrame({
            "word": word[owner[first]], "n_near": np.diff(np.append(first, len(owner))),
            "form": word[other[first]], "form_n": n[other[first]],
        })

    spark = words.sparkSession
    tasks = min(groups, max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    keys = ["size", "cell", "sub", "ask"]
    dealt = words.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(1 << 40)).alias("h")).mapInPandas(
        deal, "size int, cell int, sub int, ask int, role int, word string, n long"
    )
    # few bytes, much work: the number of tasks follows the groups
    found = dealt.repartition(tasks, *keys).groupBy(*keys).applyInPandas(
        search, "word string, n_near long, form string, form_n long"
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to their last one. Each round
    doubles the steps taken; a chain cannot return to a word."""
    at = stored_copy(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored_copy(
            at.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots",
        )
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(words: DataFrame, ratio: int = 5, sample: int = SAMPLE, cell: int = CELL, queries: int = QUERIES) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n).

    The form of a word is its near word of largest n, if that n is at least
    ``ratio`` times (more than one time) the word's own."""
    words = stored_copy(words.select("word", "n"), "spelling-words")
    best = near_words(words, sample, cell, queries)
    big = F.col("form_n") >= ratio * F.col("n")
    joined = stored_copy(
        words.join(best, "word", "left").select(
            "word", F.when(big, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(big, F.col("form_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(joined.where("form is not null").select("word", "form"))
    return joined.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
