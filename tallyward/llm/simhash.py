"""SimHash near-duplicates: 64-bit fingerprints linked at 4 or fewer differing bits.

Candidates come from the pigeonring principle. The 64 bits form a ring of
nine segments. If two fingerprints differ in at most 4 bits in all, some
segment starts a chain in which the first l segments together differ in at
most floor(4 l / 9) bits, for every l: 0, 0, 1, 1, 2, 2, 3, 3, 4. So segments
0 and 1 of the chain agree; of 2 and 3 at least one agrees; and if one of them
differs, one of 4 and 5 agrees. Each start therefore needs five keys of four
equal segments (27 to 29 bits): 0123, 0124, 0125, 0134, 0135. Fingerprints
that share a key are tested against the longer budgets of their chain and
then by their full distance. No link is lost.

Equal fingerprints are one node, so exact copies cost nothing. Within a key
only a spanning star of each linked set leaves the task, never all its pairs.
A key with more than ``IN_MEMORY`` different fingerprints is dealt out again
as pairs of blocks, so no task holds more than two blocks.

NULL, empty and blank texts have fingerprint zero and are linked like others.
Repeated rows give repeated result rows. Rows without doc_id get a fingerprint
and a NULL component and link nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallyward.llm.common import join_counted
from tallyward.llm.components import components
from tallyward.session import stored_copy

SHINGLE = 4
SEED = 42
MOST_BITS = 4
#: Documents of one fingerprint that one task may join.
COPIES = 512
#: Different fingerprints of one key that a task compares at once.
IN_MEMORY = 4096

WIDTHS = (7, 7, 7, 7, 7, 7, 7, 7, 8)
RING = len(WIDTHS)
KEYS = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 2, 5), (0, 1, 3, 4), (0, 1, 3, 5))


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(0, len(words) - SHINGLE)
    starts, ends = starts[: last + 1], ends[min(SHINGLE, len(words)) - 1 :]
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 65_536):
        part = zip(starts[at : at + 65_536].tolist(), ends[at : at + 65_536].tolist())
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in part])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def _masks() -> np.ndarray:
    """Bits of each segment, as 64-bit masks."""
    out, at = [], 64
    for width in WIDTHS:
        at -= width
        out.append(((1 << width) - 1) << at)
    return np.array(out, np.uint64)


SEGMENTS = _masks()


def chain_mask(start: int, length: int) -> int:
    return int(np.bitwise_or.reduce([SEGMENTS[(start + i) % RING] for i in range(length)]))


def key_masks() -> list[tuple[int, int]]:
    """(start, mask of the segments that must be equal) of every key."""
    return [
        (start, int(np.bitwise_or.reduce([SEGMENTS[(start + i) % RING] for i in chosen])))
        for start in range(RING)
        for chosen in KEYS
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


MASKS = key_masks()
#: Budgets of the longer chains, tested before the full distance: (length, most bits).
BUDGETS = ((6, 6 * MOST_BITS // RING), (8, 8 * MOST_BITS // RING))
_LONGER = np.array([[chain_mask(start, length) for length, _ in BUDGETS] for start in range(RING)], np.uint64)
_START = np.array([start for start, _ in MASKS])


def near(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which candidate pairs stay within the budgets of their chain and at most 4 bits apart."""
    differ = a ^ b
    good = np.arange(len(differ))
    for k, (_, most) in enumerate(BUDGETS):
        good = good[np.bitwise_count(differ[good] & _LONGER[start[good], k]) <= most]
    return good[np.bitwise_count(differ[good]) <= MOST_BITS]


def stars(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest index linked to each of 0..n-1 through the pairs (u, v)."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        open_ = a != b
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def _link_runs(run: np.ndarray, fp: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Star links of fingerprints sorted by ``run``: every pair of one run is tested."""
    n, root = len(run), np.arange(len(run))
    left, gap, us, vs, held = np.arange(n), 1, [], [], 0
    while len(left):
        left = left[left + gap < n]
        left = left[run[left] == run[left + gap]]
        # pairs that are already linked need no test
        ask = left[root[left] != root[left + gap]]
        hit = ask[near(fp[ask], fp[ask + gap], start[ask])]
        us.append(hit), vs.append(hit + gap)
        held += len(hit)
        if held > 4 * n:
            root, us, vs, held = root[stars(root[np.concatenate(us)], root[np.concatenate(vs)], n)], [], [], 0
        gap += 1
    if us:
        root = root[stars(root[np.concatenate(us)], root[np.concatenate(vs)], n)]
    return root


def _bucket_links(batches, most: int = IN_MEMORY):
    """Links within the keys of one sorted partition. A row (p, fp, key): p the
    key's number. Keys over ``most`` are passed on as (-1 - p, fp, key)."""
    tail, over = pd.DataFrame(), None

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        nonlocal over
        p, key = pdf["p"].to_numpy(), pdf["key"].to_numpy()
        new = np.concatenate([[True], (p[1:] != p[:-1]) | (key[1:] != key[:-1])])
        run = np.cumsum(new) - 1
        sizes = np.bincount(run)
        wide = sizes > most
        if over is not None and (p[0], key[0]) == over:
            wide[0] = True
        over = (p[-1], key[-1]) if wide[-1] else None
        out = pdf[wide[run]].assign(p=lambda d: -1 - d["p"])
        some = ((sizes > 1) & ~wide)[run]
        fp = pdf["fp"].to_numpy()[some]
        root = _link_runs(run[some], fp.view(np.uint64), _START[p[some]])
        moved = root != np.arange(len(root))
        links = pd.DataFrame({"p": 0, "fp": fp[moved], "key": fp[root[moved]]}).drop_duplicates()
        return pd.concat([links, out])[["p", "fp", "key"]].astype("int64")

    for pdf in batches:
        pdf = pd.concat([tail, pdf], ignore_index=True)
        last = (pdf["p"].to_numpy() == pdf["p"].iloc[-1]) & (pdf["key"].to_numpy() == pdf["key"].iloc[-1])
        size = int(last.sum())
        if size > most or over == (pdf["p"].iloc[-1], pdf["key"].iloc[-1]):
            yield solve(pdf)  # a wide key is passed on as it comes, not held
            tail = pd.DataFrame()
            continue
        tail = pdf[last]
        if size < len(pdf):
            yield solve(pdf[~last])
    if len(tail):
        yield solve(tail)


def _wide_links(wide: DataFrame, most: int) -> DataFrame:
    """Links of keys with more than ``most`` fingerprints: blocks by hash, one
    task group for each pair of blocks."""
    sized = wide.groupBy("p", "key").agg(F.ceil(F.count("*") / (most // 2)).cast("int").alias("blocks"))
    dealt = (
        wide.join(sized, ["p", "key"])
        .withColumn("b", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .select("p", "key", "fp", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("c"))
        .select("p", "key", "fp", F.least("b", "c").alias("b"), F.greatest("b", "c").alias("c"))
        .repartition("p", "key", "b", "c")  # else the join's layout keeps a key in one task
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy()
        root = _link_runs(
            np.zeros(len(fp), np.int64), fp.view(np.uint64), np.full(len(fp), _START[pdf["p"].iloc[0]])
        )
        moved = root != np.arange(len(root))
        return pd.DataFrame({"u": fp[moved], "v": fp[root[moved]]})

    return dealt.groupBy("p", "key", "b", "c").applyInPandas(compare, "u long, v long")


def fingerprint_links(nodes: DataFrame, most: int = IN_MEMORY) -> DataFrame:
    """(u, v): links that connect all fingerprints (``nodes.fp``, distinct)
    which are at most 4 bits apart, directly or through others."""
    keys = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(p).cast("long").alias("p"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
        for p, (_, mask) in enumerate(MASKS)
    ])).alias("k")).select("k.p", "fp", "k.key")
    sorted_keys = keys.repartition("p", "key").sortWithinPartitions("p", "key")
    found = stored_copy(
        sorted_keys.mapInPandas(lambda b: _bucket_links(b, most), "p long, fp long, key long"), "simhash-links"
    )
    narrow = found.where("p = 0").select(F.col("fp").alias("u"), F.col("key").alias("v"))
    wide = found.where("p < 0").select((-1 - F.col("p")).alias("p"), "fp", "key")
    return narrow.unionByName(_wide_links(wide, most))


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([_signed(fingerprint(t)) for t in texts], dtype="int64")


def near_duplicates(docs: DataFrame, most: int = IN_MEMORY) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    printed = stored_copy(docs.select("doc_id", _fingerprints(F.col("text").cast("string")).alias("fp")), "simhash")
    nodes = printed.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    nodes = stored_copy(nodes, "simhash-nodes")
    links = fingerprint_links(nodes, most)
    by_id = (
        links.join(nodes.select(F.col("fp").alias("u"), F.col("first_id").alias("a")), "u")
        .join(nodes.select(F.col("fp").alias("v"), F.col("first_id").alias("b")), "v")
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )
    member = components(by_id, "simhash-components")
    named = nodes.join(member, nodes["first_id"] == member["node"], "left").select(
        "fp", F.coalesce("component", "first_id").alias("component_id"), "n"
    )
    known = join_counted(printed.where("doc_id is not null"), named, "fp", "n", COPIES, "simhash-named")
    lost = printed.where("doc_id is null").select("doc_id", "fp", F.lit(None).cast("long").alias("component_id"))
    return known.select("doc_id", "fp", "component_id").unionByName(lost).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, most: int = IN_MEMORY) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the document
    with the smallest doc_id stays, once (of rows that repeat this id the one
    with the smallest text, then row hash). Rows without doc_id cannot be
    linked and stay."""
    ids = near_duplicates(docs, most).where("doc_id is not null").groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"), F.count("*").alias("n")
    )
    ids = stored_copy(ids, "simhash-kept")
    columns = docs.columns
    # ids grow with the documents: one plan at every size, a merge join by doc_id
    once = docs.join(ids.where("doc_id = component_id and n = 1").select("doc_id").hint("merge"), "doc_id", "left_semi")
    again = docs.join(ids.where("doc_id = component_id and n > 1").select("doc_id").hint("merge"), "doc_id", "left_semi")
    row = F.struct(*columns)
    again = again.groupBy("doc_id").agg(
        F.min_by(row, F.struct("text", F.xxhash64(*columns))).alias("row")
    ).select("row.*")
    return once.select(*columns).unionByName(again.select(*columns)).unionByName(docs.where("doc_id is null"))
