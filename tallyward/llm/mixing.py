"""Mixing sources to target weights: temperature, budget, block permutations.

Weights are the token shares of the sources to the power of an exponent,
normalised. Exponent 1 keeps the natural shares and 0 makes them equal. The
exponent is bisected (many points per pass, each pass one aggregate over the
per-source table) to the largest one that reaches the target entropy, or, if a
source would then be repeated more often than allowed, to the smallest one that
keeps the repetition limit.

Each source gets a token budget from its weight. It is spent in epochs. An
epoch deals the documents of the source in a hash permutation of its own, cut
into blocks by the leading hash bits. All epochs but the last are whole; the
last one takes whole blocks and then documents of one block, in order of the
permutation, as long as the budget holds. Sums per block decide all blocks but
that one, so a source with a third of all documents is spread over all blocks
and never lies in one window. The plan of a source is one row: its number of
whole epochs and the last hash that the last epoch takes.

NULL sources are one source. NULL, empty and blank texts have no tokens, cost
no budget and appear once. Repeated rows are documents of their own; equal ids
stand at one place of a permutation and are taken together. Where no document
has a token, every row appears once. Ties of hashes go by doc_id, NULL first.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyward.session import stored_copy

SEED = 20_240_607
BLOCK_BITS = 10
POINTS = 64
PASSES = 6

_LOWEST = -(1 << 63)
_HIGHEST = (1 << 63) - 1


@dataclass(frozen=True)
class Target:
    """``entropy`` as a part of the largest possible one (log of the number of
    sources); ``repeats`` the most epochs a source may get; ``budget`` tokens in
    all. Without a budget, the least repeated source gets exactly one epoch,
    so that every document appears."""

    entropy: float = 0.97
    repeats: float = 4.0
    budget: int | None = None


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _place(doc_id: Column, epoch: Column) -> Column:
    """63 bits: the place of a document in the permutation of an epoch."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, epoch, F.lit(SEED)), 1)


def _at_exponents(shares: DataFrame, exponents: list[float], target: Target, tokens: int) -> list[dict]:
    """Entropy and largest number of epochs at each exponent, in one aggregate."""
    at = shares.where("p > 0").select(
        "p", F.explode(F.array(*map(F.lit, exponents))).alias("a")
    ).withColumn("w", F.pow("p", "a"))
    got = at.groupBy("a").agg(
        F.sum("w").alias("z"),
        F.sum(F.col("w") * F.log("w")).alias("wlog"),
        F.max(F.pow(F.col("p"), F.col("a") - 1)).alias("most"),
        F.min(F.pow(F.col("p"), F.col("a") - 1)).alias("least"),
    ).collect()
    out = []
    for r in got:
        scale = 1 / r["least"] if target.budget is None else target.budget / tokens / r["z"]
        out.append({"a": r["a"], "entropy": math.log(r["z"]) - r["wlog"] / r["z"], "repeats": scale * r["most"]})
    return sorted(out, key=lambda r: r["a"])


def exponent(shares: DataFrame, target: Target, tokens: int, sources: int) -> float:
    """The exponent in 0 to 1 that the module's head describes."""

    def largest(good) -> float | None:
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            grid = [low + (high - low) * k / POINTS for k in range(POINTS + 1)]
            told = [good(r) for r in _at_exponents(shares, grid, target, tokens)]
            if told[-1]:
                return high
            if not told[0]:
                return None
            last = max(k for k, ok in enumerate(told) if ok)
            low, high = grid[last], grid[last + 1]
        return low

    wanted = target.entropy * math.log(sources) if sources > 1 else 0.0
    by_entropy = largest(lambda r: r["entropy"] >= wanted - 1e-12)
    found = 0.0 if by_entropy is None else by_entropy
    over = largest(lambda r: r["repeats"] > target.repeats * (1 + 1e-12))
    return found if over is None else max(found, min(1.0, over + POINTS ** -float(PASSES)))


def plan(docs: DataFrame, target: Target, tokens: Column | None = None) -> DataFrame:
    """One row per source: tokens, weight, epochs (whole), budget, and the
    last place (cut_place, cut_id) that the epoch after those takes.

    ``docs`` has doc_id, source and, unless ``tokens`` is given, text."""
    counted = stored_copy(
        docs.select("doc_id", "source", (word_count(F.col("text")) if tokens is None else tokens).alias("n_tokens")),
        "mixing-counts",
    )
    per_source = stored_copy(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mixing-sources")
    total, sources = per_source.agg(F.sum("tokens"), F.count(F.when(F.col("tokens") > 0, 1))).first()
    total = total or 0
    shares = per_source.withColumn("p", F.col("tokens") / F.lit(max(1, total)))
    alpha = exponent(shares, target, total, sources) if total else 1.0
    norms = shares.where("p > 0").agg(
        F.sum(F.pow("p", F.lit(alpha))).alias("z"), F.min(F.pow("p", F.lit(alpha - 1))).alias("least")
    ).first()
    weighted = shares.withColumn(
        "weight", F.when(F.col("p") > 0, F.pow("p", F.lit(alpha)) / F.lit(norms["z"] or 1.0)).otherwise(0.0)
    )
    if target.budget is None:
        share = F.greatest("tokens", F.floor(F.col("tokens") * F.pow("p", F.lit(alpha - 1)) / F.lit(norms["least"] or 1.0)))
    else:
        share = F.floor(F.col("weight") * target.budget)
    budgets = weighted.withColumn("budget", F.when(F.col("p") > 0, share).otherwise(0).cast("long"))
    budgets = budgets.withColumn(
        "epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1).cast("long")
    ).withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(0))
    budgets = stored_copy(budgets.select("source", "tokens", "weight", "budget", "epochs", "rest"), "mixing-budgets")

    c, b = counted.alias("c"), budgets.where("rest > 0").alias("b")
    placed = c.join(b, F.col("c.source").eqNullSafe(F.col("b.source"))).where("n_tokens > 0").select(
        "b.source", "rest", "n_tokens", F.coalesce("doc_id", F.lit(_LOWEST)).alias("id"),
        _place(F.col("doc_id"), F.col("epochs")).alias("place"),
    ).withColumn("block", F.shiftrightunsigned("place", 63 - BLOCK_BITS).cast("int"))
    blocks = placed.groupBy("source", "rest", "block").agg(F.sum("n_tokens").alias("in_block"))
    blocks = blocks.withColumn(
        "until", F.sum("in_block").over(Window.partitionBy("source").orderBy("block"))
    )
    first_over = blocks.where("until > rest").groupBy("source").agg(
        F.min(F.struct("block", (F.col("rest") - F.col("until") + F.col("in_block")).alias("left"))).alias("o")
    ).select("source", F.col("o.block").alias("block"), F.col("o.left").alias("left"))
    p, o = placed.alias("p"), first_over.alias("o")
    inside = p.join(
        o, F.col("p.source").eqNullSafe(F.col("o.source")) & (F.col("p.block") == F.col("o.block"))
    ).select("p.source", "place", "id", "n_tokens", "left")
    inside = inside.withColumn(
        "until", F.sum("n_tokens").over(Window.partitionBy("source").orderBy("place", "id"))
    )
    cut = inside.where("until <= left").groupBy("source").agg(F.max(F.struct("place", "id")).alias("cut"))
    start = F.shiftleft(F.col("block").cast("long"), 63 - BLOCK_BITS)
    before = first_over.select("source", F.struct((start - 1).alias("place"), F.lit(_HIGHEST).alias("id")).alias("cut"))
    cuts = before.unionByName(cut).groupBy("source").agg(F.max("cut").alias("cut"))
    a, d = budgets.alias("a"), cuts.alias("d")
    # stored, so that its size is known when documents are joined: few sources are
    # sent to the documents, and these are not shuffled by source
    return stored_copy(a.join(d, F.col("a.source").eqNullSafe(F.col("d.source")), "left").select(
        "a.source", "tokens", "weight", "budget", "epochs", "rest",
        F.coalesce("cut.place", F.lit(-1)).alias("cut_place"), F.coalesce("cut.id", F.lit(_LOWEST)).alias("cut_id"),
    ), "mixing-plan")


def _dealt(docs: DataFrame, plan_: DataFrame, n_tokens: Column) -> DataFrame:
    """Rows (row, source, n_tokens, weight, share, epoch, place), one per appearance."""
    known = docs.select(F.struct(*docs.columns).alias("row"), n_tokens.alias("n_tokens")).alias("k")
    joined = known.join(plan_.alias("l"), F.col("k.row.source").eqNullSafe(F.col("l.source")))
    doc_id = F.col("row.doc_id")
    place = _place(doc_id, F.col("epochs"))
    last = (F.col("rest") > 0) & (
        F.struct(place, F.coalesce(doc_id, F.lit(_LOWEST))) <= F.struct("cut_place", "cut_id")
    )
    times = F.when(F.col("n_tokens") > 0, F.col("epochs") + F.when(last, 1).otherwise(0)).otherwise(1)
    return joined.select(
        "row", "n_tokens", "weight", (F.col("budget") / F.col("tokens")).alias("turns"),
        F.explode(F.when(
            times > 0, F.sequence(F.lit(0).cast("long"), times - 1)
        ).otherwise(F.array().cast(T.ArrayType(T.LongType())))).alias("epoch"),
    ).withColumn("place", _place(F.col("row.doc_id"), F.col("epoch")))


def mixture(docs: DataFrame, target: Target) -> DataFrame:
    """doc_id, source, n_tokens, weight, epoch, block, mix_key: one row per
    appearance. Reading by ``mix_key`` (0 to about 1) interleaves the sources in
    proportion to their weights."""
    counted = stored_copy(docs.select("doc_id", "source", word_count(F.col("text")).alias("n_tokens")), "mixing-docs")
    dealt = _dealt(counted, plan(counted, target, F.col("n_tokens")), F.col("n_tokens"))
    turn = F.col("epoch") + F.col("place") / F.lit(float(1 << 63))
    return dealt.select(
        "row.doc_id", "row.source", "n_tokens", "weight", "epoch",
        F.shiftrightunsigned("place", 63 - BLOCK_BITS).cast("int").alias("block"),
        F.when(F.col("n_tokens") > 0, turn / F.col("turns")).otherwise(turn).alias("mix_key"),
    )


def mix(docs: DataFrame, target: Target) -> DataFrame:
    """The rows of ``docs``, each as often as its source's budget says, with all their columns."""
    dealt = _dealt(docs, plan(docs, target), word_count(F.col("text")))
    return dealt.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
