"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to 64 signs of random projections and orders
all vectors by these bits, most significant first, so that vectors with a long
common prefix lie together. Each vector is compared with the next ``WINDOW`` in
this order, also across the borders of partitions, and pairs with a cosine of
at least the threshold are united. Pairs of all passes are united into
components. Vectors are centred for the hash, and only for it, or the signs
would not tell vectors of one narrow cone apart: every other pass around the
mean of a sample, the passes between around the mean of a neighbourhood in it.

How many passes are enough depends on the number and spread of the vectors, so
it is measured: up to ``ASKED`` vectors of smallest hash are compared with all
vectors, and a link is found if both ends are in one component. While less than
``TARGET`` of these links are found, the passes are doubled. With ``exact`` all
vectors are compared in blocks at last, where more passes would move more rows
than that does; without it the passes go on, up to ``MOST_PASSES``.

A window is bounded, a group of copies is not; so links are then counted
exactly within components: all members of a component are compared in blocks
of bounded size, and only a count per vector and block leaves a task. A vector
in a group of thousands therefore has all its links. Equal vectors are one
node with a multiplicity.

Every pass moves each vector once: the shuffle is the passes times the vectors.
NULL or zero vectors and vectors with NULL or non-finite components link with
nothing, and so do vectors of different lengths and rows without vec_id, which
get a NULL component and are kept. Repeated rows are vectors of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm import common
from tallyward.llm.components import components
from tallyward.llm.simhash import stars
from tallyward.session import stored_copy

THRESHOLD = 0.9
PASSES = 20
MOST_PASSES = 640
WINDOW = 24
BITS = 64
SEED = 97
#: Share of the sample's links that passes must find.
TARGET = 0.95
#: Vectors in the sample that is compared with all vectors.
ASKED = 2_048
#: One of so many sample vectors is in a neighbourhood.
NEAR = 8
#: Vectors in a block where all are compared.
WHOLE = 2_048
#: Rows of one vector that one task may join.
COPIES = 512
#: Vectors of one component in a block of the exact count.
BLOCK = 256


def unit(vectors) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.array([np.asarray(v, np.float64) for v in vectors]).reshape(len(vectors), -1)
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)  # no overflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def projections(pass_: int, dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, pass_, dim]).standard_normal((dim, BITS))


def centre(sample: np.ndarray | None, pass_: int) -> np.ndarray | float:
    """What a pass is centred around. ``sample``: unit vectors in a fixed order."""
    if sample is None or not len(sample):
        return 0.0
    if pass_ % 2:
        one = sample[np.random.default_rng([SEED, pass_]).integers(len(sample))]
        sample = sample[np.argsort(-(sample @ one), kind="stable")[: -(-len(sample) // NEAR)]]
    return sample.mean(axis=0)


def hashes(x: np.ndarray, pass_: int, around: np.ndarray | float = 0.0) -> np.ndarray:
    """64 signs as a signed number whose order is the order of the bits."""
    bits = np.packbits((x - around) @ projections(pass_, x.shape[1]) >= 0, axis=1)
    return (bits.copy().view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def window_pairs(x: np.ndarray, low: int, window: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), j from ``low`` on, at most ``window`` apart, with enough cosine."""
    us, vs = [], []
    for gap in range(1, min(window, len(x) - 1) + 1):
        a = np.arange(max(0, low - gap), len(x) - gap)
        hit = a[np.einsum("ij,ij->i", x[a], x[a + gap]) >= threshold]
        us.append(hit), vs.append(hit + gap)
    none = np.zeros(0, np.int64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def _rows(kind: str, pdf: pd.DataFrame, part: int) -> pd.DataFrame:
    return pd.DataFrame({
        "kind": kind, "u": pdf["node"].to_numpy(), "v": pdf["node"].to_numpy(), "pass": pdf["pass"].to_numpy(),
        "dim": pdf["dim"].to_numpy(), "part": part, "vec": pdf["vec"],
    })


_PASS = "kind string, u long, v long, pass int, dim int, part int, vec array<{}>"


def _compare_sorted(batches, window: int, threshold: float):
    """Links in one sorted partition, and its first and last rows of each end
    for the comparison across the border."""
    part = TaskContext.get().partitionId()
    tail, head = None, 0
    for pdf in batches:
        joined = pdf if tail is None else pd.concat([tail, pdf], ignore_index=True)
        low = len(joined) - len(pdf)
        if head < window:
            yield _rows("head", pdf.iloc[: window - head], part)
            head += len(pdf)
        for (pass_, dim), own in joined.groupby(["pass", "dim"], sort=False):
            x = unit(own["vec"].tolist())
            fresh = int((own.index < low).sum())
            # a star per linked set says as much as all its pairs
            root = stars(*window_pairs(x, fresh, window, threshold), len(x))
            moved, node = root != np.arange(len(x)), own["node"].to_numpy()
            yield pd.DataFrame({
                "kind": "link", "u": node[moved], "v": node[root[moved]], "pass": pass_, "dim": dim, "part": part,
                "vec": pd.Series([None] * int(moved.sum()), dtype=object),
            })
        tail = joined.iloc[-window:].reset_index(drop=True)
    if tail is not None:
        yield _rows("tail", tail, part)


def pass_links(nodes: DataFrame, passes: range, window: int, threshold: float, sample: pd.DataFrame) -> DataFrame:
    """(u, v) of all passes. ``nodes``, ``sample``: node, vec; vectors differ."""
    known = {dim: unit(own["vec"].tolist()) for dim, own in sample.groupby(sample["vec"].map(len))}
    around = {(dim, p): centre(x, p) for dim, x in known.items() for p in passes}

    def hashed(batches):
        for pdf in batches:
            for dim, own in pdf.groupby(pdf["vec"].map(len)):
                x = unit(own["vec"].tolist())
                for p in passes:
                    yield pd.DataFrame({
                        "pass": p, "dim": dim, "hash": hashes(x, p, around.get((dim, p), 0.0)), "node": own["node"].to_numpy(), "vec": own["vec"],
                    }).astype({"pass": "int32", "dim": "int32"})

    number = nodes.schema["vec"].dataType.elementType.simpleString()
    keyed = nodes.select("node", "vec").mapInPandas(
        hashed, f"pass int, dim int, hash long, node long, vec array<{number}>"
    )
    order = ["pass", "dim", "hash", "node"]
    sorted_ = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored_copy(sorted_.mapInPandas(lambda b: _compare_sorted(b, window, threshold), _PASS.format(number)), "embed-passes")
    inside = found.where("kind = 'link'").select("u", "v").distinct()

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        tail, head = pdf[pdf["kind"] == "tail"], pdf[pdf["kind"] == "head"]
        if not len(tail) or not len(head):
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        # both are at most `window` rows
        near = unit(tail["vec"].tolist()) @ unit(head["vec"].tolist()).T >= threshold
        i, j = np.nonzero(near)
        return pd.DataFrame({"u": tail["u"].to_numpy()[i], "v": head["u"].to_numpy()[j]})

    ends = found.where("kind <> 'link'")
    border = ends.withColumn("border", F.when(F.col("kind") == "tail", F.col("part") + 1).otherwise(F.col("part")))
    return inside.unionByName(border.groupBy("border", "pass", "dim").applyInPandas(across, "u long, v long"))


def whole_links(nodes: DataFrame, blocks: int, threshold: float) -> DataFrame:
    """(u, v): all vectors compared in pairs of blocks; a star per linked set of a pair."""
    dealt = (
        nodes.select("node", "vec", F.size("vec").alias("dim"), F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("own"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("o"))
        .select("node", "vec", "dim", "own", F.least("own", "o").alias("b"), F.greatest("own", "o").alias("c"))
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        b, c = pdf["b"].iloc[0], pdf["c"].iloc[0]
        x, node, own = unit(pdf["vec"].tolist()), pdf["node"].to_numpy(), pdf["own"].to_numpy()
        left, right, root = np.flatnonzero(own == b), np.flatnonzero(own == c), np.arange(len(x))
        for at in range(0, len(left), 256):
            i, j = np.nonzero(x[left[at : at + 256]] @ x[right].T >= threshold)
            i, j = left[at + i], right[j]
            # stars so far are links too, so that few pairs are held
            root = stars(np.concatenate([np.arange(len(x)), i]), np.concatenate([root, j]), len(x))
        moved = root != np.arange(len(x))
        return pd.DataFrame({"u": node[moved], "v": node[root[moved]]}, dtype="int64")

    return dealt.groupBy("b", "c", "dim").applyInPandas(compare, "u long, v long")


def recall(nodes: DataFrame, member: DataFrame, sample: pd.DataFrame, threshold: float) -> float:
    """The share of the links between ``sample`` and all vectors that have both
    ends in one component. Sample vectors are classed by the magnitude of their
    number of links, and the least share of a class counts, so that a large
    group does not hide loose pairs. A task sends two sums per sample vector."""
    spark = nodes.sparkSession
    asked = spark.createDataFrame(sample[["node"]], "node long").join(member, "node").toPandas()
    asked = sample.merge(asked, "left", on="node")
    own = asked["component"].where(asked["component"].notna(), asked["node"]).to_numpy(np.int64)
    known = {
        dim: (unit(part["vec"].tolist()), part["node"].to_numpy(np.int64), own[part.index], part.index.to_numpy())
        for dim, part in asked.groupby(asked["vec"].map(len))
    }
    shared = spark.sparkContext.broadcast(known)

    def count(batches):
        links, found = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["vec"].map(len)):
                if dim not in shared.value:
                    continue
                q, node, component, at = shared.value[dim]
                for low in range(0, len(part), 1024):
                    some = part.iloc[low : low + 1024]
                    near = unit(some["vec"].tolist()) @ q.T >= threshold
                    near &= some["node"].to_numpy()[:, None] != node
                    links[at] += near.sum(axis=0)
                    found[at] += (near & (some["component"].to_numpy()[:, None] == component)).sum(axis=0)
        some = np.flatnonzero(links)
        yield pd.DataFrame({"at": some, "links": links[some], "found": found[some]})

    all_ = nodes.join(member, "node", "left").select("node", "vec", F.coalesce("component", "node").alias("component"))
    got = all_.mapInPandas(count, "at long, links long, found long").groupBy("at").agg(
        F.sum("links").alias("links"), F.sum("found").alias("found")
    ).toPandas()
    share = (got["found"] / got["links"]).groupby(np.frexp(got["links"].to_numpy(float))[1]).mean()
    return float(share.min()) if len(share) else 1.0


def linked_components(
    nodes: DataFrame, threshold: float, passes: int, window: int, target: float, asked: int, whole: int, exact: bool = True
) -> DataFrame:
    """(node, component), by as many passes as the sample's links ask for."""
    sample = common.smallest_hashes(nodes.select(F.col("node").alias("doc_id"), "vec"), asked).toPandas()
    sample = sample.rename(columns={"doc_id": "node"}).sort_values("node", ignore_index=True)
    blocks, done, links = -(-max(1, nodes.count()) // whole), range(0), None
    while True:
        done = range(done.stop, max(passes, 2 * done.stop))
        new = pass_links(nodes, done, window, threshold, sample)
        links = stored_copy(new if links is None else links.unionByName(new), "embed-links")
        member = components(links, "embed-components")
        if recall(nodes, member, sample, threshold) >= target:
            return member
        if 2 * done.stop >= blocks if exact else done.stop >= MOST_PASSES:
            if not exact:
                return member
            return components(whole_links(nodes, blocks, threshold), "embed-components")


def member_counts(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, n): the multiplicities of a node's partners. ``members``: component, node, n, vec."""
    sized = members.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = (
        members.join(sized, "component")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("component", "node", "n", "vec", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
        .select("component", "node", "n", "vec", "own", F.least("own", "o").alias("b"), F.greatest("own", "o").alias("c"))
        .repartition("component", "b", "c")  # else the join's layout keeps a component in one task
    )

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        b, c = pdf["b"].iloc[0], pdf["c"].iloc[0]
        left, right = pdf[pdf["own"] == b], pdf[pdf["own"] == c]
        many = np.zeros(len(left)), np.zeros(len(right))
        x = {d: unit(v["vec"].tolist()) for d, v in (("l", left), ("r", right)) if len(v)}
        if len(x) == 2:
            for at in range(0, len(left), 512):
                near = x["l"][at : at + 512] @ x["r"].T >= threshold
                if b == c:
                    near[np.arange(len(near)), at + np.arange(len(near))] = False
                many[0][at : at + 512] = near @ right["n"].to_numpy()
                many[1][:] += left["n"].to_numpy()[at : at + 512] @ near
        out = [pd.DataFrame({"node": left["node"].to_numpy(), "partners": many[0]})]
        if b != c:
            out.append(pd.DataFrame({"node": right["node"].to_numpy(), "partners": many[1]}))
        return pd.concat(out).astype("int64")

    counted = dealt.groupBy("component", "b", "c").applyInPandas(count, "node long, partners long")
    return counted.groupBy("node").agg(F.sum("partners").alias("partners"))


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    passes: int = PASSES,
    window: int = WINDOW,
    block: int = BLOCK,
    target: float = TARGET,
    asked: int = ASKED,
    whole: int = WHOLE,
    exact: bool = True,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors`` (vec_id, embedding).

    ``exact`` chooses what closes a gap in recall that more passes do not: see above."""
    number = vectors.schema["embedding"].dataType.elementType.simpleString()
    kept_as = "float" if number == "float" else "double"
    rows = vectors.select("vec_id", F.col("embedding").cast(f"array<{kept_as}>").alias("vec"))
    sound = (
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("vec", lambda v: v != 0)
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    nodes = rows.where("sound").groupBy("vec").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))
    nodes = stored_copy(nodes, "embed-nodes")
    member = linked_components(nodes, threshold, passes, window, target, asked, whole, exact)
    linked = stored_copy(nodes.join(member, "node").select("component", "node", "n", "vec"), "embed-members")
    counts = member_counts(linked, threshold, block)
    told = nodes.join(member, "node", "left").join(counts, "node", "left").select(
        "vec", F.coalesce("component", "node").alias("component"),
        (F.coalesce("partners", F.lit(0)) + F.col("n") - 1).alias("links"), "n",
    )
    out = common.join_counted(rows.where("sound").select("vec_id", "vec"), told, "vec", "n", COPIES, "embed-told").select(
        "vec_id", "links", "component"
    )
    rest = rows.where("not sound").select(
        "vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("component")
    )
    return out.unionByName(rest).select(
        "vec_id",
        F.col("links").cast("long").alias("n_links"),
        F.col("component").cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"),
    )
