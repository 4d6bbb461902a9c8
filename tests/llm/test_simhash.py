import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyward.llm import embed_dedup, simhash
from tallyward.llm.components import components


def brute_components(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_fingerprint_matches_definition_and_spark_hash(spark):
    text = "The quick\tBrown fox\njumps over ÄÖ the lazy dog the quick brown fox"
    words = text.replace("\t", " ").replace("\n", " ").split(" ")
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want
    assert spark.range(1).select(F.xxhash64(F.lit(grams[0]))).first()[0] % (1 << 64) == hashes[0]
    assert simhash.fingerprint("one two") == xxhash.xxh64_intdigest(b"one two", seed=42)
    assert [simhash.fingerprint(t) for t in (None, "", " \n")] == [0, 0, 0]


def test_every_close_pair_shares_a_key_and_passes_its_chain():
    rng = random.Random(7)
    for _ in range(3_000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, simhash.MOST_BITS)):
            b ^= 1 << bit
        shared = [(s, m) for s, m in simhash.MASKS if a & m == b & m]
        start = np.array([s for s, _ in shared])
        pair = np.array([a], np.uint64), np.array([b], np.uint64)
        assert len(simhash.near(pair[0].repeat(len(start)), pair[1].repeat(len(start)), start))


@pytest.mark.parametrize("most", [4, 4096])
def test_links_and_components_match_brute_force(spark, most):
    rng = random.Random(3)
    prints = [0]
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(25):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                value ^= 1 << bit
            prints.append(value)
    prints = sorted(set(prints))
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in prints]
    links = simhash.fingerprint_links(spark.createDataFrame(rows, "fp long"), most).distinct().collect()
    number = {r[0]: i for i, r in enumerate(rows)}
    close = {(number[r.u], number[r.v]) for r in links}
    assert all((prints[i] ^ prints[j]).bit_count() <= 5 * 8 for i, j in close)
    want = brute_components(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert brute_components(len(prints), lambda i, j: (i, j) in close or (j, i) in close) == want


def test_documents(spark):
    base = [f"w{i}" for i in range(400)]
    near = [*base[:200], "changed", *base[201:]]
    rows = [
        (7, " ".join(base), "a"), (3, " ".join(base), "b"), (9, " ".join(near), "c"), (4, "something else here now", "d"),
        (1, None, "e"), (2, "", "f"), (5, " \n", "g"), (None, " ".join(base), "h"), (4, "something else here now", "d"),
        (8, "x" * 200_000, "i"), (8, "other words for the same id", "j"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r.component_id for r in got}
    assert (by_id[7], by_id[3], by_id[1], by_id[2], by_id[5], by_id[4], by_id[None]) == (3, 3, 1, 1, 1, 4, None)
    differ = (simhash.fingerprint(" ".join(base)) ^ simhash.fingerprint(" ".join(near))).bit_count()
    assert by_id[9] == (3 if differ <= 4 else 9)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([3, 4, 1, 8, None] + ([9] if differ > 4 else []), key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 32))
    x = [c + rng.normal(scale=0.25, size=32) for c in centres for _ in range(6)] + [centres[0]] * 40
    x += list(centres[1] + rng.normal(scale=0.05, size=(120, 32)))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 32), (902, [float("nan")] * 32), (903, [None] * 32), (904, [1.0]), (905, [1.0, 2.0]), (906, [])]
    df = spark.createDataFrame(rows + odd + [(None, rows[0][1])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df, block=32).collect()}
    unit = embed_dedup.unit([r for _, r in rows])
    near = unit @ unit.T >= embed_dedup.THRESHOLD
    want = near.sum(axis=1) - 1
    found = np.array([got[i].n_links for i in range(len(rows))])
    assert (found <= want).all() and found.sum() >= 0.98 * want.sum()
    root = brute_components(len(rows), lambda i, j: near[i, j])
    assert np.mean([got[i].component_id == root[i] for i in range(len(rows))]) > 0.97
    assert all(got[i].kept == (got[i].component_id == i) for i in range(len(rows)))
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i, _ in odd)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, True)
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_recall_of_loose_pairs():
    """Pairs at a cosine of 0.9 to 0.93 among many unrelated vectors."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(8_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.normal(size=(300, 64))
    for k in range(300):
        side = other[k] - (other[k] @ x[k]) * x[k]
        cos = rng.uniform(0.9, 0.93)
        x[7_999 - k] = cos * x[k] + np.sqrt(1 - cos**2) * side / np.linalg.norm(side)
    found = set()
    for p in range(embed_dedup.PASSES):
        order = np.argsort(embed_dedup.hashes(x, p))
        i, j = embed_dedup.window_pairs(x[order], 0, embed_dedup.WINDOW, 0.9 - 1e-9)
        found |= {(min(a, b), max(a, b)) for a, b in zip(order[i].tolist(), order[j].tolist())}
    assert sum((k, 7_999 - k) in found for k in range(300)) >= 0.95 * 300


@pytest.mark.parametrize("whole", [2_048, 8])
def test_recall_of_loose_pairs_in_a_cone(spark, whole):
    """Unrelated vectors have a cosine of 0.7; by blocks of 8, passes are added in place of comparing all."""
    rng, n = np.random.default_rng(8), 6_000
    x = np.sqrt(0.3) * embed_dedup.unit(rng.normal(size=(n, 64))) + np.sqrt(0.7) * np.eye(64)[0]
    x = embed_dedup.unit(x)
    for k in range(300):
        side = x[1_000 + k] - (x[1_000 + k] @ x[k]) * x[k]
        cos = rng.uniform(0.9, 0.93)
        x[n - 1 - k] = cos * x[k] + np.sqrt(1 - cos**2) * side / np.linalg.norm(side)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    more = {} if whole == 2_048 else {"whole": whole}
    component = {r.vec_id: r.component_id for r in embed_dedup.near_duplicates(df, **more).collect()}
    i, j = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    assert len(i) >= 300 and np.mean([component[a] == component[b] for a, b in zip(i.tolist(), j.tolist())]) >= 0.95
