import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import common, fingerprints, queries, spelling, whitening

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, n string"


# Spelling variants ------------------------------------------------------------------------------


def edits(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for c in letters:
        out |= {word[:i] + c + word[i:] for i in range(len(word) + 1)} | {word[:i] + c + word[i + 1 :] for i in range(len(word))}
    return out - {word}


def brute_variants(counts, ratio=5):
    letters = sorted({c for w in counts for c in w})
    forms, out = {}, {}
    for w, n in counts.items():
        near = [x for x in edits(w, letters) if x in counts]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= ratio * n else None
        out[w] = (n, len(near))
    rows = set()
    for w, (n, k) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n, k, counts.get(forms[w])))
    return rows


def word_table(docs, slip, shortest=6, fewest=5):
    import re

    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= shortest and n >= fewest}


def test_words_are_counted_over_whole_texts(spark):
    docs = [(1, "Éclair ÉCLAIR éclair " * 4), (2, None), (3, ""), (None, "planet's planets " * 9), (4, "orange" * 3000), (5, "a×bcdef÷ " * 5)]
    docs += docs[:1]
    frame = spark.createDataFrame([(i, t, "s", "n") for i, t in docs], DOCS)
    for slip in (0, 2):
        got = {(r.word, r.n) for r in spelling.word_counts(frame, slip).collect()}
        assert got == set(word_table(docs, slip).items())
    assert spelling.word_counts(frame.limit(0)).count() == 0


@pytest.mark.parametrize("cell,asks", [(8192, 65536), (7, 11)])
def test_variants_equal_brute_force(spark, cell, asks):
    """Random words, anagrams and chains, with cells that must be dealt out again."""
    rng = random.Random(3)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(6, 8))) for _ in range(150)}
    words |= {"".join(rng.sample("abcdefg", 7)) for _ in range(60)} | {"x" * 300, "x" * 299 + "y", "x" * 301}
    counts = {w: rng.choice([5, 6, 30, 150, 900]) for w in words}
    counts |= {"chaina": 5, "chainab": 25, "chainabc": 125, "chainabcd": 625}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(frame, 5, 64, cell, asks).toPandas().astype(object)
    got = got.where(got.notna(), None)
    rows = set(got[["word", "form", "root", "n", "n_near", "form_n"]].itertuples(index=False, name=None))
    assert rows == brute_variants(counts) and ("chaina", "chainab", "chainabcd", 5, 1, 25) in rows


def test_no_words_have_no_variants(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(none).collect() == []
    lone = spark.createDataFrame([("lonely", 7)], "word string, n long")
    assert [tuple(r) for r in spelling.variants(lone).collect()] == [("lonely", None, "lonely", 7, 0, None)]


def test_the_tree_reaches_every_word_one_edit_away():
    rng = np.random.default_rng(1)
    members = rng.integers(97, 102, (300, 6)).astype(np.uint8)
    for length in (6, 5):
        asked = rng.integers(97, 102, (80, length)).astype(np.uint8)
        got = set(zip(*map(np.ndarray.tolist, spelling.near_pairs(members, asked, 3))))
        want = {
            (q, m) for q, a in enumerate(asked) for m, b in enumerate(members) if spelling.one_edit(a[None], b[None])[0]
        }
        assert got == want and want


# Document fingerprints --------------------------------------------------------------------------


def test_spans_and_extensions_equal_slices():
    rng = random.Random(2)
    for _ in range(60):
        a, b = ("".join(rng.choice("aé𝄞") for _ in range(rng.randint(0, 30))) for _ in range(2))
        x, y = fingerprints.Prefixes(a), fingerprints.Prefixes(b)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        k = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))
        assert x.extension(i, y, j) == k
        k = next((k for k in range(min(i, j)) if a[i - k - 1] != b[j - k - 1]), min(i, j))
        assert x.extension_back(i, y, j) == k
        for n in range(4):
            if i + n <= len(a) and j + n <= len(b):
                assert x.same(i, y, j, n) == (a[i : i + n] == b[j : j + n])


def test_shared_passages_are_found_whole(spark):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, other = text(300), text(260)
    left, right = text(170) + "<" + shared + ">" + text(90) + "(" + other + ")", text(40) + "[" + other + "]" + text(500) + "{" + shared + "}"
    pairs = spark.createDataFrame([(1, left, 2, right), (3, "", 4, None)], "left_id long, left string, right_id long, right string")
    got = {(r.left_start, r.right_start, r.length) for r in fingerprints.passages(pairs, 100).collect()}
    assert got == {(left.index(shared), right.index(shared), 300), (left.index(other), right.index(other), 260)}


def test_fingerprints_by_blocks_equal_whole_arrays(monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdé ") for _ in range(2000))
    whole = fingerprints.fingerprint(fingerprints.code_points(text))
    monkeypatch.setattr(fingerprints, "BLOCK", 137)
    assert fingerprints.fingerprint(fingerprints.code_points(text)) == whole
    x, step = fingerprints.Prefixes(text), fingerprints._step(2000)
    n, _, starts, ends, _ = fingerprints._parts(whole)
    assert n == 2000 and [int(starts[k : k + 8], 16) for k in range(0, len(starts), 8)] == [x.span(0, s)[0] for s in range(step, 2001, step)]
    assert [int(ends[k : k + 8], 16) for k in range(0, len(ends), 8)] == [x.span(2000 - s, 2000)[0] for s in range(step, 2001, step)]


def test_likeness():
    like = lambda a, b: fingerprints.likeness(*(fingerprints.fingerprint(fingerprints.code_points(t)) for t in (a, b)))
    rng = random.Random(9)
    a, b = ("".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(2))
    assert like(a, a) == like("", None) == 1 and like(a, b) < 0.1 and like("", "a") == 0
    assert 0.6 < like(a, a[:2000] + b[:1000]) < 0.72 and 0.6 < like(a, b[:1000] + a[1000:]) < 0.72
    assert like(a, "z" + a[:1500] + "z" + a[1500:] + "z") > 0.8 and like(a, b) == like(b, a)


def edited_by_hand(docs):
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, a), (_, b) in zip(order, order[1:] + order[:1]):
        a, b = a or "", b or ""
        k = len(a) // 3
        text = a[: len(a) - k] + b[:k]
        out.append((i, len(a), hashlib.sha256(text.encode()).hexdigest(), fingerprints.fingerprint(fingerprints.code_points(text))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tasks", [1, 4, 40])
def test_edited_texts_take_the_beginning_of_the_next(spark, tasks):
    rng = random.Random(tasks)
    docs = [(7 * i, "".join(rng.choice("xyz ä𝄞") for _ in range(rng.choice([0, 1, 5, 40, 900])))) for i in range(30)] + [(1, None), (None, "none")]
    frame = spark.createDataFrame([(i, t, "s", "n") for i, t in docs], DOCS).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        got = fingerprints.edit_prints(frame).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.edited_fingerprint) for r in got), key=repr) == edited_by_hand(docs)
    own = dict(docs)
    assert all(r.fingerprint == fingerprints.fingerprint(fingerprints.code_points(own[r.doc_id])) for r in got)


def test_edited_texts_of_odd_tables(spark):
    one = spark.createDataFrame([(5, "abcdef", "s", "n")], DOCS)
    assert [(r.n_chars, r.near_next) for r in fingerprints.edit_prints(one).collect()] == [(6, 1.0)]
    assert fingerprints.edit_prints(one.limit(0)).count() == 0
    same = fingerprints.edit_prints(one.union(one).union(one)).collect()
    assert len(same) == 3 and len({tuple(r) for r in same}) == 1
    got = queries.op12_document_fingerprints(spark, FOLDER).toPandas()
    docs = common.table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    assert sorted(got["edited_sha256"]) == sorted(r[2] for r in edited_by_hand([tuple(r) for r in docs]))
    assert (got["near_edited"] > got["near_next"]).mean() > 0.95


# Whitening --------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["full", "diagonal", "equal", "low"])
@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
def test_leading_components_solve_the_eigenproblem(n, kind):
    rng = np.random.default_rng(n)
    a = rng.standard_normal((n, n))
    a = a @ a.T
    if kind == "diagonal":
        a = np.diag(np.arange(n) % 3 + 1.0)
    elif kind == "equal":
        q = np.linalg.qr(a)[0]
        a = q @ np.diag(np.repeat([3.0, 1.0], [n // 2, n - n // 2])) @ q.T
    elif kind == "low":
        b = rng.standard_normal((n, max(1, n // 4)))
        a = b @ b.T
    a, k = (a + a.T) / 2, min(16, n)
    values, vectors = whitening.leading(a, k)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], atol=1e-12 * abs(a).max())
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12) and np.allclose(a @ vectors, vectors * values, atol=1e-11 * abs(a).max())
    d, e, q = whitening.tridiagonal(a)
    assert np.allclose(q @ (np.diag(d) + np.diag(e, 1) + np.diag(e, -1)) @ q.T, a, atol=1e-12 * abs(a).max())
    for x in (values[0] + 1e-3, values[-1] - 1e-3):
        assert whitening.below(d, e, [x])[0] == (np.linalg.eigvalsh(a) < x).sum()


def by_hand(vectors):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    v = (fit - s / n).T @ (fit - s / n) / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ vectors / np.sqrt(values), values / np.trace(v)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((300, 20)) * np.linspace(1, 3, 20)
    rows = [(i, v.tolist(), "a") for i, v in enumerate(np.vstack([base, base[:50], base[:1].repeat(400, 0)]))]
    odd = [(901, None, "b"), (902, [float("nan")] * 20, "b"), (903, [float("inf")] * 20, "b"), (904, [None] * 20, "b"), (905, [1e300] * 20, "b"), (906, [], "b")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, n string")
    got = whitening.whiten(frame.repartition(7)).toPandas().sort_values(["vec_id", "component"])
    n, deviation, white, explained = by_hand([v for _, v, _ in rows])
    assert len(got) == 16 * len(rows) and set(got["n"]) == {n} == {300} and got["identity_error"].iloc[0] < 1e-9
    assert got["deviation"].to_numpy().reshape(-1, 16)[:, 0].tolist() == deviation.tolist()
    mine = got["whitened"].to_numpy().reshape(-1, 16)
    assert np.allclose(mine * np.sign((mine * white).sum(0)), white, atol=1e-9)
    assert np.allclose(got["explained"].to_numpy()[:16], explained, rtol=1e-12)


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], schema)).collect() == []
    two = spark.createDataFrame([(1, [1.0, 2.0]), (None, [3.0, 2.0]), (2, [1.0]), (3, [2.0])], schema)
    got = whitening.whiten(two).collect()  # each length has a fit of its own, and a constant entry no component
    assert sorted((r.vec_id or 0, r.component, r.n, r.deviation, round(abs(r.whitened), 9), r.explained) for r in got) == [
        (0, 1, 2, 128**2, 1.0, 1.0), (1, 1, 2, 128**2, 1.0, 1.0), (2, 1, 2, 64**2, 1.0, 1.0), (3, 1, 2, 64**2, 1.0, 1.0)
    ]


def test_deviations_beyond_a_long_are_null():
    own = whitening.Whitening(1 << 34, [0, 1 << 40], np.ones(1), np.ones((2, 1)), np.ones(1))
    assert own.deviations(np.array([[1 << 20, 0], [0, 64]])) == [None, 0]
    small = whitening.Whitening(3, [3, 6], np.ones(1), np.ones((2, 1)), np.ones(1))
    assert small.deviations(np.array([[1, 2], [2, 4]])) == [0, 9 + 36]


def test_registered_queries_cover_their_tables(spark):
    vectors = common.table(spark, FOLDER, "embeddings")
    got = queries.op13_embedding_whitening(spark, FOLDER)
    assert got.count() == 16 * vectors.count() and got.select("vec_id").distinct().count() == vectors.count()
    words = queries.op11_spelling_variants(spark, FOLDER)
    docs = [tuple(r) for r in common.table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    counts = word_table(docs, 199)
    assert {(r.word, r.n) for r in words.collect()} == set(counts.items())
    assert words.where(F.col("root") != F.col("word")).where("form is null").count() == 0
