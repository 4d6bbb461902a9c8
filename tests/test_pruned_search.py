import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from tallyward.operators import pruned_search
from tallyward.operators.pruned_search import InvertedFile


def vectors(spark, x, name):
    return spark.createDataFrame([(f"{name}{i:03d}", v.tolist()) for i, v in enumerate(x)], f"{name} STRING, v ARRAY<DOUBLE>")


def brute(index, asked, k):
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    scores = np.round(unit(asked) @ unit(index).T, 9) + 0.0
    return {
        (f"q{q:03d}", f"k{i:03d}", rank + 1)
        for q, s in enumerate(scores) for rank, i in enumerate(sorted(range(len(s)), key=lambda i: (-s[i], i))[:k])
    }


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_the_answers_are_those_of_comparing_all(spark, spread, monkeypatch):
    """Grouped and evenly spread vectors, equal ones and a zero, cells cut into parts."""
    monkeypatch.setattr(pruned_search, "ROWS", 40)
    monkeypatch.setattr(pruned_search, "ASKS", 5)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 8))
    index = centres[rng.integers(0, 12, 400)] + spread * rng.standard_normal((400, 8))
    index[5] = index[6] = index[7]
    index[9] = 0
    asked = np.vstack([index[rng.integers(0, 400, 20)] + 0.01, np.zeros((1, 8))])
    built = InvertedFile.build(vectors(spark, index, "k"), "k", "v", cells=20, sample=200)
    got = built.search(vectors(spark, asked, "q"), "q", "v", 4).toPandas()
    assert set(zip(got["q"], got["k"], got["rank"])) == brute(index, asked, 4)
    scored = got[got["q"] != "q020"].groupby("q")["scored"].first()
    assert scored.max() <= 400
    if spread < 1:
        assert scored.mean() < 100  # a quarter of all at most


def test_odd_rows(spark):
    index = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None), ("c", [float("nan"), 1.0]), ("d", [0.0, 2.0])], "k STRING, v ARRAY<DOUBLE>")
    asked = spark.createDataFrame([(1, [1.0, 0.1]), (2, None), (3, [1.0])], "q INT, v ARRAY<DOUBLE>")
    built = InvertedFile.build(index, "k", "v")
    assert [(r.q, r.k, r["rank"]) for r in built.search(asked, "q", "v", 9).orderBy("rank").collect()] == [(1, "a", 1), (1, "d", 2)]
    with pytest.raises(ValueError):
        InvertedFile.build(index.unionByName(asked.selectExpr("'x' AS k", "v")), "k", "v")
    nothing = InvertedFile.build(index.limit(0), "k", "v")
    assert nothing.search(asked, "q", "v", 2).collect() == []


def test_a_question_travels_once_to_each_part(spark, monkeypatch):
    """Vectors that no bound excludes: 20 cells are one part, and not 20 copies of each question."""
    kept, stored_copy = {}, pruned_search.stored_copy
    monkeypatch.setattr(pruned_search, "stored_copy", lambda df, name: kept.setdefault(name, stored_copy(df, name)))
    rng = np.random.default_rng(5)
    index, asked = rng.standard_normal((200, 64)), rng.standard_normal((6, 64))
    built = InvertedFile.build(vectors(spark, index, "k"), "k", "v", cells=20)
    got = built.search(vectors(spark, asked, "q"), "q", "v", 3).toPandas()
    assert set(zip(got["q"], got["k"], got["rank"])) == brute(index, asked, 3) and (got["scored"] <= 200).all()
    assert kept["pruned-found"].filter("k IS NULL").count() <= 2 * 6


def test_questions_meet_each_part_once_and_vectors_keep_their_type(spark, monkeypatch):
    """Float vectors that no bound excludes, in several parts."""
    kept, stored_copy = {}, pruned_search.stored_copy
    monkeypatch.setattr(pruned_search, "stored_copy", lambda df, name: kept.setdefault(name, stored_copy(df, name)))
    monkeypatch.setattr(pruned_search, "ROWS", 100)
    rng = np.random.default_rng(6)
    index, asked = (rng.standard_normal((n, 64)).astype(np.float32) for n in (400, 12))
    frame = lambda x, name: vectors(spark, x, name).selectExpr(name, "CAST(v AS ARRAY<FLOAT>) AS v")
    built = InvertedFile.build(frame(index, "k"), "k", "v", cells=20)
    got = built.search(frame(asked, "q"), "q", "v", 3).toPandas()
    assert set(zip(got["q"], got["k"], got["rank"])) == brute(index.astype(float), asked.astype(float), 3)
    assert (got["scored"] == 400).all()
    assert kept["pruned-found"].filter("scored > 0").count() == 12 * len(built._stretches(100)[1])
    for stored in (spark.read.parquet(built.folder), kept["pruned-questions"], kept["pruned-first"]):
        assert stored.schema["_v"].dataType.simpleString() == "array<float>"


def test_a_part_is_as_large_as_its_vectors_allow(spark, monkeypatch):
    kept, stored_copy = {}, pruned_search.stored_copy
    monkeypatch.setattr(pruned_search, "stored_copy", lambda df, name: kept.setdefault(name, stored_copy(df, name)))
    made = spark.range(30_000).selectExpr("id AS k", "transform(sequence(1, 16), i -> CAST(pmod(xxhash64(id, i), 2001) - 1000 AS FLOAT)) AS v")
    found = InvertedFile.build(made, "k", "v").search(made.limit(5).selectExpr("k AS q", "v"), "q", "v", 1).collect()
    assert all(r.q == r.k and r.score == 1 for r in found) and len(found) == 5
    assert kept["pruned-found"].filter("scored > 0").count() == 5  # one part holds all
    wide = InvertedFile("", "k", np.zeros((1, 1536)), *[np.zeros(1)] * 3)
    for kind, size in ((FloatType(), 4), (DoubleType(), 8)):
        most = wide._fitting(pruned_search.ROWS, ArrayType(kind))
        assert 0.99 < most * 1536 * size / (pruned_search.ROWS * pruned_search.WIDTH) <= 1


def test_numbers_that_are_not_finite_hide_no_others(spark):
    index = [("a", [1.0, 0.0]), ("b", [float("inf"), 0.0]), ("c", [0.5, 0.5]), (None, [1.0, 0.2]), ("d", [0.0, 1.0])]
    asked = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.0, float("inf")])], "q INT, v ARRAY<DOUBLE>")
    built = InvertedFile.build(spark.createDataFrame(index, "k STRING, v ARRAY<DOUBLE>"), "k", "v", cells=1)
    assert [(r.q, r.k, r["rank"]) for r in built.search(asked, "q", "v", 3).orderBy("rank").collect()] == [(1, "a", 1), (1, "c", 2), (1, "d", 3)]


def test_vectors_of_other_lengths_are_refused_not_mixed():
    with pytest.raises(ValueError):
        pruned_search._matrix(pa.array([[1.0, 2.0], [3.0, 4.0, 5.0, 6.0], [7.0, 8.0, 9.0]]), 3)
