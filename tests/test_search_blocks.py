import numpy as np
from pyspark.sql import functions as F

from tallyward.operators import search


def test_many_questions_do_not_multiply_the_index(spark):
    index = spark.range(10).select(F.col("id").alias("k"), F.array(F.col("id").cast("double")).alias("v"))
    asked = spark.range(200_000).select(F.col("id").alias("q"), F.array(F.lit(1.0)).alias("w"))
    sent = search._dealt(index, "k", "v", "_shard", search.SHARD_ROWS, asked, "_block", search.BLOCK_QUESTIONS)
    assert sent.count() <= 10 * search.SPREAD


def test_float_vectors_travel_as_floats(spark):
    index = spark.createDataFrame([(1, [1.0, 0.5])], "k INT, v ARRAY<FLOAT>")
    sent = search._dealt(index, "k", "v", "_shard", 10, index, "_block", 10)
    assert sent.schema["v"].dataType.simpleString() == "array<float>"


def test_rough_products_lose_nothing():
    """Copies, a zero and scores that differ in the eighth digit, over several stretches."""
    rng = np.random.default_rng(3)
    x = search.unit_rows(rng.standard_normal((900, 16)))
    x[200:400] = x[100]
    x[500:600] = search.unit_rows(x[499] + 1e-8 * rng.standard_normal((100, 16)))
    x[700] = 0
    asked = np.vstack([x[[100, 499, 550, 700, 3]], search.unit_rows(rng.standard_normal((40, 16)))])
    kept = search.without_copies(x, 4)
    assert len(kept) == 900 - 197
    rows = x[kept]
    near = search.Nearest(asked, rows, rows.astype(np.float32), np.arange(len(rows)), 4)
    for low in range(0, len(rows), 64):
        near.offer(low, min(low + 64, len(rows)))
    q, row, score = near.found()
    want = np.round(asked @ x.T, 9) + 0.0
    best = {(i, int(j)) for i, s in enumerate(want) for j in np.lexsort((np.arange(900), -s))[:4]}
    assert set(zip(q.tolist(), kept[row].tolist())) == best
    assert np.abs(score - want[q, kept[row]]).max() < 2e-9


def test_infinite_numbers_give_no_hits(spark):
    index = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [float("inf"), 0.0])], "k STRING, v ARRAY<DOUBLE>")
    asked = spark.createDataFrame([(1, [1.0, 0.1])], "q INT, w ARRAY<DOUBLE>")
    assert [r.k for r in search.similarity_topk(index, "k", "v", asked, "q", "w", 5).collect()] == ["a"]


def test_hashed_vectors_are_built_once_per_text(spark):
    counts = spark.createDataFrame([(1, 0, 2), (1, 255, 1), (None, 3, 1)], "k INT, dim INT, tf LONG")
    weights = spark.createDataFrame([(0, 0.5), (255, 2.0), (3, 1.0)], "dim INT, idf DOUBLE")
    made = search.hashed_vectors(counts, weights, "k")
    got = {r.k: {i: x for i, x in enumerate(r.embedding) if x} for r in made.collect()}
    assert got == {1: {0: 1.0, 255: 2.0}, None: {3: 1.0}} and len(made.first().embedding) == 256
    assert "map_from_entries" not in made._jdf.queryExecution().optimizedPlan().toString()
