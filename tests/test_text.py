import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.operators import enrich, hotkeys, search

DIM = "icd10_code STRING, description STRING, category STRING, chronic_flag BOOLEAN, ai_description STRING"


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [("A", "asthma", "Resp", True, None), ("B", "break", "Inj", False, "curated"), ("C", "cold", "Resp", False, None)], DIM
    )


def test_curated_text_is_kept_and_wording_follows_the_flag(dim):
    got = {r["icd10_code"]: r["ai_description"] for r in enrich.write_back(dim, enrich.describe_pending(dim)).collect()}
    assert got["B"] == "curated" and "chronic condition A" in got["A"] and "acute condition C" in got["C"]


def test_failed_answers_stay_pending(dim):
    def flaky(batch):
        return [None if "asthma" in p else "ok" for p in batch]

    after = enrich.write_back(dim, enrich.describe_pending(dim, flaky))
    assert [r["icd10_code"] for r in enrich.pending(after).collect()] == ["A"]
    assert tuple(enrich.coverage(after).first()) == (3, 2, 1, 66.7)


def test_timeouts_are_tried_again_and_errors_are_not():
    calls = []

    def slow(batch):
        calls.append(len(batch))
        if len(calls) < 3:
            raise TimeoutError
        return ["ok"] * len(batch)

    assert enrich._ask(slow, ["a", "b"], 3, 0.0) == ["ok", "ok"] and len(calls) == 3
    calls.clear()
    assert enrich._ask(slow, ["a"], 2, 0.0) == [None] and len(calls) == 2

    def broken(batch):
        calls.append(1)
        raise RuntimeError

    calls.clear()
    assert enrich._ask(broken, ["a"], 3, 0.0) == [None] and len(calls) == 1


def test_batches_stay_small(spark):
    def sizes(batch):
        return [str(len(batch))] * len(batch)

    got = enrich.ask_model(spark.range(0, 25, 1, 1).toDF("n"), F.lit("p"), sizes, "size").collect()
    assert sorted(r["size"] for r in got) == ["10"] * 20 + ["5"] * 5


def test_answers_that_are_not_json_give_nulls(dim):
    got = enrich.explain(dim, lambda batch: ["no json"] * len(batch)).collect()
    assert all(r["plain_english"] is None for r in got) and len(got) == 2


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_claim_documents_keep_every_claim_in_order(spark, hot_rows):
    from datetime import date, timedelta

    rows = [("p" if i % 4 else "q", f"c{i:03}", date(2024, 1, 1) + timedelta(days=i % 9), "d", float(i), "PENDING") for i in range(60)]
    df = spark.createDataFrame(rows, "patient_id STRING, claim_id STRING, claim_date DATE, diagnosis_code STRING, claim_amount DOUBLE, claim_status STRING")
    parts = enrich.claim_documents(df, per_part=7, hot=hotkeys.hot_keys(df, ["patient_id"], hot_rows)).orderBy("patient_id", "part").collect()
    assert max(r["claim_count"] for r in parts) == 7
    for patient in "pq":
        seen = [c["claim_amount"] for r in parts if r["patient_id"] == patient for c in json.loads(r["claims_json"])]
        want = sorted((r for r in rows if r[0] == patient), key=lambda r: (r[2], r[1]))
        assert seen == [r[4] for r in want]


def brute_force(index, questions, k):
    out = []
    for q, qv in questions:
        scored = []
        for key, v in index:
            a, b = np.array(v), np.array(qv)
            bottom = np.linalg.norm(a) * np.linalg.norm(b)
            scored.append((-round(float(a @ b / bottom), 9) if bottom else 0.0, key))
        out += [(q, key, rank) for rank, (_, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks, shards", [(3, 50), (1000, 10**6)])
def test_search_matches_brute_force(spark, rows, blocks, shards):
    rng = np.random.default_rng(3)
    index = [(f"k{i:03}", rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(200)]  # many equal scores
    questions = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(9)]
    got = search.similarity_topk(
        spark.createDataFrame(index, "key STRING, v ARRAY<FLOAT>").repartition(5), "key", "v",
        spark.createDataFrame(questions, "q INT, qv ARRAY<DOUBLE>"), "q", "qv", 6, blocks, shards,
    )
    assert rows(got, "q", "key", "rank") == brute_force(index, questions, 6)


def test_search_of_unsound_vectors_has_no_hits(spark, rows):
    index = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None), ("c", [1.0])], "key STRING, v ARRAY<FLOAT>")
    asked = spark.createDataFrame([(1, [1.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [2.0])], "q INT, qv ARRAY<DOUBLE>")
    hits = search.similarity_topk(index, "key", "v", asked, "q", "qv", 3)
    assert rows(hits, "q", "key", "rank") == [(1, "a", 1), (4, "c", 1)]
    texts = asked.withColumn("t", F.lit("why?"))
    prompts = search.context_prompts(hits, index.select("key", F.col("key").alias("line")), "key", F.col("line"), texts, "q", "t")
    assert rows(prompts, "q", "context_docs") == [(1, 1), (2, 0), (3, 0), (4, 1)]


def test_search_without_questions_is_empty(spark):
    index = spark.createDataFrame([("k", [1.0])], "key STRING, v ARRAY<FLOAT>")
    none = spark.createDataFrame([], "q INT, qv ARRAY<DOUBLE>")
    assert search.similarity_topk(index, "key", "v", none, "q", "qv").collect() == []


def test_text_vectors_find_the_text_itself(spark):
    texts = ["heart failure with low output", "type two diabetes", "low back pain", "heart rhythm", "skin rash"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc INT, text STRING")
    fitted = search.fit_text_vectors(docs, "text")
    vectors = search.embed_text(fitted, docs)
    hits = search.similarity_topk(vectors, "doc", "embedding", vectors.select(F.col("doc").alias("q"), "embedding"), "q", "embedding", 1)
    assert all(r["q"] == r["doc"] and r["score"] == pytest.approx(1, abs=1e-6) for r in hits.collect())


def test_sync_embeds_only_what_changed(spark, rows):
    source = spark.createDataFrame([("a", "same"), ("b", "new text"), ("c", "added"), ("e", None)], "k STRING, t STRING")
    index = spark.createDataFrame([("a", "same"), ("b", "old text"), ("d", "gone")], "k STRING, t STRING").select(
        "k", F.md5("t").alias("text_hash"), F.col("t").alias("vec")
    )
    plan = search.sync_plan(index, source, "k", "t")
    assert rows(plan, "k", "action") == [("b", "update"), ("c", "insert"), ("d", "delete")]
    after = search.apply_sync(index, plan.withColumn("vec", F.col("t")), "k")
    assert rows(after, "k", "vec") == [("a", "same"), ("b", "new text"), ("c", "added")]
    assert search.sync_plan(after, source, "k", "t").count() == 0


def test_context_follows_rank_and_allows_missing_statistics(spark):
    hits = spark.createDataFrame([(1, "b", 0.9, 1), (1, "a", 0.8, 2)], "q INT, k STRING, score DOUBLE, rank INT")
    docs = spark.createDataFrame([("a", "alpha"), ("b", "beta")], "k STRING, t STRING")
    questions = spark.createDataFrame([(1, "why?")], "q INT, text STRING")
    stats = spark.createDataFrame([("a", 3)], "k STRING, n INT")
    r = search.context_prompts(hits, docs, "k", F.col("t"), questions, "q", "text", stats, F.concat("k", F.lit("="), F.col("n").cast("string"))).first()
    assert r["context_docs"] == 2
    assert r["prompt"].index("- beta\n- alpha") < r["prompt"].index("a=3") < r["prompt"].index("why?")
    bare = search.context_prompts(hits, docs, "k", F.col("t"), questions, "q", "text").first()
    assert "- beta\n- alpha" in bare["prompt"]
