"""Registered queries of the training-data operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import (
    bpe,
    common,
    embed_dedup,
    fingerprints,
    langid,
    license_scan,
    mixing,
    ordinal,
    pii,
    quality_rules,
    simhash,
    spelling,
    toxicity,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 poor, 1 good but toxic, 2 good. Documents of probable grade 1 or 2 are kept."""
    docs = common.documents(spark, sf_dir)
    grade = F.col("quality") * (2 - F.coalesce("toxic", F.lit(0)))
    return ordinal.rate(docs, ordinal.train(docs, common.table(spark, sf_dir, "labels"), grade))


@query
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return pii.find(docs, pii.train(docs))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir, "lang")
    held_out = common.fold(F.col("doc_id"), 4) == 2
    return langid.identify(docs, langid.train(docs, ~held_out), held_out)


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.documents(spark, sf_dir))


@query
def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir, "source")
    tokens = docs.select(F.sum(mixing.word_count(F.col("text")))).first()[0] or 0
    return mixing.mixture(docs, mixing.Target(entropy=0.97, repeats=4.0, budget=tokens))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return license_scan.scan(docs, license_scan.rare_index(license_scan.word_frequencies(docs)))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    chain = quality_rules.train(docs, common.table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, chain)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    held_out = common.fold(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model, held_out)


#: All pairs, and what each vector reaches through them. Only for small tables.
ORACLES["op9_embedding_near_dedup"] = """
    WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
        WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
    reach AS (SELECT vec_id AS node, vec_id AS root FROM v UNION SELECT b, root FROM reach JOIN links ON a = node),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
    least AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
    FROM embeddings LEFT JOIN counted ON a = vec_id LEFT JOIN least ON node = vec_id"""


@query
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op10_byte_pair_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(common.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(common.documents(spark, sf_dir), slip=199))


@query
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_prints(common.documents(spark, sf_dir))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
