"""A training corpus from raw documents, in stages that each read what the one before has written.

Each stage takes ``documents`` (doc_id, text and any other columns; names that a
stage uses inside do not clash with them) and, but for the last, returns the
same columns. NULL, empty and very long texts, repeated rows and empty tables go
through every stage as its operator defines. The stages are written to the
shared folder, so one that fails is run again from its input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyward.llm import bpe, common, mixing, pii, quality_rules, simhash
from tallyward.session import shared_folder


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail the base rules, or whose lines are mostly boilerplate by the chain fitted on ``labels``."""
    chain = quality_rules.train(docs, common.table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, chain)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest doc_id, of each group of near copies. Rows without doc_id stay."""
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and secrets in the text by their kind. Every row stays; NULL stays NULL."""
    return pii.mask(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; sources below the largest are repeated towards equal shares, at most twice."""
    return mixing.mix(docs, mixing.Target(entropy=0.97, repeats=2.0))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ends the pipeline: number and digest of the tokens of every row, and of the text they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", filter_quality),
    ("near_dedup", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("source_mixing", mix_sources),
    ("byte_pair_encoding", encode_tokens),
]

#: No SQL: trained models, fingerprints and tokenizers are checked by brute force in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
