"""The batch life cycle: bronze, quarantine, silver, dimensions, seven gold tables.

Every step is written before the next one reads it, so the silver claims are
deduplicated once for all gold tables, and a lost executor costs a task and not
the chain. Tables are clustered by their reporting columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyward.operators import keyed, layout, quality
from tallyward.operators.quality import RuleSet
from tallyward.operators.versions import VersionTable
from tallyward.plans import gold
from tallyward.streaming import sinks
from tallyward.streaming.sources import csv_stream

CLUSTERED = {
    "monthly_claims_summary": ["claim_month", "payer_id"],
    "provider_performance": ["specialty", "provider_id"],
    "patient_risk_scores": ["patient_id"],
    "diagnosis_trends": ["claim_month", "diagnosis_code"],
    "er_dept_summary": ["admit_month", "department"],
    "network_utilization": ["claim_month", "specialty"],
    "payer_denial_analysis": ["claim_month", "payer_id"],
}


def run(
    spark: SparkSession,
    bronze: DataFrame,
    admissions: DataFrame,
    dims: dict[str, DataFrame],
    folder: str,
    as_of: str,
) -> dict[str, str]:
    """Write all tables under ``folder`` and return their paths by name.

    ``dims`` holds providers, patients and diagnoses; ``as_of`` is the SQL date
    that claim dates may not exceed.
    """
    paths: dict[str, str] = {}

    def put(df: DataFrame, name: str, cluster: list[str] | None = None) -> DataFrame:
        paths[name] = f"{folder}/{name}"
        if cluster:
            layout.write_clustered(df, paths[name], cluster)
        else:
            df.write.mode("overwrite").parquet(paths[name])
        return spark.read.parquet(paths[name])

    raw = put(bronze, "claims_raw")
    rules = RuleSet.claims(as_of)
    put(quality.quarantine(raw, rules, "claim_id"), "claims_quarantine")
    passing = quality.apply_rules(raw, rules)
    silver = put(keyed.dedup_latest(passing, ["claim_id"], ["_ingest_ts", "claim_amount"]), "claims_fact")
    stays = put(admissions, "er_admissions_silver")
    held = {name: put(df, name) for name, df in dims.items()}
    tables = {
        "monthly_claims_summary": gold.monthly_claims_summary(silver),
        "provider_performance": gold.provider_performance(silver, held["providers"]),
        "patient_risk_scores": gold.patient_risk_scores(silver, held["patients"]),
        "diagnosis_trends": gold.diagnosis_trends(silver, held["diagnoses"]),
        "er_dept_summary": gold.er_dept_summary(stays),
        "network_utilization": gold.network_utilization(silver, held["providers"]),
        "payer_denial_analysis": gold.payer_denial_analysis(silver),
    }
    for name, df in tables.items():
        put(df.withColumn("_updated_ts", F.current_timestamp()), name, CLUSTERED[name])
    return paths


@dataclass(frozen=True)
class Feed:
    """CSV files that land in a folder, and how their rows are keyed and ordered."""

    landing: str
    schema: StructType
    keys: list[str]
    sequence: list[str]
    track: list[str] | None = None


def load_landed(spark: SparkSession, claims: Feed, providers: Feed, patients: Feed, folder: str, as_of: str) -> dict[str, DataFrame]:
    """From landed files to silver: what is new in the landing folders is read
    once, and the tables under ``folder`` are brought up to it.

    Claims pass the rules or go to quarantine; providers are kept by type 1,
    patients by type 2. The three streams run together, each with a checkpoint
    of its own, so a run that was stopped goes on where it was. Claims are
    deduplicated when they are read, as a later load may bring a newer row.
    """
    def rows(feed: Feed) -> DataFrame:
        return csv_stream(spark, feed.landing, feed.schema).select(*feed.schema.names)

    at = lambda name: f"{folder}/{name}"
    table = VersionTable(at("patient_versions"), patients.keys, patients.sequence, patients.track or [])
    streams = [
        sinks.split_stream(rows(claims), RuleSet.claims(as_of), claims.keys[0], at("claims"), at("quarantine"), at("claims_at")),
        sinks.scd1_stream(rows(providers), at("providers"), at("providers_at"), providers.keys, providers.sequence, fold_every=8),
        sinks.versioned_stream(rows(patients), at("patients"), at("patients_at"), table),
    ]
    for stream in streams:
        stream.awaitTermination()
    passed = sinks.stored(spark, at("claims")).drop(sinks.BATCH)
    return {
        "claims": keyed.dedup_latest(passed, claims.keys, claims.sequence),
        "quarantine": sinks.stored(spark, at("quarantine")).drop(sinks.BATCH),
        "providers": sinks.scd1_state(spark, at("providers"), providers.keys, providers.sequence),
        "patients": sinks.versioned_state(spark, at("patients"), table),
    }
