"""Star schema: date, flag and procedure dimensions and the two fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.fixed_values import DENIED, OUT_OF_NETWORK
from tallyward.operators.history import START, version_at

HIGH_COST = 50_000
FLAGS = ["is_denied", "is_out_of_network", "is_high_cost"]


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def dim_date(span: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of a one-row frame."""
    days = span.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))
    return days.select(
        date_key(F.col("day")).alias("date_key"),
        "day",
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        F.weekday("day").alias("weekday"),
        (F.weekday("day") >= 5).alias("is_weekend"),
    )


def date_span(claims: DataFrame) -> DataFrame:
    return claims.agg(F.min("claim_date").alias("first_day"), F.max("claim_date").alias("last_day"))


def flag_key(denied: Column, outside: Column, costly: Column) -> Column:
    """Key of a flag combination: its bits, so a fact needs no lookup."""
    bit = lambda c, n: F.coalesce(c, F.lit(False)).cast("int") * n
    return bit(denied, 4) + bit(outside, 2) + bit(costly, 1)


def claim_flags(network_status: Column) -> list[Column]:
    return [
        F.col("claim_status") == DENIED,
        network_status == OUT_OF_NETWORK,
        F.col("claim_amount") >= HIGH_COST,
    ]


def flagged_claims(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Flag keys with their numbers of claims. Claims are reduced to provider,
    denial and cost before the provider's network is looked up."""
    denied, _, costly = claim_flags(F.lit(None))
    reduced = claims.groupBy("provider_id", denied.alias("_denied"), costly.alias("_costly")).agg(
        F.count(F.lit(1)).alias("claim_count")
    )
    joined = reduced.join(providers.select("provider_id", "network_status"), "provider_id", "left")
    outside = F.col("network_status") == OUT_OF_NETWORK
    return joined.select(flag_key(F.col("_denied"), outside, F.col("_costly")).alias("flag_key"), "claim_count")


def dim_claim_flags(counted: DataFrame) -> DataFrame:
    """The flag combinations in use, with the claims that carry each."""
    k = F.col("flag_key")
    return counted.groupBy("flag_key").agg(F.sum("claim_count").alias("claim_count")).select(
        "flag_key",
        (k.bitwiseAND(4) > 0).alias(FLAGS[0]),
        (k.bitwiseAND(2) > 0).alias(FLAGS[1]),
        (k.bitwiseAND(1) > 0).alias(FLAGS[2]),
        "claim_count",
    )


def all_claim_flags(spark) -> DataFrame:
    """All eight combinations of three flags."""
    k = F.col("id")
    return spark.range(8).select(
        k.cast("int").alias("flag_key"),
        *[(k.bitwiseAND(bit) > 0).alias(f) for f, bit in zip(FLAGS, (4, 2, 1), strict=True)],
    )


def dim_procedure(claims: DataFrame) -> DataFrame:
    return claims.groupBy("procedure_code").agg(
        F.count(F.lit(1)).alias("claim_count"), F.min("claim_date").alias("first_used")
    )


def fact_claims(
    claims: DataFrame, patients: DataFrame, providers: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Claims with their dimension keys.

    The patient key is the version valid on the claim date. Provider,
    diagnosis and procedure are keyed by their business key.
    """
    valid = version_at(
        claims.select(
            "claim_id", "patient_id", "provider_id", "diagnosis_code", "procedure_code", "claim_date",
            "claim_amount", "claim_status",
        ),
        patients.select("patient_id", F.col("event_no").alias("patient_version"), "insurance_plan", "event_no", START),
        ["patient_id"],
        "claim_date",
        attach=["patient_version", "insurance_plan"],
        tie=["event_no"],
        hot=hot,
    )
    network = providers.select("provider_id", "network_status")
    return valid.join(network, "provider_id", "left").select(
        "claim_id",
        date_key(F.col("claim_date")).alias("date_key"),
        "patient_id",
        "patient_version",
        "insurance_plan",
        "provider_id",
        "diagnosis_code",
        "procedure_code",
        flag_key(*claim_flags(F.col("network_status"))).alias("flag_key"),
        "claim_amount",
    )


def fact_er_admissions(admissions: DataFrame, diagnoses: DataFrame, providers: DataFrame) -> DataFrame:
    """Admissions on the shared dimensions; unknown members get the key '-1'."""
    known_d = diagnoses.select(F.col("icd10_code").alias("diagnosis_code"), F.lit(True).alias("_d"))
    known_p = providers.select("provider_id", F.lit(True).alias("_p"))
    return (
        admissions.join(known_d, "diagnosis_code", "left")
        .join(known_p, "provider_id", "left")
        .select(
            "admission_id",
            date_key(F.col("admitted_at")).alias("date_key"),
            "patient_id",
            F.when(F.col("_p"), F.col("provider_id")).otherwise("-1").alias("provider_id"),
            F.when(F.col("_d"), F.col("diagnosis_code")).otherwise("-1").alias("diagnosis_code"),
            "department",
            "severity",
            "los_hours",
        )
    )
