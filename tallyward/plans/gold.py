"""The computed gold tables and the reports over them.

A dimension is joined after the facts have been reduced to its key wherever
the grain allows it. The join then has one row per key on each side, so a
provider or patient with a third of all claims is no skew, and attributes are
not carried through the fact shuffle. Joins carry no broadcast hint: Spark
broadcasts a dimension by its size and falls back to a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.expressions import MONEY, avg_stay_hours, exact_avg, exact_sum, month_of, percent, stay_seconds, tally
from tallyward.functions.fixed_values import (
    ALERT_SEVERITY,
    APPROVED,
    DENIED,
    HIGH_CHRONIC,
    HIGH_SPEND,
    LONG_STAY_HOURS,
    MEDIUM_CHRONIC,
    MEDIUM_SPEND,
    PENDING,
)
from tallyward.operators.history import current_rows
from tallyward.operators.hotkeys import ranked_descending



def _status(value: str):
    return F.col("claim_status") == value


def monthly_claims_summary(claims: DataFrame) -> DataFrame:
    return (
        claims.filter(F.col("claim_id").isNotNull())
        .groupBy(month_of("claim_date").alias("claim_month"), "payer_id")
        .agg(
            F.count("claim_id").alias("total_claims"),
            exact_sum("claim_amount").alias("total_amount"),
            exact_avg("claim_amount").alias("avg_claim_amount"),
            F.countDistinct("patient_id").alias("unique_patients"),
            F.countDistinct("provider_id").alias("unique_providers"),
            tally(_status(APPROVED)).alias("approved_count"),
            tally(_status(DENIED)).alias("denied_count"),
            tally(_status(PENDING)).alias("pending_count"),
        )
        .withColumn("approval_rate_pct", percent("approved_count", "total_claims"))
    )


def provider_performance(claims: DataFrame, providers: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """``hot`` lists crowded specialties, if there are any (see ``hotkeys``)."""
    per_provider = claims.groupBy("provider_id").agg(
        F.count("claim_id").alias("total_claims"),
        exact_sum("claim_amount").alias("total_billed"),
        exact_avg("claim_amount").alias("avg_claim_amount"),
        F.countDistinct("patient_id").alias("unique_patients"),
        tally(_status(APPROVED)).alias("approved_claims"),
        tally(_status(DENIED)).alias("denied_claims"),
    )
    return describe_providers(per_provider, providers, hot)


def describe_providers(per_provider: DataFrame, providers: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    attributes = providers.select("provider_id", "provider_name", "specialty", "network_status", "state")
    described = per_provider.join(attributes, "provider_id", "left").withColumn(
        "approval_rate_pct", percent("approved_claims", "total_claims")
    )
    return ranked_descending(described, "specialty", "total_billed", "specialty_rank", hot)


def risk_tier(spend: str, chronic: str):
    """Three tiers; an unknown chronic count leaves the decision to the spend."""
    s, c = F.col(spend), F.col(chronic)
    return (
        F.when((s >= HIGH_SPEND) | (c >= HIGH_CHRONIC), "HIGH")
        .when((s >= MEDIUM_SPEND) | (c >= MEDIUM_CHRONIC), "MEDIUM")
        .otherwise("LOW")
    )


def patient_risk_scores(claims: DataFrame, patients: DataFrame) -> DataFrame:
    per_patient = claims.groupBy("patient_id").agg(
        F.count("claim_id").alias("total_claims"),
        exact_sum("claim_amount").alias("total_spend"),
        exact_avg("claim_amount").alias("avg_claim_amount"),
        F.countDistinct("diagnosis_code").alias("unique_diagnoses"),
        F.countDistinct("provider_id").alias("unique_providers_seen"),
        F.max("claim_date").alias("last_claim_date"),
    )
    return describe_patients(per_patient, patients)


def describe_patients(per_patient: DataFrame, patients: DataFrame) -> DataFrame:
    now = current_rows(patients).select("patient_id", "first_name", "last_name", "insurance_plan", "chronic_conditions")
    return per_patient.join(now, "patient_id", "left").withColumn(
        "risk_tier", risk_tier("total_spend", "chronic_conditions")
    )


def diagnosis_trends(claims: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Monthly counts per code against the previous month that has claims."""
    per_month = claims.groupBy(month_of("claim_date").alias("claim_month"), "diagnosis_code").agg(
        F.count("claim_id").alias("claim_count"),
        F.countDistinct("patient_id").alias("patient_count"),
        exact_sum("claim_amount").alias("total_amount"),
        exact_avg("claim_amount").alias("avg_amount"),
    )
    # One row per month and code is left, so this window holds only months.
    by_month = Window.partitionBy("diagnosis_code").orderBy("claim_month")
    before = F.col("prev_month_count")
    labels = diagnoses.select(
        F.col("icd10_code").alias("diagnosis_code"),
        F.col("description").alias("diagnosis_description"),
        F.col("category").alias("diagnosis_category"),
        "chronic_flag",
    )
    return (
        per_month.withColumn("prev_month_count", F.lag("claim_count").over(by_month))
        .withColumn("mom_change_pct", percent(F.col("claim_count") - before, before))
        .join(labels, "diagnosis_code", "left")
    )


def er_dept_summary(admissions: DataFrame) -> DataFrame:
    stay = stay_seconds()
    return (
        admissions.filter(F.col("admission_id").isNotNull())
        .groupBy(month_of("admitted_at").alias("admit_month"), "department")
        .agg(
            F.count("admission_id").alias("total_admissions"),
            F.countDistinct("patient_id").alias("unique_patients"),
            avg_stay_hours().alias("avg_los_hours"),
            (F.max(stay) / F.lit(3600.0)).alias("max_los_hours"),
            F.avg("severity").alias("avg_severity"),
            tally(F.col("severity") >= ALERT_SEVERITY).alias("high_severity_count"),
            tally(stay > LONG_STAY_HOURS * 3600).alias("long_stay_over_24h"),
            tally(F.col("discharged_at").isNull()).alias("still_admitted"),
        )
        .withColumn("high_severity_pct", percent("high_severity_count", "total_admissions"))
    )


def network_utilization(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """The grain holds no provider but counts patients once, so claims are
    reduced to month, provider and patient before the provider is looked up."""
    network = providers.select("provider_id", "network_status", "specialty")
    reduced = claims.groupBy(month_of("claim_date").alias("claim_month"), "provider_id", "patient_id").agg(
        F.count("claim_id").alias("_claims"),
        F.count("claim_amount").alias("_amounts"),
        F.sum(F.col("claim_amount").cast(MONEY)).alias("_amount"),
    )
    total = F.sum("_amount").cast("double")
    return (
        reduced.join(network, "provider_id", "left")
        .groupBy("claim_month", "network_status", "specialty")
        .agg(
            F.sum("_claims").alias("claim_count"),
            total.alias("total_amount"),
            F.try_divide(total, F.sum("_amounts")).alias("avg_amount"),
            F.countDistinct("patient_id").alias("patient_count"),
        )
    )


def payer_denial_analysis(claims: DataFrame) -> DataFrame:
    denied, approved = _status(DENIED), _status(APPROVED)
    per_payer = claims.groupBy(month_of("claim_date").alias("claim_month"), "payer_id").agg(
        F.count("claim_id").alias("total_claims"),
        tally(denied).alias("denied_count"),
        exact_sum("claim_amount", denied).alias("denied_amount"),
        exact_sum("claim_amount", approved).alias("approved_amount"),
        F.countDistinct(F.when(denied, F.col("patient_id"))).alias("patients_with_denials"),
    )
    return rank_denials(per_payer)


def rank_denials(per_payer: DataFrame) -> DataFrame:
    # One row per month and payer is left, so this window holds only payers.
    worst_first = Window.partitionBy("claim_month").orderBy(F.col("denial_rate_pct").desc())
    return (
        per_payer.withColumn("denial_rate_pct", percent("denied_count", "total_claims"))
        .withColumn(
            "denied_amount_pct", percent(F.col("denied_amount"), F.col("denied_amount") + F.col("approved_amount"))
        )
        .withColumn("denial_rank", F.rank().over(worst_first).cast("bigint"))
    )


# Reports over the gold tables -------------------------------------------------


def latest_months(monthly: DataFrame, k: int = 5) -> DataFrame:
    picked = monthly.select("claim_month", "payer_id", "total_claims", "approval_rate_pct")
    return picked.orderBy(F.col("claim_month").desc(), "payer_id").limit(k)


def top_providers(performance: DataFrame, k: int = 5) -> DataFrame:
    picked = performance.select(
        "provider_id", "specialty", "total_claims", "approval_rate_pct", "specialty_rank", "total_billed"
    )
    return picked.orderBy(F.col("total_billed").desc(), "provider_id").limit(k)


def top_diagnoses(trends: DataFrame, k: int = 5) -> DataFrame:
    picked = trends.select("claim_month", "diagnosis_code", "diagnosis_description", "claim_count")
    return picked.orderBy(F.col("claim_count").desc(), "diagnosis_code", "claim_month").limit(k)


def risk_tier_rollup(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("risk_tier")
        .agg(F.count(F.lit(1)).alias("patient_count"), exact_avg("total_spend").alias("avg_spend"))
        .orderBy(F.col("avg_spend").desc())
    )


def department_rollup(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("department")
        .agg(F.sum("total_admissions").alias("admissions"), F.round(F.avg("avg_los_hours"), 1).alias("avg_los"))
        .orderBy(F.col("admissions").desc(), "department")
    )


def network_rollup(utilization: DataFrame) -> DataFrame:
    return utilization.groupBy("network_status").agg(
        F.sum("claim_count").alias("claims"),
        F.round(exact_sum("total_amount") / 1e6, 2).alias("total_amount_m"),
    )


def payer_rollup(denials: DataFrame) -> DataFrame:
    return (
        denials.groupBy("payer_id")
        .agg(
            F.sum("total_claims").alias("claims"),
            F.round(exact_avg("denial_rate_pct"), 2).alias("avg_denial_rate"),
        )
        .orderBy(F.col("avg_denial_rate").desc(), "payer_id")
    )


def claim_stats(trends: DataFrame) -> DataFrame:
    """Claim totals per diagnosis code, to ground answers in the data."""
    return trends.groupBy("diagnosis_code").agg(
        F.sum("claim_count").alias("total_claims"),
        F.round(exact_sum("total_amount") / 1e6, 2).alias("total_amount_m"),
        F.round(F.try_divide(F.sum(F.col("avg_amount").cast("decimal(28,8)")).cast("double"), F.count("avg_amount")), 0).alias("avg_claim_amount"),
    )


def row_counts(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """Rows per table; with targets, whether each reaches 99 % of its target."""
    lines = None
    for name, df in tables.items():
        target = F.lit((expected or {}).get(name)).cast("bigint")
        line = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            target.alias("expected"),
            F.when(F.col("row_count") >= F.coalesce(target * 0.99, F.lit(1)), "OK").otherwise("LOW").alias("status"),
        )
        lines = line if lines is None else lines.unionByName(line)
    return lines
