"""Gold tables that are declared by schema only; the definitions are ours.

Facts shrink to the reporting grain first and dimensions are joined after.
``as_of`` dates are arguments, so a run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.expressions import exact_avg, exact_sum, percent, quarter_label, tally
from tallyward.functions.fixed_values import APPROVED, DENIED, OUT_OF_NETWORK
from tallyward.operators import hotkeys
from tallyward.operators.history import current_rows

READMISSION_DAYS = 30
TRAILING_DAYS = 365
MEMBERS_PER_PROVIDER = 50.0
PREVENTABLE_SEVERITY = 2


def _month_label(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def _adjudication_days() -> Column:
    """Days from the claim to its load, the only processing dates at hand."""
    return F.datediff(F.to_date("_ingest_ts"), F.col("claim_date"))


def provider_performance_monthly(claims: DataFrame, providers: DataFrame) -> DataFrame:
    days = _adjudication_days()
    per_month = claims.groupBy("provider_id", _month_label("claim_date").alias("report_month")).agg(
        F.count("claim_id").alias("total_claims"),
        tally(F.col("claim_status") == APPROVED).alias("approved_claims"),
        tally(F.col("claim_status") == DENIED).alias("denied_claims"),
        exact_avg("claim_amount").alias("avg_claim_amount"),
        F.avg(days).alias("avg_processing_days"),
    )
    outside = F.when(F.col("network_status").isNotNull(), (F.col("network_status") == OUT_OF_NETWORK).cast("double"))
    labels = providers.select("provider_id", "provider_name", "specialty", outside.alias("out_of_network_rate"))
    return per_month.withColumn("denial_rate", F.try_divide("denied_claims", "total_claims")).join(
        labels, "provider_id", "left"
    )


def readmissions(admissions: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Each admission with the next one of the patient and whether that one
    falls within 30 days of the discharge."""
    cut = hotkeys.cut_hot_keys(
        admissions.filter(F.col("patient_id").isNotNull() & F.col("admitted_at").isNotNull()),
        ["patient_id"],
        ["admitted_at", "admission_id"],
        hot,
    )
    seen = hotkeys.neighbours(cut, ["patient_id"], ["admitted_at", "admission_id"], ["admitted_at"], after="_next")
    following = F.col("_next.admitted_at")
    soon = following <= F.col("discharged_at") + F.expr(f"INTERVAL {READMISSION_DAYS} DAYS")
    return seen.select(
        "patient_id",
        "admission_id",
        "admitted_at",
        "discharged_at",
        following.alias("next_admitted_at"),
        F.coalesce(soon, F.lit(False)).alias("readmitted"),
    )


def risk_tier_four(spend: Column, chronic: Column, visits: Column) -> Column:
    points = (
        F.when(spend >= 10_000, 1).otherwise(0)
        + F.when(chronic >= 3, 1).otherwise(0)
        + F.when(visits >= 3, 1).otherwise(0)
    )
    return F.when(points == 3, "CRITICAL").when(points == 2, "HIGH").when(points == 1, "MEDIUM").otherwise("LOW")


def patient_risk_score(claims: DataFrame, patients: DataFrame, admissions: DataFrame, as_of: str) -> DataFrame:
    day = F.lit(as_of).cast("date")
    this_year = F.trunc("claim_date", "year") == F.trunc(day, "year")
    trailing = (F.col("claim_date") > F.date_sub(day, TRAILING_DAYS)) & (F.col("claim_date") <= day)
    month_no = F.year("claim_date") * 12 + F.month("claim_date")
    spend = claims.filter(F.col("claim_date") <= day).groupBy("patient_id").agg(
        exact_sum("claim_amount", this_year).alias("total_spend_ytd"),
        exact_sum("claim_amount", trailing).alias("_trailing"),
        (F.max(month_no) - F.min(month_no) + 1 - F.countDistinct(month_no)).cast("int").alias("care_gap_cnt"),
    )
    visits = readmissions(admissions).groupBy("patient_id").agg(
        F.count(F.lit(1)).cast("int").alias("_visits"), F.max("readmitted").alias("_readmitted")
    )
    chronic = current_rows(patients).select("patient_id", F.col("chronic_conditions").alias("chronic_condition_cnt"))
    return (
        spend.join(chronic, "patient_id", "left")
        .join(visits, "patient_id", "left")
        .select(
            "patient_id",
            "total_spend_ytd",
            F.round(F.col("_trailing") / TRAILING_DAYS * 90, 2).alias("predicted_spend_90d"),
            "chronic_condition_cnt",
            F.coalesce("_visits", F.lit(0)).alias("er_visit_cnt"),
            F.coalesce("_readmitted", F.lit(False)).alias("readmission_flag"),
            "care_gap_cnt",
        )
        .withColumn(
            "risk_tier",
            risk_tier_four(F.col("total_spend_ytd"), F.col("chronic_condition_cnt"), F.col("er_visit_cnt")),
        )
    )


def cost_by_diagnosis(claims: DataFrame, diagnoses: DataFrame, admissions: DataFrame) -> DataFrame:
    """Cost per code and quarter against the same quarter a year earlier."""
    quarter_no = F.year("claim_date") * 4 + F.quarter("claim_date")
    costs = claims.groupBy("diagnosis_code", quarter_no.alias("_q")).agg(
        F.min(quarter_label("claim_date")).alias("quarter"),
        exact_sum("claim_amount").alias("total_cost"),
        F.count("claim_id").alias("claim_count"),
        exact_avg("claim_amount").alias("avg_cost_per_claim"),
    )
    # At most one row per code and quarter is left: four quarters back is a
    # row of the same small window, found by number and not by position.
    by_quarter = Window.partitionBy("diagnosis_code").orderBy("_q").rangeBetween(-4, -4)
    before = F.max("total_cost").over(by_quarter)
    er_quarter = F.year("admitted_at") * 4 + F.quarter("admitted_at")
    preventable = (
        admissions.filter(F.col("severity") <= PREVENTABLE_SEVERITY)
        .groupBy("diagnosis_code", er_quarter.alias("_q"))
        .agg(F.count(F.lit(1)).alias("_er"))
    )
    labels = diagnoses.select(F.col("icd10_code").alias("diagnosis_code"), F.col("category").alias("icd_category"))
    return (
        costs.withColumn("_before", before)
        .withColumn("yoy_cost_change_pct", percent(F.col("total_cost") - F.col("_before"), F.col("_before")))
        .join(preventable, ["diagnosis_code", "_q"], "left")
        .join(labels, "diagnosis_code", "left")
        .select(
            "diagnosis_code", "icd_category", "quarter", "total_cost", "claim_count", "avg_cost_per_claim",
            "yoy_cost_change_pct", F.coalesce("_er", F.lit(0)).cast("bigint").alias("preventable_er_cnt"),
        )
    )


def er_realtime_dashboard(hourly: DataFrame) -> DataFrame:
    """Hourly counts with the busiest hours of each department and day marked.
    The window holds the at most 24 hourly rows of one day."""
    busiest = Window.partitionBy("department", F.to_date("window_start")).orderBy(F.col("admission_count").desc())
    return hourly.select(
        "window_start",
        "window_end",
        "department",
        "admission_count",
        "avg_severity",
        (F.rank().over(busiest) == 1).alias("peak_hour_flag"),
    )


def claims_trend(claims: DataFrame) -> DataFrame:
    approved, denied = F.col("claim_status") == APPROVED, F.col("claim_status") == DENIED
    return (
        claims.groupBy(_month_label("claim_date").alias("report_month"))
        .agg(
            F.count("claim_id").alias("total_claims"),
            exact_sum("claim_amount", approved).alias("approved_amount"),
            exact_sum("claim_amount", denied).alias("denied_amount"),
            F.avg(_adjudication_days()).alias("avg_adjudication_days"),
            exact_sum("claim_amount").alias("_billed"),
        )
        .withColumn("mlr_estimate", F.round(F.try_divide("approved_amount", "_billed"), 4))
        .drop("_billed")
    )


def network_adequacy(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Active providers and members per provider by state, specialty, quarter.

    There are no coordinates, so the distance stays NULL.
    """
    places = providers.select("provider_id", "state", "specialty")
    seen = claims.select("provider_id", "patient_id", quarter_label("claim_date").alias("report_quarter")).distinct()
    return (
        seen.join(places, "provider_id")
        .groupBy("state", "specialty", "report_quarter")
        .agg(
            F.countDistinct("provider_id").cast("int").alias("active_provider_cnt"),
            F.countDistinct("patient_id").alias("_members"),
        )
        .withColumn("members_per_provider", F.try_divide("_members", "active_provider_cnt"))
        .withColumn("avg_distance_miles", F.lit(None).cast("double"))
        .withColumn("adequacy_flag", F.col("members_per_provider") <= MEMBERS_PER_PROVIDER)
        .drop("_members")
    )


def patient_risk_narratives(scores: DataFrame) -> DataFrame:
    """A plain sentence per patient; a model can rewrite it through ``enrich``."""
    advice = F.when(F.col("risk_tier").isin("CRITICAL", "HIGH"), "Recommend care coordination outreach.").otherwise(
        "No outreach needed."
    )
    text = F.format_string(
        "Member has %d chronic conditions, %d ER visits and $%s spend this year. %s",
        F.coalesce("chronic_condition_cnt", F.lit(0)),
        F.col("er_visit_cnt"),
        F.round("total_spend_ytd").cast("bigint").cast("string"),
        advice,
    )
    return scores.select("patient_id", "risk_tier", text.alias("narrative"), F.lit("template").alias("model_used"))
