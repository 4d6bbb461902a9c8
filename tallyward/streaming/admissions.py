"""Admission transformations that run on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.expressions import avg_stay_hours, stay_seconds, tally
from tallyward.functions.fixed_values import (
    ALERT_SEVERITY,
    CRITICAL_SEVERITY,
    HOURLY_LONG_STAY_HOURS,
    LATENESS,
    WINDOW,
)


def cleanse(raw: DataFrame) -> DataFrame:
    """Typed admissions with the length of stay. Unparsable values give NULL."""
    typed = raw.filter(F.col("admission_id").isNotNull()).withColumns(
        {
            "severity": F.col("severity").try_cast("int"),
            "admitted_at": F.col("admitted_at").try_cast("timestamp"),
            "discharged_at": F.col("discharged_at").try_cast("timestamp"),
        }
    )
    kept = [c for c in ("_ingest_ts", "_source_file") if c in raw.columns]
    return typed.select(
        "admission_id", "patient_id", "department", "severity", "admitted_at", "discharged_at",
        (stay_seconds() / F.lit(3600.0)).alias("los_hours"), "provider_id", "diagnosis_code", *kept,
    )


def hourly_patients(silver: DataFrame, lateness: str = LATENESS, window: str = WINDOW) -> DataFrame:
    """Partial hourly sums per department and patient.

    Streams reject a distinct count, and a set of patients per department
    would grow in one state row. Grouped by patient, the state spreads over
    all partitions and every patient of a window is counted once.
    """
    marked = silver.withWatermark("admitted_at", lateness) if silver.isStreaming else silver
    stay = stay_seconds()
    return marked.groupBy(F.window("admitted_at", window).alias("_w"), "department", "patient_id").agg(
        F.count("admission_id").alias("_admissions"),
        F.sum("severity").alias("_severity"),
        F.count("severity").alias("_rated"),
        F.sum(stay).alias("_stay"),
        F.count(stay).alias("_stays"),
        tally(stay > HOURLY_LONG_STAY_HOURS * 3600).alias("_long"),
    )


def departments_from_patients(partials: DataFrame, window: str = WINDOW) -> DataFrame:
    """Hourly figures per department from the per-patient sums."""
    hour = F.window(F.window_time("_w"), window) if partials.isStreaming else F.col("_w")
    return (
        partials.groupBy(hour.alias("_hour"), "department")
        .agg(
            F.sum("_admissions").alias("admission_count"),
            F.try_divide(F.sum("_severity"), F.sum("_rated")).alias("avg_severity"),
            F.try_divide(F.sum("_stay") / F.lit(3600.0), F.sum("_stays")).alias("avg_los_hours"),
            F.count("patient_id").alias("unique_patients"),
            F.sum("_long").alias("long_stay_count"),
        )
        .select(*_hourly_columns())
    )


def hourly_departments(silver: DataFrame, lateness: str = LATENESS, window: str = WINDOW, exact: bool = True) -> DataFrame:
    """Hourly admissions per department, under a watermark when streaming.

    The exact form chains two aggregates, which a stream can do in append
    mode only. ``exact=False`` keeps a fixed-size sketch of the patients in
    one aggregate and runs in any output mode.
    """
    if exact:
        return departments_from_patients(hourly_patients(silver, lateness, window), window)
    marked = silver.withWatermark("admitted_at", lateness) if silver.isStreaming else silver
    return (
        marked.groupBy(F.window("admitted_at", window).alias("_hour"), "department")
        .agg(
            F.count("admission_id").alias("admission_count"),
            F.avg("severity").alias("avg_severity"),
            avg_stay_hours().alias("avg_los_hours"),
            F.approx_count_distinct("patient_id").alias("unique_patients"),
            tally(stay_seconds() > HOURLY_LONG_STAY_HOURS * 3600).alias("long_stay_count"),
        )
        .select(*_hourly_columns())
    )


def _hourly_columns() -> list:
    return [
        F.col("_hour.start").alias("window_start"), F.col("_hour.end").alias("window_end"), "department",
        "admission_count", "avg_severity", "avg_los_hours", "unique_patients", "long_stay_count",
    ]


def alerts(silver: DataFrame) -> DataFrame:
    level = F.when(F.col("severity") == CRITICAL_SEVERITY, "CRITICAL").otherwise("HIGH")
    return silver.filter(F.col("severity") >= ALERT_SEVERITY).select(
        "admission_id", "patient_id", "department", "severity", level.alias("alert_level"), "admitted_at",
        "provider_id", "diagnosis_code", F.current_timestamp().alias("alert_ts"),
    )


def first_within_watermark(df: DataFrame, event_time: str, keys: list[str], lateness: str = LATENESS) -> DataFrame:
    """Drop repeated keys of a stream; keys are forgotten once the watermark
    has passed, so the state stays bounded."""
    return df.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(keys)
