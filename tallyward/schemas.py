"""Row types of the bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SCHEMAS: dict[str, str] = {
    "claims_raw": """
        claim_id STRING, patient_id STRING, provider_id STRING, diagnosis_code STRING,
        procedure_code STRING, claim_date DATE, claim_amount DOUBLE, claim_status STRING,
        payer_id STRING, dob DATE, ssn_last4 STRING, patient_address STRING,
        _ingest_ts TIMESTAMP, _source_file STRING""",
    "claims_quarantine": """
        claim_id STRING, raw_record STRING, dq_rule STRING, failed_at TIMESTAMP,
        _source_file STRING""",
    "er_admissions_raw": """
        admission_id STRING, patient_id STRING, department STRING, severity INT,
        admitted_at TIMESTAMP, discharged_at TIMESTAMP, provider_id STRING,
        diagnosis_code STRING, _ingest_ts TIMESTAMP""",
    "claims_fact": """
        claim_id STRING NOT NULL, patient_id STRING, provider_id STRING,
        diagnosis_code STRING, procedure_code STRING, claim_date DATE, claim_amount DOUBLE,
        claim_status STRING, payer_id STRING, dob DATE, ssn_last4 STRING,
        patient_address STRING, _updated_ts TIMESTAMP""",
    "patient_dim": """
        patient_id STRING, first_name STRING, last_name STRING, dob DATE, gender STRING,
        address STRING, city STRING, state STRING, zip_code STRING, insurance_plan STRING,
        chronic_conditions INT, _updated_ts TIMESTAMP, __START_AT TIMESTAMP,
        __END_AT TIMESTAMP, __IS_CURRENT BOOLEAN""",
    "provider_dim": """
        provider_id STRING, provider_name STRING, specialty STRING, npi STRING,
        network_status STRING, state STRING, hospital_affil STRING, _updated_ts TIMESTAMP""",
    "diagnosis_dim": """
        icd10_code STRING, description STRING, category STRING, chronic_flag BOOLEAN,
        ai_description STRING""",
    "er_admissions_silver": """
        admission_id STRING, patient_id STRING, department STRING, severity INT,
        admitted_at TIMESTAMP, discharged_at TIMESTAMP, los_hours DOUBLE,
        provider_id STRING, diagnosis_code STRING, _updated_ts TIMESTAMP""",
    "er_hourly_dept_agg": """
        department STRING, admission_count BIGINT, avg_severity DOUBLE,
        avg_los_hours DOUBLE, unique_patients BIGINT, long_stay_count BIGINT,
        window_start TIMESTAMP, window_end TIMESTAMP, _updated_ts TIMESTAMP""",
    "er_high_severity_alerts": """
        admission_id STRING, patient_id STRING, department STRING, severity INT,
        alert_level STRING, admitted_at TIMESTAMP, provider_id STRING,
        diagnosis_code STRING, alert_ts TIMESTAMP""",
    "provider_performance_monthly": """
        provider_id STRING, provider_name STRING, specialty STRING, total_claims BIGINT,
        approved_claims BIGINT, denied_claims BIGINT, denial_rate DOUBLE,
        avg_claim_amount DOUBLE, avg_processing_days DOUBLE, out_of_network_rate DOUBLE,
        report_month STRING, _updated_ts TIMESTAMP""",
    "patient_risk_score": """
        patient_id STRING, total_spend_ytd DOUBLE, predicted_spend_90d DOUBLE,
        chronic_condition_cnt INT, er_visit_cnt INT, readmission_flag BOOLEAN,
        care_gap_cnt INT, risk_tier STRING, _updated_ts TIMESTAMP""",
    "cost_by_diagnosis": """
        diagnosis_code STRING, icd_category STRING, quarter STRING, total_cost DOUBLE,
        claim_count BIGINT, avg_cost_per_claim DOUBLE, yoy_cost_change_pct DOUBLE,
        preventable_er_cnt BIGINT, _updated_ts TIMESTAMP""",
    "er_realtime_dashboard": """
        window_start TIMESTAMP, window_end TIMESTAMP, department STRING,
        admission_count BIGINT, avg_severity DOUBLE, peak_hour_flag BOOLEAN,
        _updated_ts TIMESTAMP""",
    "claims_trend": """
        report_month STRING, total_claims BIGINT, approved_amount DOUBLE,
        denied_amount DOUBLE, avg_adjudication_days DOUBLE, mlr_estimate DOUBLE,
        _updated_ts TIMESTAMP""",
    "patient_risk_narratives": """
        patient_id STRING, risk_tier STRING, narrative STRING, model_used STRING,
        generated_at TIMESTAMP""",
    "network_adequacy": """
        state STRING, specialty STRING, active_provider_cnt INT, members_per_provider DOUBLE,
        avg_distance_miles DOUBLE, adequacy_flag BOOLEAN, report_quarter STRING,
        _updated_ts TIMESTAMP""",
}


def schema(name: str) -> StructType:
    """Parsing a definition needs a running session."""
    return StructType.fromDDL(SCHEMAS[name])


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """An empty frame with the declared row type, for schema-first creation."""
    return spark.createDataFrame([], schema(name))


def create_table(spark: SparkSession, name: str, table: str, folder: str) -> None:
    """Create a declared table in the catalog over a folder, if it is missing."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({SCHEMAS[name]}) USING PARQUET LOCATION '{folder}'")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast and order columns to a declared table; absent columns become NULL."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in schema(name)
        ]
    )
