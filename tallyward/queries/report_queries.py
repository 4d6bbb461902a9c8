"""Declared gold tables and the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators.history import START
from tallyward.plans import reporting, star
from tallyward.queries.registry import query
from tallyward.session import stored_copy
from tallyward.sources import model
from tallyward.streaming import admissions as er

AS_OF = "2001-06-30"
_SUM = "CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE)"
_SUM_IF = "CAST(coalesce(sum(CAST(claim_amount AS DECIMAL(18,2))) FILTER ({}), 0) AS DOUBLE)"


@query("provider_performance_monthly", "claims_fact provider_dim", f"""
    SELECT *, denied_claims / total_claims AS denial_rate FROM (
        SELECT f.provider_id, provider_name, specialty, strftime(claim_date, '%Y-%m') AS report_month,
               count(*) AS total_claims, count(*) FILTER (claim_status = 'APPROVED') AS approved_claims,
               count(*) FILTER (claim_status = 'DENIED') AS denied_claims, {_SUM} / count(*) AS avg_claim_amount,
               avg(CAST(ingest_ts AS DATE) - claim_date) AS avg_processing_days,
               avg(CASE network_status WHEN 'OUT_OF_NETWORK' THEN 1.0 ELSE 0.0 END::DOUBLE) AS out_of_network_rate
        FROM claims_fact f LEFT JOIN provider_dim d ON f.provider_id = d.provider_id GROUP BY ALL)""")
def provider_performance_monthly(spark, folder):
    return reporting.provider_performance_monthly(model.claims_fact(spark, folder), model.provider_dim(spark, folder))


_NEXT = """(SELECT *, lead(admitted_at) OVER (PARTITION BY patient_id ORDER BY admitted_at, admission_id) AS next_admitted_at
    FROM er_admissions)"""


@query("readmissions", "er_admissions", f"""
    SELECT patient_id, admission_id, admitted_at, discharged_at, next_admitted_at,
           coalesce(next_admitted_at <= discharged_at + INTERVAL 30 DAYS, false) AS readmitted FROM {_NEXT}""")
def readmissions(spark, folder):
    rows = reporting.readmissions(model.er_admissions(spark, folder))
    stamps = ["admitted_at", "discharged_at", "next_admitted_at"]
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def risk_score(spark, folder):
    return reporting.patient_risk_score(
        model.claims_fact(spark, folder), model.patient_dim(spark, folder), model.er_admissions(spark, folder), AS_OF
    )


_RISK = f"""
    spend AS (SELECT patient_id, {_SUM_IF.format("year(claim_date) = 2001")} AS total_spend_ytd,
               {_SUM_IF.format(f"claim_date > DATE '{AS_OF}' - 365")} AS trail,
               CAST(max(year(claim_date) * 12 + month(claim_date)) - min(year(claim_date) * 12 + month(claim_date)) + 1
                    - count(DISTINCT year(claim_date) * 12 + month(claim_date)) AS INTEGER) AS care_gap_cnt
        FROM claims_fact WHERE claim_date <= DATE '{AS_OF}' GROUP BY patient_id),
    visits AS (SELECT patient_id, CAST(count(*) AS INTEGER) AS n,
                      bool_or(coalesce(next_admitted_at <= discharged_at + INTERVAL 30 DAYS, false)) AS again
               FROM {_NEXT} GROUP BY patient_id),
    score AS (SELECT s.patient_id, total_spend_ytd, round(trail / 365 * 90, 2) AS predicted_spend_90d,
               chronic_conditions AS chronic_condition_cnt, coalesce(n, 0) AS er_visit_cnt,
               coalesce(again, false) AS readmission_flag, care_gap_cnt,
               CASE (total_spend_ytd >= 10000)::INT + coalesce(chronic_conditions >= 3, false)::INT + (coalesce(n, 0) >= 3)::INT
                    WHEN 3 THEN 'CRITICAL' WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
        FROM spend s LEFT JOIN (FROM patient_dim WHERE is_current) p ON s.patient_id = p.patient_id
        LEFT JOIN visits v ON s.patient_id = v.patient_id)"""

query("patient_risk_score", "claims_fact patient_dim er_admissions", f"WITH {_RISK} SELECT * FROM score")(risk_score)


@query("patient_risk_narratives", "claims_fact patient_dim er_admissions", f"""WITH {_RISK}
    SELECT patient_id, risk_tier, 'template' AS model_used,
           'Member has ' || chronic_condition_cnt || ' chronic conditions, ' || er_visit_cnt || ' ER visits and $'
           || CAST(round(total_spend_ytd) AS BIGINT) || ' spend this year. '
           || CASE WHEN risk_tier IN ('CRITICAL', 'HIGH') THEN 'Recommend care coordination outreach.'
                   ELSE 'No outreach needed.' END AS narrative FROM score""")
def patient_risk_narratives(spark, folder):
    return reporting.patient_risk_narratives(risk_score(spark, folder))


@query("cost_by_diagnosis", "claims_fact diagnosis_dim er_admissions", f"""
    WITH cost AS (SELECT diagnosis_code, year(claim_date) * 4 + quarter(claim_date) AS q,
                 min(year(claim_date) || '-Q' || quarter(claim_date)) AS quarter, {_SUM} AS total_cost,
                 count(*) AS claim_count, {_SUM} / count(*) AS avg_cost_per_claim FROM claims_fact GROUP BY ALL),
    er AS (SELECT diagnosis_code, year(admitted_at) * 4 + quarter(admitted_at) AS q, count(*) AS n
           FROM er_admissions WHERE severity <= 2 GROUP BY ALL)
    SELECT c.diagnosis_code, category AS icd_category, c.quarter, c.total_cost, c.claim_count, c.avg_cost_per_claim,
           round((c.total_cost - p.total_cost) / nullif(p.total_cost, 0) * 100, 2) AS yoy_cost_change_pct,
           coalesce(n, 0) AS preventable_er_cnt
    FROM cost c LEFT JOIN cost p ON c.diagnosis_code = p.diagnosis_code AND p.q = c.q - 4
    LEFT JOIN er ON er.diagnosis_code = c.diagnosis_code AND er.q = c.q
    LEFT JOIN diagnosis_dim ON icd10_code = c.diagnosis_code""")
def cost_by_diagnosis(spark, folder):
    return reporting.cost_by_diagnosis(
        model.claims_fact(spark, folder), model.diagnosis_dim(spark, folder), model.er_admissions(spark, folder)
    )


@query("er_realtime_dashboard", "er_admissions", """
    SELECT *, rank() OVER (PARTITION BY department, CAST(window_start AS DATE) ORDER BY admission_count DESC) = 1 AS peak_hour_flag
    FROM (SELECT date_trunc('hour', admitted_at) AS window_start, date_trunc('hour', admitted_at) + INTERVAL 1 HOUR AS window_end,
                 department, count(*) AS admission_count, avg(severity) AS avg_severity FROM er_admissions GROUP BY ALL)""")
def er_realtime_dashboard(spark, folder):
    hourly = er.hourly_departments(model.er_silver(spark, folder))
    board = reporting.er_realtime_dashboard(hourly)
    return board.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ["window_start", "window_end"]})


@query("claims_trend", "claims_fact", f"""
    SELECT strftime(claim_date, '%Y-%m') AS report_month, count(*) AS total_claims,
           {_SUM_IF.format("claim_status = 'APPROVED'")} AS approved_amount,
           {_SUM_IF.format("claim_status = 'DENIED'")} AS denied_amount,
           avg(CAST(ingest_ts AS DATE) - claim_date) AS avg_adjudication_days,
           round({_SUM_IF.format("claim_status = 'APPROVED'")} / {_SUM}, 4) AS mlr_estimate
    FROM claims_fact GROUP BY ALL""")
def claims_trend(spark, folder):
    return reporting.claims_trend(model.claims_fact(spark, folder))


@query("network_adequacy", "claims_fact provider_dim", """
    SELECT state, specialty, year(claim_date) || '-Q' || quarter(claim_date) AS report_quarter,
           CAST(count(DISTINCT f.provider_id) AS INTEGER) AS active_provider_cnt,
           count(DISTINCT patient_id) / count(DISTINCT f.provider_id) AS members_per_provider,
           CAST(NULL AS DOUBLE) AS avg_distance_miles,
           count(DISTINCT patient_id) / count(DISTINCT f.provider_id) <= 50 AS adequacy_flag
    FROM claims_fact f JOIN provider_dim d ON f.provider_id = d.provider_id GROUP BY ALL""")
def network_adequacy(spark, folder):
    return reporting.network_adequacy(model.claims_fact(spark, folder), model.provider_dim(spark, folder))


@query("dim_date", "claims_bronze", """
    SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, day, CAST(year(day) AS INTEGER) AS year,
           CAST(quarter(day) AS INTEGER) AS quarter, CAST(month(day) AS INTEGER) AS month,
           CAST(dayofmonth(day) AS INTEGER) AS day_of_month, CAST(isodow(day) - 1 AS INTEGER) AS weekday,
           isodow(day) >= 6 AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(min(claim_date), max(claim_date), INTERVAL 1 DAY)) AS DATE) AS day FROM claims_bronze)""")
def dim_date(spark, folder):
    return star.dim_date(star.date_span(model.claims_bronze(spark, folder)))


def claim_star(spark, folder):
    return star.fact_claims(
        model.claims_fact(spark, folder), model.patient_dim(spark, folder), model.provider_dim(spark, folder),
    )


_STAR = """
    SELECT f.claim_id, CAST(strftime(claim_date, '%Y%m%d') AS INTEGER) AS date_key, f.patient_id,
           v.event_no AS patient_version, v.insurance_plan, f.provider_id, diagnosis_code, procedure_code,
           (claim_status = 'DENIED')::INT * 4 + coalesce(network_status = 'OUT_OF_NETWORK', false)::INT * 2
           + (claim_amount >= 50000)::INT AS flag_key, claim_amount
    FROM claims_fact f LEFT JOIN provider_dim d ON f.provider_id = d.provider_id
    LEFT JOIN (SELECT c.claim_id, arg_max(p.event_no, (p.start_at, p.event_no)) AS event_no,
                      arg_max(p.insurance_plan, (p.start_at, p.event_no)) AS insurance_plan
               FROM claims_fact c JOIN patient_versions p ON c.patient_id = p.patient_id AND p.start_at <= c.claim_date
               GROUP BY c.claim_id) v ON v.claim_id = f.claim_id"""

query("fact_claims_star", "claims_fact provider_dim patient_versions", _STAR)(claim_star)


@query("fact_claims_star_sliced", "claims_fact provider_dim patient_versions", _STAR)
def fact_claims_star_sliced(spark, folder):
    """The same with the patients of 30 or more claims in slices. Claims and
    versions are stored, as slicing reads them several times."""
    named = ["claim_id", "patient_id", "provider_id", "diagnosis_code", "procedure_code", "claim_date", "claim_amount", "claim_status"]
    versions = ["patient_id", "event_no", "insurance_plan", START]
    return star.fact_claims(
        stored_copy(model.claims_fact(spark, folder).select(*named), "star-facts"),
        stored_copy(model.patient_dim(spark, folder).select(*versions), "star-versions"),
        model.provider_dim(spark, folder),
        stored_copy(model.busy_patients(spark, folder, 30), "busy"),
    )


@query("dim_claim_flags", "claims_fact provider_dim patient_versions", f"""
    SELECT flag_key, (flag_key & 4) > 0 AS is_denied, (flag_key & 2) > 0 AS is_out_of_network,
           (flag_key & 1) > 0 AS is_high_cost, count(*) AS claim_count FROM ({_STAR}) GROUP BY ALL""")
def dim_claim_flags(spark, folder):
    facts = star.flagged_claims(model.claims_fact(spark, folder), model.provider_dim(spark, folder))
    return star.dim_claim_flags(facts)


@query("dim_procedure", "claims_fact", """
    SELECT procedure_code, count(*) AS claim_count, min(claim_date) AS first_used FROM claims_fact GROUP BY ALL""")
def dim_procedure(spark, folder):
    return star.dim_procedure(model.claims_fact(spark, folder))


@query("fact_er_star", "er_silver diagnosis_dim provider_dim", """
    SELECT admission_id, CAST(strftime(admitted_at, '%Y%m%d') AS INTEGER) AS date_key, patient_id,
           coalesce(p.provider_id, '-1') AS provider_id, coalesce(icd10_code, '-1') AS diagnosis_code,
           department, severity, los_hours
    FROM er_silver e LEFT JOIN provider_dim p ON e.provider_id = p.provider_id
    LEFT JOIN diagnosis_dim ON e.diagnosis_code = icd10_code""")
def fact_er_star(spark, folder):
    return star.fact_er_admissions(
        model.er_silver(spark, folder), model.diagnosis_dim(spark, folder), model.provider_dim(spark, folder)
    )
