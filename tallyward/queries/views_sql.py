"""SQL twins of the views in ``sources/model.py``, written for the checker."""

from __future__ import annotations

VIEWS: dict[str, tuple[list[str], str]] = {
    "claims_bronze": ([], """
        SELECT l_orderkey || '-' || l_linenumber AS claim_id,
               CAST(o_custkey AS VARCHAR) AS patient_id,
               CAST(l_suppkey AS VARCHAR) AS provider_id,
               CAST(l_partkey AS VARCHAR) AS diagnosis_code,
               'P' || l_linenumber AS procedure_code,
               CAST(o_orderdate AS DATE) AS claim_date,
               l_extendedprice AS claim_amount,
               CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'R' THEN 'DENIED' ELSE 'PENDING' END AS claim_status,
               o_orderpriority AS payer_id,
               CAST(DATE '1930-01-01' + CAST(o_custkey % 25550 AS INTEGER) AS DATE) AS dob,
               lpad(CAST(o_custkey % 9999 AS VARCHAR), 4, '0') AS ssn_last4,
               (o_custkey % 9999) || ' Main St' AS patient_address,
               l_shipdate AS ingest_ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "claims_fact": (["claims_bronze"], """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY ingest_ts DESC, claim_amount DESC) AS rn
            FROM claims_bronze) WHERE rn = 1"""),
    "provider_dim": ([], """
        SELECT CAST(s_suppkey AS VARCHAR) AS provider_id, s_name AS provider_name, r_name AS specialty,
               'NPI' || lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS npi,
               CASE WHEN s_suppkey % 100 < 82 THEN 'IN_NETWORK' ELSE 'OUT_OF_NETWORK' END AS network_status,
               n_name AS state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""),
    "patient_changes": ([], """
        SELECT CAST(o_custkey AS VARCHAR) AS patient_id, o_orderpriority AS insurance_plan,
               o_totalprice AS last_billed, CAST(o_custkey % 9 AS INTEGER) AS chronic_conditions,
               CAST(o_orderdate AS DATE) AS event_date, o_orderkey AS event_no
        FROM orders"""),
    "patient_versions": (["patient_changes"], """
        SELECT patient_id, insurance_plan,
               arg_max(last_billed, pos) AS last_billed, max(chronic_conditions) AS chronic_conditions,
               arg_min(event_no, pos) AS event_no, min(event_date) AS start_at,
               lead(min(event_date)) OVER (PARTITION BY patient_id ORDER BY run) AS end_at,
               run = max(run) OVER (PARTITION BY patient_id) AS is_current
        FROM (
            SELECT *, sum(changed) OVER (PARTITION BY patient_id ORDER BY pos) AS run FROM (
                SELECT *, CASE WHEN insurance_plan IS NOT DISTINCT FROM
                                    lag(insurance_plan) OVER (PARTITION BY patient_id ORDER BY event_date, event_no)
                               THEN 0 ELSE 1 END AS changed,
                       row_number() OVER (PARTITION BY patient_id ORDER BY event_date, event_no) AS pos
                FROM patient_changes))
        GROUP BY patient_id, insurance_plan, run"""),
    "patient_dim": (["patient_versions"], """
        SELECT v.*, c_mktsegment AS first_name, c_name AS last_name
        FROM patient_versions v LEFT JOIN customer ON patient_id = CAST(c_custkey AS VARCHAR)"""),
    "diagnosis_dim": ([], """
        SELECT CAST(p_partkey AS VARCHAR) AS icd10_code, p_name AS description, p_type AS category,
               p_size > 25 AS chronic_flag,
               CASE WHEN p_partkey % 5 = 0 THEN 'Curated note on ' || p_name || ' of ' || p_brand END AS ai_description
        FROM part"""),
    "er_admissions": ([], """
        SELECT CAST(event_id AS VARCHAR) AS admission_id, CAST(user_id AS VARCHAR) AS patient_id,
               event_type AS department, CAST(event_id % 5 + 1 AS INTEGER) AS severity, ts AS admitted_at,
               CASE WHEN event_id % 10 <> 0 THEN ts + to_hours(event_id % 72 + 1) END AS discharged_at,
               CAST(event_id % 10 AS VARCHAR) AS provider_id, CAST(event_id % 200 AS VARCHAR) AS diagnosis_code
        FROM events"""),
    "er_silver": (["er_admissions"], """
        SELECT *, date_diff('second', admitted_at, discharged_at) AS stay_s,
               date_diff('second', admitted_at, discharged_at) / 3600.0::DOUBLE AS los_hours
        FROM er_admissions"""),
    "claims_unchecked": (["claims_bronze"], """
        SELECT CASE WHEN fault <> 0 THEN claim_id END AS claim_id,
               CASE WHEN fault NOT IN (0, 1) THEN patient_id END AS patient_id,
               CASE WHEN fault <> 2 THEN provider_id END AS provider_id,
               CASE WHEN fault <> 3 THEN diagnosis_code END AS diagnosis_code,
               CASE WHEN fault = 4 THEN DATE '2014-12-31' ELSE CAST(claim_date + INTERVAL 264 MONTH AS DATE) END AS claim_date,
               CASE WHEN fault = 5 THEN -claim_amount ELSE claim_amount END AS claim_amount,
               CASE WHEN fault <> 0 THEN claim_status END AS claim_status,
               payer_id, claim_id AS load_ref, CAST(ingest_ts AS DATE) AS load_date
        FROM (SELECT *, (CAST(patient_id AS BIGINT) * 7 + CAST(provider_id AS BIGINT) * 3
                         + CAST(diagnosis_code AS BIGINT)) % 50 AS fault FROM claims_bronze)"""),
    "monthly_claims_summary": (["claims_fact"], """
        SELECT CAST(date_trunc('month', claim_date) AS DATE) AS claim_month, payer_id,
               count(*) AS total_claims,
               CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
               CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_claim_amount,
               count(DISTINCT patient_id) AS unique_patients, count(DISTINCT provider_id) AS unique_providers,
               count(*) FILTER (claim_status = 'APPROVED') AS approved_count,
               count(*) FILTER (claim_status = 'DENIED') AS denied_count,
               count(*) FILTER (claim_status = 'PENDING') AS pending_count,
               round(count(*) FILTER (claim_status = 'APPROVED') / count(*) * 100, 2) AS approval_rate_pct
        FROM claims_fact GROUP BY ALL"""),
    "provider_performance": (["claims_fact", "provider_dim"], """
        SELECT *, rank() OVER (PARTITION BY specialty ORDER BY total_billed DESC) AS specialty_rank FROM (
            SELECT f.provider_id, provider_name, specialty, network_status, state,
                   count(*) AS total_claims,
                   CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_billed,
                   CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_claim_amount,
                   count(DISTINCT patient_id) AS unique_patients,
                   count(*) FILTER (claim_status = 'APPROVED') AS approved_claims,
                   count(*) FILTER (claim_status = 'DENIED') AS denied_claims,
                   round(count(*) FILTER (claim_status = 'APPROVED') / count(*) * 100, 2) AS approval_rate_pct
            FROM claims_fact f LEFT JOIN provider_dim d ON f.provider_id = d.provider_id GROUP BY ALL)"""),
    "patient_risk_scores": (["claims_fact", "patient_dim"], """
        SELECT *, CASE WHEN total_spend >= 10000 OR chronic_conditions >= 3 THEN 'HIGH'
                       WHEN total_spend >= 5000 OR chronic_conditions >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
        FROM (SELECT f.patient_id, first_name, last_name, insurance_plan, chronic_conditions,
                     count(*) AS total_claims,
                     CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
                     CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_claim_amount,
                     count(DISTINCT diagnosis_code) AS unique_diagnoses,
                     count(DISTINCT provider_id) AS unique_providers_seen, max(claim_date) AS last_claim_date
              FROM claims_fact f LEFT JOIN (FROM patient_dim WHERE is_current) p ON f.patient_id = p.patient_id
              GROUP BY ALL)"""),
    "diagnosis_trends": (["claims_fact", "diagnosis_dim"], """
        SELECT *, round((claim_count - prev_month_count) / prev_month_count * 100, 2) AS mom_change_pct
        FROM (SELECT *, lag(claim_count) OVER (PARTITION BY diagnosis_code ORDER BY claim_month) AS prev_month_count
              FROM (SELECT CAST(date_trunc('month', claim_date) AS DATE) AS claim_month, diagnosis_code,
                           description AS diagnosis_description, category AS diagnosis_category, chronic_flag,
                           count(*) AS claim_count, count(DISTINCT patient_id) AS patient_count,
                           CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
                           CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_amount
                    FROM claims_fact LEFT JOIN diagnosis_dim ON diagnosis_code = icd10_code GROUP BY ALL))"""),
    "er_dept_summary": (["er_silver"], """
        SELECT CAST(date_trunc('month', admitted_at) AS DATE) AS admit_month, department,
               count(*) AS total_admissions, count(DISTINCT patient_id) AS unique_patients,
               CAST(sum(stay_s) AS DOUBLE) / 3600.0::DOUBLE / count(stay_s) AS avg_los_hours,
               max(stay_s) / 3600.0::DOUBLE AS max_los_hours, avg(severity) AS avg_severity,
               count(*) FILTER (severity >= 4) AS high_severity_count,
               count(*) FILTER (los_hours > 24) AS long_stay_over_24h,
               count(*) FILTER (discharged_at IS NULL) AS still_admitted,
               round(count(*) FILTER (severity >= 4) / count(*) * 100, 2) AS high_severity_pct
        FROM er_silver GROUP BY ALL"""),
    "network_utilization": (["claims_fact", "provider_dim"], """
        SELECT CAST(date_trunc('month', claim_date) AS DATE) AS claim_month, network_status, specialty,
               count(*) AS claim_count,
               CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
               CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_amount,
               count(DISTINCT patient_id) AS patient_count
        FROM claims_fact f LEFT JOIN provider_dim d ON f.provider_id = d.provider_id GROUP BY ALL"""),
    "payer_denial_analysis": (["claims_fact"], """
        SELECT *, round(denied_amount / nullif(denied_amount + approved_amount, 0) * 100, 2) AS denied_amount_pct,
               rank() OVER (PARTITION BY claim_month ORDER BY denial_rate_pct DESC) AS denial_rank
        FROM (SELECT CAST(date_trunc('month', claim_date) AS DATE) AS claim_month, payer_id,
                     count(*) AS total_claims, count(*) FILTER (claim_status = 'DENIED') AS denied_count,
                     CAST(coalesce(sum(CAST(claim_amount AS DECIMAL(18,2))) FILTER (claim_status = 'DENIED'), 0) AS DOUBLE) AS denied_amount,
                     CAST(coalesce(sum(CAST(claim_amount AS DECIMAL(18,2))) FILTER (claim_status = 'APPROVED'), 0) AS DOUBLE) AS approved_amount,
                     count(DISTINCT patient_id) FILTER (claim_status = 'DENIED') AS patients_with_denials,
                     round(count(*) FILTER (claim_status = 'DENIED') / count(*) * 100, 2) AS denial_rate_pct
              FROM claims_fact GROUP BY ALL)"""),
}


def _needed(names: list[str], seen: dict[str, str]) -> dict[str, str]:
    for name in names:
        if name not in seen:
            parents, body = VIEWS[name]
            _needed(parents, seen)
            seen[name] = body
    return seen


def with_views(names: list[str], sql: str) -> str:
    bodies = _needed(names, {})
    if not bodies:
        return sql.strip()
    head = ",\n".join(f"{name} AS ({body.strip()})" for name, body in bodies.items())
    body = sql.strip()
    if body.startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def over(name: str, facts: str, sql: str) -> str:
    """A view's SQL over other facts: ``facts`` takes the place of ``claims_fact``."""
    parents, body = VIEWS[name]
    head = ",\n".join(f"{n} AS ({b.strip()})" for n, b in _needed([p for p in parents if p != "claims_fact"], {}).items())
    return f"WITH {head + ',' if head else ''} {facts}, {name} AS ({body.replace('claims_fact', 'claims_left')}) {sql}"
