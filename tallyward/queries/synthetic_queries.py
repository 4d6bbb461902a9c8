"""Generators fed with the keys of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.functions import fixed_values as fixed
from tallyward.queries.registry import query
from tallyward.sources import generate
from tallyward.sources.tables import table


def keys(spark, folder, name, key):
    return table(spark, folder, name).select(F.col(key).cast("bigint").alias("id"))


def _pick(values, n):
    return f"[{', '.join(repr(v) for v in values)}][CAST({n} % {len(values)} AS INTEGER) + 1]"


def _pad(prefix, n, width):
    return f"'{prefix}' || lpad(CAST({n} AS VARCHAR), {width}, '0')"


def _day(first, offset):
    return f"CAST(DATE '{first}' + CAST({offset} AS INTEGER) AS DATE)"


@query("datagen_providers", "", f"""
    SELECT {_pad('PRV', 's_suppkey', 8)} AS provider_id, 'Dr. Provider ' || s_suppkey AS provider_name,
           {_pick(fixed.SPECIALTIES, 's_suppkey')} AS specialty, {_pad('NPI', 's_suppkey', 10)} AS npi,
           CASE WHEN s_suppkey % 100 < 82 THEN 'IN_NETWORK' ELSE 'OUT_OF_NETWORK' END AS network_status,
           {_pick(fixed.STATES, 's_suppkey')} AS state, 'Hospital System ' || (s_suppkey % 50) AS hospital_affil
    FROM supplier""")
def datagen_providers(spark, folder):
    return generate.providers(keys(spark, folder, "supplier", "s_suppkey"))


@query("datagen_patients", "", f"""
    SELECT {_pad('PAT', 'c_custkey', 8)} AS patient_id, 'FirstName' || c_custkey AS first_name, 'LastName' || c_custkey AS last_name,
           {_day('1930-01-01', 'c_custkey % 25550')} AS dob, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
           (c_custkey % 9999) || ' Main St' AS address, 'City' || (c_custkey % 500) AS city, {_pick(fixed.STATES, 'c_custkey')} AS state,
           CAST(10000 + c_custkey % 89999 AS VARCHAR) AS zip_code, {_pick(fixed.INSURANCE_PLANS, 'c_custkey')} AS insurance_plan,
           CAST(c_custkey % 9 AS INTEGER) AS chronic_conditions FROM customer""")
def datagen_patients(spark, folder):
    return generate.patients(keys(spark, folder, "customer", "c_custkey"))


_BYTES = " + ".join(f"CAST('0x' || substr(md5(CAST(n AS VARCHAR)), {2 * i + 1}, 2) AS INTEGER)" for i in range(16))
_CLAIMS = f"""
    SELECT n AS id, {_pad('PAT', 'n % 6000000', 8)} AS patient_id, {_pad('PRV', 'n % 450000', 8)} AS provider_id,
           {_pick([d[0] for d in fixed.DIAGNOSES], 'n')} AS diagnosis_code, {_pick(fixed.PROCEDURE_CODES, 'n')} AS procedure_code,
           {_day('2020-01-01', 'n % 1825')} AS claim_date,
           round(abs({_BYTES} - 2040) * 5000 / 295.6::DOUBLE + 200, 2) AS claim_amount,
           CASE WHEN n % 100 < 78 THEN 'APPROVED' WHEN n % 100 < 93 THEN 'DENIED' ELSE 'PENDING' END AS claim_status,
           'PAYER' || (n % 10) AS payer_id, {_day('1930-01-01', 'n % 25550')} AS dob,
           lpad(CAST(n % 9999 AS VARCHAR), 4, '0') AS ssn_last4, (n % 9999) || ' Main St' AS patient_address
    FROM (SELECT o_orderkey AS n FROM orders)"""


@query("datagen_claims", "", _CLAIMS)
def datagen_claims(spark, folder):
    return generate.claims(keys(spark, folder, "orders", "o_orderkey"), 6_000_000, 450_000)


@query("datagen_inflated", "", f"""
    SELECT {_pad('CLM', '(id * 30 + copy)', 15)} AS claim_id, * EXCLUDE (id, copy)
    FROM ({_CLAIMS}) CROSS JOIN (SELECT unnest(range(30)) AS copy)""")
def datagen_inflated(spark, folder):
    return generate.inflate(datagen_claims(spark, folder), 30)


@query("datagen_er", "", f"""
    SELECT {_pad('ER', 'event_id', 10)} AS admission_id, {_pad('PAT', 'event_id % 6000000', 8)} AS patient_id,
           {_pick(fixed.DEPARTMENTS, 'event_id')} AS department, CAST(event_id % 5 + 1 AS INTEGER) AS severity,
           TIMESTAMP '2023-01-01' + to_hours(event_id % 8760) AS admitted_at,
           TIMESTAMP '2023-01-01' + to_hours(event_id % 8760 + event_id % 72 + 1) AS discharged_at,
           {_pad('PRV', 'event_id % 450000', 8)} AS provider_id, {_pick([d[0] for d in fixed.DIAGNOSES], 'event_id')} AS diagnosis_code
    FROM events""")
def datagen_er(spark, folder):
    rows = generate.admissions(keys(spark, folder, "events", "event_id"), 6_000_000, 450_000)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ["admitted_at", "discharged_at"]})
