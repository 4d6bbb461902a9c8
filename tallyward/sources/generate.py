"""Synthetic rows as functions of an id column.

``ids`` is any frame with a bigint ``id``: ``spark.range(n)`` for a new data
set, or keys taken from a table. Every value is derived from the id, so the
rows are the same for every partitioning and every retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.expressions import padded, pick
from tallyward.functions.fixed_values import (
    APPROVED,
    DENIED,
    DEPARTMENTS,
    DIAGNOSES,
    IN_NETWORK,
    INSURANCE_PLANS,
    OUT_OF_NETWORK,
    PENDING,
    PROCEDURE_CODES,
    SPECIALTIES,
    STATES,
)


def _id() -> Column:
    return F.col("id")


def _text(number: Column) -> Column:
    return number.cast("string")


def _day(first: str, offset: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), offset.cast("int"))


def providers(ids: DataFrame) -> DataFrame:
    n = _id()
    return ids.select(
        padded("PRV", n, 8).alias("provider_id"),
        F.concat(F.lit("Dr. Provider "), _text(n)).alias("provider_name"),
        pick(SPECIALTIES, n).alias("specialty"),
        padded("NPI", n, 10).alias("npi"),
        F.when(n % 100 < 82, IN_NETWORK).otherwise(OUT_OF_NETWORK).alias("network_status"),
        pick(STATES, n).alias("state"),
        F.concat(F.lit("Hospital System "), _text(n % 50)).alias("hospital_affil"),
    )


def patients(ids: DataFrame) -> DataFrame:
    n = _id()
    return ids.select(
        padded("PAT", n, 8).alias("patient_id"),
        F.concat(F.lit("FirstName"), _text(n)).alias("first_name"),
        F.concat(F.lit("LastName"), _text(n)).alias("last_name"),
        _day("1930-01-01", n % 25550).alias("dob"),
        F.when(n % 2 == 0, "M").otherwise("F").alias("gender"),
        F.concat(_text(n % 9999), F.lit(" Main St")).alias("address"),
        F.concat(F.lit("City"), _text(n % 500)).alias("city"),
        pick(STATES, n).alias("state"),
        F.lpad(_text(10000 + n % 89999), 5, "0").alias("zip_code"),
        pick(INSURANCE_PLANS, n).alias("insurance_plan"),
        (n % 9).cast("int").alias("chronic_conditions"),
    )


def bell_amount(n: Column) -> Column:
    """A half-normal amount of at least 200, from sixteen uniform hash bytes.

    A seeded ``randn`` would depend on the partitioning; the sum of hash
    bytes is bell-shaped and depends on the id alone.
    """
    digest = F.md5(_text(n))
    total = sum(
        (F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("int") for i in range(16)), start=F.lit(0)
    )
    # Mean 16 * 127.5, variance 16 * (256^2 - 1) / 12.
    return F.round(F.abs(total - 2040) * 5000 / F.lit(295.6).cast("double") + 200, 2)


def claims(ids: DataFrame, patients_n: int, providers_n: int) -> DataFrame:
    n = _id()
    return ids.select(
        n.alias("id"),
        padded("PAT", n % patients_n, 8).alias("patient_id"),
        padded("PRV", n % providers_n, 8).alias("provider_id"),
        pick([d[0] for d in DIAGNOSES], n).alias("diagnosis_code"),
        pick(PROCEDURE_CODES, n).alias("procedure_code"),
        _day("2020-01-01", n % 1825).alias("claim_date"),
        bell_amount(n).alias("claim_amount"),
        F.when(n % 100 < 78, APPROVED).when(n % 100 < 93, DENIED).otherwise(PENDING).alias("claim_status"),
        F.concat(F.lit("PAYER"), _text(n % 10)).alias("payer_id"),
        _day("1930-01-01", n % 25550).alias("dob"),
        F.lpad(_text(n % 9999), 4, "0").alias("ssn_last4"),
        F.concat(_text(n % 9999), F.lit(" Main St")).alias("patient_address"),
    )


def inflate(base: DataFrame, times: int) -> DataFrame:
    """``times`` copies of each base claim, each with an id of its own.

    The copies are exploded where the row is: nothing is joined or shuffled.
    """
    copies = base.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    number = F.col("id") * times + F.col("_copy")
    return copies.select(padded("CLM", number, 15).alias("claim_id"), *[c for c in base.columns if c != "id"])


def admissions(ids: DataFrame, patients_n: int, providers_n: int) -> DataFrame:
    n = _id()
    arrived = F.lit("2023-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=(n % 8760).cast("int"))
    return ids.select(
        padded("ER", n, 10).alias("admission_id"),
        padded("PAT", n % patients_n, 8).alias("patient_id"),
        pick(DEPARTMENTS, n).alias("department"),
        (n % 5 + 1).cast("int").alias("severity"),
        arrived.alias("admitted_at"),
        (arrived + F.make_interval(hours=(n % 72 + 1).cast("int"))).alias("discharged_at"),
        padded("PRV", n % providers_n, 8).alias("provider_id"),
        pick([d[0] for d in DIAGNOSES], n).alias("diagnosis_code"),
    )


def diagnoses(spark: SparkSession) -> DataFrame:
    rows = [(code, text, group, None, None) for code, text, group in DIAGNOSES]
    schema = "icd10_code STRING, description STRING, category STRING, chronic_flag BOOLEAN, ai_description STRING"
    return spark.createDataFrame(rows, schema)
