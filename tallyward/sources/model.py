"""The claims model read from order, part, supplier and event tables.

Order lines are claims, customers are patients, suppliers are providers, parts
are diagnosis codes and events are emergency admissions. Business keys are
strings, as in the declared schemas. Each view is lazy, reads only the columns
that its consumer keeps, and has a SQL twin in ``queries/views_sql.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.expressions import padded, stay_seconds
from tallyward.functions.fixed_values import APPROVED, DENIED, IN_NETWORK, OUT_OF_NETWORK, PENDING
from tallyward.operators.history import scd2_versions
from tallyward.operators.hotkeys import ROWS
from tallyward.operators.keyed import latest_per_key
from tallyward.sources.tables import table

CLAIM_KEY = ["l_orderkey", "l_linenumber"]


def text(c: str) -> Column:
    return F.col(c).cast("string")


def claim_newest() -> list[Column]:
    """Latest load first. The price settles equal dates, so the order is total."""
    return [F.col("l_shipdate").desc(), F.col("l_extendedprice").desc()]


def as_claims(lines: DataFrame, orders: DataFrame, *also: str) -> DataFrame:
    """Claims of order lines; ``also`` names columns to carry along."""
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("claim_id"),
        text("o_custkey").alias("patient_id"),
        text("l_suppkey").alias("provider_id"),
        text("l_partkey").alias("diagnosis_code"),
        F.concat(F.lit("P"), text("l_linenumber")).alias("procedure_code"),
        F.to_date("o_orderdate").alias("claim_date"),
        F.col("l_extendedprice").alias("claim_amount"),
        F.when(F.col("l_returnflag") == "A", APPROVED)
        .when(F.col("l_returnflag") == "R", DENIED)
        .otherwise(PENDING)
        .alias("claim_status"),
        F.col("o_orderpriority").alias("payer_id"),
        F.date_add(F.lit("1930-01-01").cast("date"), (F.col("o_custkey") % 25550).cast("int")).alias("dob"),
        F.lpad((F.col("o_custkey") % 9999).cast("string"), 4, "0").alias("ssn_last4"),
        F.concat((F.col("o_custkey") % 9999).cast("string"), F.lit(" Main St")).alias("patient_address"),
        F.col("l_shipdate").cast("timestamp").alias("_ingest_ts"),
        *also,
    )


def claims_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """All claim rows, repeated loads included."""
    return as_claims(table(spark, folder, "lineitem"), table(spark, folder, "orders"))


def claims_fact(spark: SparkSession, folder: str) -> DataFrame:
    """One row per claim, the latest load.

    Duplicates go before the join: the dedup key spreads the lines of one
    large order over tasks, and repeated rows are not joined at all.
    """
    lines = latest_per_key(table(spark, folder, "lineitem"), CLAIM_KEY, claim_newest())
    return as_claims(lines, table(spark, folder, "orders"))


def busy_patients(spark: SparkSession, folder: str, at_least: int) -> DataFrame:
    """Patients with many claim loads, from counts per order: two columns are
    read, and no claim is deduplicated or joined to find them."""
    per_order = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_lines"))
    orders = table(spark, folder, "orders").select("o_orderkey", text("o_custkey").alias("patient_id"))
    counted = (
        orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("patient_id")
        .agg(F.sum("_lines").alias(ROWS))
    )
    return counted.filter(F.col(ROWS) >= at_least)


def provider_dim(spark: SparkSession, folder: str) -> DataFrame:
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return (
        table(spark, folder, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            text("s_suppkey").alias("provider_id"),
            F.col("s_name").alias("provider_name"),
            F.col("r_name").alias("specialty"),
            padded("NPI", F.col("s_suppkey"), 10).alias("npi"),
            F.when(F.col("s_suppkey") % 100 < 82, IN_NETWORK).otherwise(OUT_OF_NETWORK).alias("network_status"),
            F.col("n_name").alias("state"),
        )
    )


PATIENT_KEY, PATIENT_SEQUENCE, PATIENT_TRACKED = ["patient_id"], ["event_date", "event_no"], ["insurance_plan"]


def patient_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change events of patients: each order may change the plan."""
    return table(spark, folder, "orders").select(
        text("o_custkey").alias("patient_id"),
        F.col("o_orderpriority").alias("insurance_plan"),
        F.col("o_totalprice").alias("last_billed"),
        (F.col("o_custkey") % 9).cast("int").alias("chronic_conditions"),
        F.to_date("o_orderdate").alias("event_date"),
        F.col("o_orderkey").alias("event_no"),
    )


def patient_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Versioned patients; names come from the customer table."""
    versions = scd2_versions(patient_changes(spark, folder), PATIENT_KEY, PATIENT_SEQUENCE, PATIENT_TRACKED)
    names = table(spark, folder, "customer").select(
        text("c_custkey").alias("patient_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
    )
    return versions.join(names, PATIENT_KEY, "left")


def diagnosis_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Codes, one in five with curated text and the rest awaiting enrichment."""
    curated = F.concat(F.lit("Curated note on "), F.col("p_name"), F.lit(" of "), F.col("p_brand"))
    return table(spark, folder, "part").select(
        text("p_partkey").alias("icd10_code"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("category"),
        (F.col("p_size") > 25).alias("chronic_flag"),
        F.when(F.col("p_partkey") % 5 == 0, curated).alias("ai_description"),
    )


def as_admissions(events: DataFrame) -> DataFrame:
    """Admissions from an event frame, batch or stream."""
    number = F.col("event_id")
    arrived = F.col("ts").cast("timestamp")
    stay = F.make_interval(hours=(number % 72 + 1).cast("int"))
    return events.select(
        text("event_id").alias("admission_id"),
        text("user_id").alias("patient_id"),
        F.col("event_type").alias("department"),
        (number % 5 + 1).cast("int").alias("severity"),
        arrived.alias("admitted_at"),
        F.when(number % 10 != 0, arrived + stay).alias("discharged_at"),
        (number % 10).cast("string").alias("provider_id"),
        (number % 200).cast("string").alias("diagnosis_code"),
        arrived.alias("_ingest_ts"),
    )


def er_admissions(spark: SparkSession, folder: str) -> DataFrame:
    return as_admissions(table(spark, folder, "events"))


def er_silver(spark: SparkSession, folder: str) -> DataFrame:
    return er_admissions(spark, folder).withColumn("los_hours", stay_seconds() / F.lit(3600.0))


def claims_unchecked(spark: SparkSession, folder: str) -> DataFrame:
    """All bronze claims with faults set into some of them, for rule checks."""
    c = claims_bronze(spark, folder)
    fault = (
        F.col("patient_id").cast("bigint") * 7
        + F.col("provider_id").cast("bigint") * 3
        + F.col("diagnosis_code").cast("bigint")
    ) % 50
    return c.select(
        F.when(fault != 0, F.col("claim_id")).alias("claim_id"),
        F.when(~fault.isin(0, 1), F.col("patient_id")).alias("patient_id"),
        F.when(fault != 2, F.col("provider_id")).alias("provider_id"),
        F.when(fault != 3, F.col("diagnosis_code")).alias("diagnosis_code"),
        F.when(fault == 4, F.lit("2014-12-31").cast("date")).otherwise(F.add_months("claim_date", 264)).alias("claim_date"),
        F.when(fault == 5, -F.col("claim_amount")).otherwise(F.col("claim_amount")).alias("claim_amount"),
        F.when(fault != 0, F.col("claim_status")).alias("claim_status"),
        "payer_id",
        F.col("claim_id").alias("load_ref"),
        F.to_date("_ingest_ts").alias("load_date"),
    )
