"""Masked and row-filtered claims."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyward.operators import masking
from tallyward.operators.masking import Viewer
from tallyward.queries.gold_queries import CLAIM_COLUMNS
from tallyward.queries.registry import query
from tallyward.sources import model

PERSONAL = ["dob", "patient_address"]


@query("masked_claims", "claims_fact", """
    SELECT claim_id, patient_id, DATE '1900-01-01' AS dob, 'REDACTED' AS patient_address, claim_amount FROM claims_fact""")
def masked_claims(spark, folder):
    view = masking.mask(model.claims_fact(spark, folder), PERSONAL, Viewer("analyst"))
    return view.select("claim_id", "patient_id", "dob", "patient_address", "claim_amount")


@query("unmasked_claims", "claims_fact", "SELECT claim_id, patient_id, dob, patient_address, claim_amount FROM claims_fact")
def unmasked_claims(spark, folder):
    steward = Viewer("steward", frozenset({"data_stewards"}))
    view = masking.mask(model.claims_fact(spark, folder), PERSONAL, steward)
    return view.select("claim_id", "patient_id", "dob", "patient_address", "claim_amount")


@query("sql_masked_claims", "claims_fact",
       "SELECT claim_id, DATE '1900-01-01' AS dob, 'REDACTED' AS patient_address FROM claims_fact")
def sql_masked_claims(spark, folder):
    masking.create_mask_functions(spark, Viewer("analyst"))
    return model.claims_fact(spark, folder).select(
        "claim_id",
        F.expr("mask_date(dob)").alias("dob"),
        F.expr("mask_text(patient_address)").alias("patient_address"),
    )


@query("row_filtered_claims", "claims_fact", f"SELECT {CLAIM_COLUMNS} FROM claims_fact WHERE provider_id = '7'")
def row_filtered_claims(spark, folder):
    view = masking.own_rows(model.claims_fact(spark, folder), "provider_id", Viewer("7"))
    return view.select(*CLAIM_COLUMNS.split(", "))


@query("row_filtered_privileged", "claims_fact", f"SELECT {CLAIM_COLUMNS} FROM claims_fact")
def row_filtered_privileged(spark, folder):
    manager = Viewer("manager", frozenset({"care_managers"}))
    view = masking.own_rows(model.claims_fact(spark, folder), "provider_id", manager)
    return view.select(*CLAIM_COLUMNS.split(", "))


@query("access_table_claims", "claims_fact provider_dim", """
    SELECT claim_id, provider_id, claim_amount FROM claims_fact
    WHERE provider_id IN (SELECT provider_id FROM provider_dim WHERE specialty = 'ASIA')""")
def access_table_claims(spark, folder):
    """A viewer per specialty is granted that specialty's providers."""
    grants = model.provider_dim(spark, folder).select(F.col("specialty").alias("viewer"), "provider_id")
    view = masking.rows_by_access(model.claims_fact(spark, folder), "provider_id", grants, Viewer("ASIA"))
    return view.select("claim_id", "provider_id", "claim_amount")


@query("secured_view_claims", "claims_fact", """
    SELECT claim_id, DATE '1900-01-01' AS dob, 'REDACTED' AS patient_address, claim_amount FROM claims_fact WHERE provider_id = '7'""")
def secured_view_claims(spark, folder):
    """A view with masks and row filter, read by its name."""
    name = f"secured_claims_{uuid.uuid4().hex}"  # two runs at once have a view each
    masking.secured_view(model.claims_fact(spark, folder), name, PERSONAL, "provider_id", Viewer("7"))
    return spark.sql(f"SELECT claim_id, dob, patient_address, claim_amount FROM {name}")
