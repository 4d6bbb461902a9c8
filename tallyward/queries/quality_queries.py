"""Rule application, quarantine and violation counts."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyward.operators import quality
from tallyward.operators.quality import RuleSet
from tallyward.queries.registry import query
from tallyward.session import shared_folder
from tallyward.sources import model

AS_OF = "DATE'2019-12-31'"
COLUMNS = "claim_id, patient_id, provider_id, diagnosis_code, claim_date, claim_amount, claim_status, payer_id, load_ref, load_date"
DROPPED = "claim_id IS NULL OR patient_id IS NULL OR provider_id IS NULL"


@query("dq_pass", "claims_unchecked", f"SELECT {COLUMNS} FROM claims_unchecked WHERE NOT ({DROPPED})")
def dq_pass(spark, folder):
    return quality.apply_rules(model.claims_unchecked(spark, folder), RuleSet.claims(AS_OF))


@query("dq_quarantine", "claims_unchecked", """
    SELECT claim_id, load_ref, load_date, claim_amount, 'claim_id_not_null' AS dq_rule FROM claims_unchecked WHERE claim_id IS NULL
    UNION ALL SELECT claim_id, load_ref, load_date, claim_amount, 'patient_id_not_null' FROM claims_unchecked WHERE patient_id IS NULL
    UNION ALL SELECT claim_id, load_ref, load_date, claim_amount, 'provider_id_not_null' FROM claims_unchecked WHERE provider_id IS NULL""")
def dq_quarantine(spark, folder):
    # The record is read back from its JSON, which shows that nothing was lost.
    held = quality.quarantine(model.claims_unchecked(spark, folder), RuleSet.claims(AS_OF), "claim_id")
    record = F.from_json("raw_record", "load_ref STRING, load_date DATE, claim_amount DOUBLE")
    return held.withColumn("_r", record).select("claim_id", "_r.load_ref", "_r.load_date", "_r.claim_amount", "dq_rule")


@query("dq_any_null_key", "claims_unchecked", f"SELECT {COLUMNS} FROM claims_unchecked WHERE {DROPPED}")
def dq_any_null_key(spark, folder):
    from tallyward.operators.keyed import any_null

    return any_null(model.claims_unchecked(spark, folder), ["claim_id", "patient_id", "provider_id"])


def _metric(name: str, action: str, broken: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS rule, '{action}' AS action, count(*) AS checked, "
        f"count(*) FILTER ({broken}) AS violations FROM {source}"
    )


@query("dq_metrics", "claims_unchecked", " UNION ALL ".join([
    _metric("claim_id_not_null", "drop", "claim_id IS NULL", "claims_unchecked"),
    _metric("patient_id_not_null", "drop", "patient_id IS NULL", "claims_unchecked"),
    _metric("provider_id_not_null", "drop", "provider_id IS NULL", "claims_unchecked"),
    _metric("claim_amount_positive", "warn", "claim_amount IS NULL OR claim_amount <= 0", "claims_unchecked"),
    _metric("claim_date_valid", "warn",
            "claim_date IS NULL OR claim_date < DATE '2015-01-01' OR claim_date > DATE '2019-12-31'", "claims_unchecked"),
    _metric("claim_status_valid", "fail",
            "claim_status IS NULL OR claim_status NOT IN ('APPROVED', 'DENIED', 'PENDING')", "claims_unchecked"),
    _metric("diagnosis_code_not_null", "warn", "diagnosis_code IS NULL", "claims_unchecked"),
]))
def dq_metrics(spark, folder):
    return quality.violations(model.claims_unchecked(spark, folder), RuleSet.claims(AS_OF))


@query("er_dq_metrics", "er_admissions", " UNION ALL ".join([
    _metric("admission_id_not_null", "drop", "admission_id IS NULL", "er_admissions"),
    _metric("patient_id_not_null", "drop", "patient_id IS NULL", "er_admissions"),
    _metric("severity_range", "fail", "severity IS NULL OR severity NOT BETWEEN 1 AND 5", "er_admissions"),
    _metric("admitted_at_not_null", "drop", "admitted_at IS NULL", "er_admissions"),
    _metric("discharge_after_admit", "warn", "discharged_at <= admitted_at", "er_admissions"),
]))
def er_dq_metrics(spark, folder):
    return quality.violations(model.er_admissions(spark, folder), RuleSet.admissions())


@query("er_dq_pass", "er_admissions", """
    SELECT admission_id, patient_id, department, severity FROM er_admissions
    WHERE admission_id IS NOT NULL AND patient_id IS NOT NULL AND admitted_at IS NOT NULL""")
def er_dq_pass(spark, folder):
    good = quality.apply_rules(model.er_admissions(spark, folder), RuleSet.admissions())
    return good.select("admission_id", "patient_id", "department", "severity")


@query("dq_observed", "claims_unchecked", f"""
    SELECT 'claim_id_not_null' AS rule, count(*) FILTER (claim_id IS NULL) AS violations FROM claims_unchecked
    UNION ALL SELECT 'diagnosis_code_not_null', count(*) FILTER (diagnosis_code IS NULL) FROM claims_unchecked
    UNION ALL SELECT 'rows_stored', count(*) FROM claims_unchecked WHERE NOT ({DROPPED})""")
def dq_observed(spark, folder):
    """Violations counted in the same pass that stores the passing rows."""
    seen, out = Observation("rules"), shared_folder(spark, "observed")
    quality.apply_rules(model.claims_unchecked(spark, folder), RuleSet.claims(AS_OF), seen).write.parquet(out)
    counts = F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(seen.get[n]).cast("bigint").alias("violations"))
        for n in ("claim_id_not_null", "diagnosis_code_not_null")
    ])
    stored = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("violations")).select(F.lit("rows_stored").alias("rule"), "violations")
    return spark.range(1).select(F.inline(counts)).unionByName(stored)


@query("dq_halt", "claims_unchecked", """
    SELECT 'as they are' AS input, count(*) FILTER (claim_status IS NULL) > 0 AS halted FROM claims_unchecked
    UNION ALL SELECT 'sound', false""")
def dq_halt(spark, folder):
    """A fail rule stops the job where a row breaks it, and only there."""
    rule = [r for r in RuleSet.claims(AS_OF).rules if r.name == "claim_status_valid"]
    rows = model.claims_unchecked(spark, folder)

    def halted(df) -> bool:
        try:
            quality.halt_on_violation(df, rule).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - the error class differs by Spark version
            if "claim_status_valid" not in str(e):
                raise
            return True
        return False

    found = [("as they are", halted(rows)), ("sound", halted(rows.filter("claim_status is not null")))]
    return spark.createDataFrame(found, "input STRING, halted BOOLEAN")
