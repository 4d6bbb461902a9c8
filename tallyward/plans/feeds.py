"""Dimension change feeds taken from claims.

Claims carry few attributes of a provider or patient; the others are typed
NULLs, to be applied with ``ignore_nulls`` so that known values survive. Rows
are unique per key and time, never per key alone: later changes must arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.fixed_values import IN_NETWORK
from tallyward.operators.keyed import latest_per_key, newest_first, not_null
from tallyward.schemas import schema

TIME = "_updated_ts"


def _feed(claims: DataFrame, table: str, key: str, known: dict) -> DataFrame:
    """Columns of a declared dimension: known expressions, else typed NULLs."""
    fields = [f for f in schema(table) if not f.name.startswith("__")]
    columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    rows = not_null(claims.select(*columns), [key])
    return latest_per_key(rows, [key, TIME], newest_first([TIME], rows, [key, TIME]))


def provider_changes(claims: DataFrame) -> DataFrame:
    known = {"provider_id": F.col("provider_id"), "network_status": F.lit(IN_NETWORK), TIME: F.col("_ingest_ts")}
    return _feed(claims, "provider_dim", "provider_id", known)


def patient_changes(claims: DataFrame) -> DataFrame:
    known = {
        "patient_id": F.col("patient_id"),
        "dob": F.col("dob"),
        "address": F.col("patient_address"),
        "chronic_conditions": F.lit(0),
        TIME: F.col("_ingest_ts"),
    }
    return _feed(claims, "patient_dim", "patient_id", known)
