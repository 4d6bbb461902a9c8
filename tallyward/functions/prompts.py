"""Prompt and response columns. Templates are arguments with defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DESCRIBE = (
    "Describe the %s condition %s (%s), category %s, for a clinician: what it is, its features and its management. "
    "At most three sentences, no bullets."
)
EXPLAIN = (
    "Explain code %s (%s) to a patient. Answer as JSON with the keys plain_english, symptoms and treatment, "
    "one sentence each."
)
TRIAGE = (
    "Rate the triage priority of a patient with diagnosis %s, severity %s/5 and %s hours of stay. "
    "Answer as JSON with priority (IMMEDIATE, URGENT, LESS_URGENT or NON_URGENT) and a one-sentence rationale."
)
SUMMARIZE = "Summarize these claims of one patient for a care manager in two or three sentences: %s"
ANSWER = "Answer the question from the context. Say so if the context does not suffice.\nCONTEXT:\n%s\nCLAIMS:\n%s\nQUESTION: %s"

EXPLAIN_SCHEMA = "plain_english STRING, symptoms STRING, treatment STRING"
TRIAGE_SCHEMA = "priority STRING, rationale STRING"


def describe_prompt(template: str = DESCRIBE) -> Column:
    kind = F.when(F.col("chronic_flag"), "chronic").otherwise("acute")
    return F.format_string(template, kind, F.col("icd10_code"), F.col("description"), F.col("category"))


def explain_prompt(template: str = EXPLAIN) -> Column:
    return F.format_string(template, F.col("icd10_code"), F.col("description"))


def triage_prompt(template: str = TRIAGE) -> Column:
    hours = F.coalesce(F.round("los_hours", 1).cast("string"), F.lit("unknown"))
    return F.format_string(template, F.col("diagnosis_code"), F.col("severity").cast("string"), hours)


def parsed(response: Column, schema: str) -> Column:
    """All fields of a JSON answer in one parse; NULL fields if it is not JSON."""
    return F.from_json(response, schema)
