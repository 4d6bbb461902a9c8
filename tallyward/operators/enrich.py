"""Model calls over a table, on the executors.

A model is any function from a list of prompts to a list of answers, ``None``
for a failed one. It is called in small batches inside ``mapInPandas``; no row
passes the driver. Write the result to a table before merging it, so that one
answer serves every use.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyward.functions import prompts
from tallyward.functions.expressions import percent
from tallyward.functions.fixed_values import MODEL_BATCH, MODEL_TRIES, PREVIEW_CHARS, TRIAGE_LEVELS, TRIAGE_MIN_SEVERITY
from tallyward.operators import hotkeys
from tallyward.operators.keyed import merge_update_if

Model = Callable[[list[str]], list[str | None]]


def offline_text(batch: list[str]) -> list[str | None]:
    """Stands in for a text model: a fixed answer made from the prompt."""
    return [f"Answer to: {p}" for p in batch]


def offline_explanation(batch: list[str]) -> list[str | None]:
    return [json.dumps({"plain_english": p, "symptoms": f"{len(p)} characters", "treatment": "rest"}) for p in batch]


def offline_triage(batch: list[str]) -> list[str | None]:
    """Stands in for a classifier: the severity in the prompt decides."""
    answers = []
    for p in batch:
        found = re.search(r"severity (\d)/5", p)
        level = TRIAGE_LEVELS[min(3, max(0, 5 - int(found.group(1))))] if found else None
        answers.append(json.dumps({"priority": level, "rationale": f"severity {found.group(1)} of 5"}) if level else None)
    return answers


def _ask(model: Model, batch: list[str], tries: int, pause: float) -> list[str | None]:
    for attempt in range(tries):
        try:
            answers = list(model(batch))
            return answers if len(answers) == len(batch) else [None] * len(batch)
        except TimeoutError:
            if attempt + 1 < tries:
                time.sleep(pause * 2**attempt)
        except Exception:  # noqa: BLE001 - a failed call leaves NULL for the next run
            break
    return [None] * len(batch)


def ask_model(
    df: DataFrame,
    prompt: Column,
    model: Model,
    out: str = "response",
    batch: int = MODEL_BATCH,
    tries: int = MODEL_TRIES,
    pause: float = 1.0,
    tasks: int | None = None,
) -> DataFrame:
    """Add the model's answer to each row. Timeouts are tried again with
    growing pauses; any other failure gives NULL. ``tasks`` spreads the rows
    first, so that a small table still has many calls under way at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            asked = frame.pop("_prompt").tolist()
            answers: list[str | None] = []
            for i in range(0, len(asked), batch):
                answers.extend(_ask(model, asked[i : i + batch], tries, pause))
            yield frame.assign(**{out: pd.Series(answers, index=frame.index, dtype=object)})

    schema = StructType([*df.schema.fields, StructField(out, StringType())])
    spread = df.repartition(tasks) if tasks else df
    return spread.withColumn("_prompt", prompt).mapInPandas(run, schema)


def pending(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("ai_description").isNull()).select("icd10_code", "description", "category", "chronic_flag")


def describe_pending(dim: DataFrame, model: Model = offline_text, tasks: int | None = None) -> DataFrame:
    """Answers for the rows that have none; failed ones stay out."""
    asked = ask_model(pending(dim), prompts.describe_prompt(), model, "ai_description", tasks=tasks)
    return asked.filter(F.col("ai_description").isNotNull()).select("icd10_code", "ai_description")


def write_back(dim: DataFrame, answers: DataFrame) -> DataFrame:
    """Fill empty descriptions; curated text is never overwritten."""
    return merge_update_if(dim, answers, ["icd10_code"], ["ai_description"], F.col("ai_description").isNull())


def explain(dim: DataFrame, model: Model = offline_explanation) -> DataFrame:
    asked = ask_model(pending(dim), prompts.explain_prompt(), model, "answer")
    return asked.select("icd10_code", "description", prompts.parsed(F.col("answer"), prompts.EXPLAIN_SCHEMA).alias("_a")).select(
        "icd10_code", "description", "_a.*"
    )


def triage(silver: DataFrame, model: Model = offline_triage) -> DataFrame:
    wanted = silver.filter(F.col("severity") >= TRIAGE_MIN_SEVERITY).select(
        "admission_id", "diagnosis_code", "severity", "los_hours"
    )
    asked = ask_model(wanted, prompts.triage_prompt(), model, "answer")
    return asked.withColumn("_a", prompts.parsed(F.col("answer"), prompts.TRIAGE_SCHEMA)).select(*wanted.columns, "_a.*")


def coverage(dim: DataFrame) -> DataFrame:
    return (
        dim.agg(F.count(F.lit(1)).alias("total_codes"), F.count("ai_description").alias("enriched_codes"))
        .withColumn("pending_codes", F.col("total_codes") - F.col("enriched_codes"))
        .withColumn("coverage_pct", percent("enriched_codes", "total_codes", 1))
    )


def preview(dim: DataFrame) -> DataFrame:
    rows = dim.filter(F.col("ai_description").isNotNull())
    return rows.select("icd10_code", "description", F.substring("ai_description", 1, PREVIEW_CHARS).alias("ai_desc_preview"))


def claim_documents(claims: DataFrame, per_part: int = 1000, hot: DataFrame | None = None) -> DataFrame:
    """The claims of each patient as JSON and as a prompt, oldest first.

    A patient with many claims gets several parts, so no row grows without
    bound and no task holds more than a slice of one patient.
    """
    known = claims.filter(F.col("patient_id").isNotNull())
    cut = hotkeys.cut_hot_keys(known, ["patient_id"], ["claim_date", "claim_id"], hot)
    placed = hotkeys.numbered(cut, ["patient_id"], ["claim_date", "claim_id"])
    entry = F.struct("_n", "claim_date", "diagnosis_code", "claim_amount", "claim_status")
    part = F.floor((F.col("_n") - 1) / per_part).cast("int")
    history = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e.dropFields("_n"))
    return (
        placed.groupBy("patient_id", part.alias("part"))
        .agg(F.count(F.lit(1)).alias("claim_count"), F.to_json(history).alias("claims_json"))
        .withColumn("prompt", F.format_string(prompts.SUMMARIZE, "claims_json"))
    )
