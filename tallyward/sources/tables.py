"""Batch readers: tables, delimited and JSON text, rejected records."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

REJECTED = "_bad"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def inferred_schema(spark: SparkSession, folder: str, schema_file: str) -> StructType:
    """Column types of a CSV folder, inferred once and kept in ``schema_file``.

    A streaming file source needs its schema up front; the stored copy also
    keeps the types stable from one run to the next.
    """
    try:
        kept = spark.read.option("wholetext", True).text(schema_file).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = None
    if kept:
        return StructType.fromJson(json.loads(kept[0]))
    schema = spark.read.option("header", True).option("inferSchema", True).csv(folder).schema
    spark.createDataFrame([(schema.json(),)], "value STRING").coalesce(1).write.mode("overwrite").text(schema_file)
    return schema


def with_ingest_columns(df: DataFrame) -> DataFrame:
    """Load time and source file of rows that come from files."""
    return df.select("*", F.current_timestamp().alias("_ingest_ts"), F.col("_metadata.file_path").alias("_source_file"))


def csv_table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A delimited file with a header, such as the diagnosis code list."""
    return spark.read.schema(schema).option("header", True).csv(path)


def csv_with_rejects(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Typed rows, with the raw line of any malformed row in ``_bad``."""
    return (
        spark.read.schema(StructType(list(schema.fields)).add(REJECTED, "string"))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(path)
    )


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Text lines parsed as JSON; unparsable lines give NULL fields."""
    return spark.read.text(path).select(F.from_json("value", schema).alias("_r")).select("_r.*")


def diagnosis_codes(spark: SparkSession, path: str) -> DataFrame:
    schema = "icd10_code STRING, description STRING, category STRING, chronic_flag BOOLEAN"
    return csv_table(spark, path, schema).withColumn("ai_description", F.lit(None).cast("string"))
