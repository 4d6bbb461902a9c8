"""Incremental file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyward.sources.tables import REJECTED, inferred_schema, with_ingest_columns


def csv_stream(
    spark: SparkSession, folder: str, schema: StructType | None = None, schema_file: str | None = None,
    files_per_batch: int | None = None, rejects: bool = False,
) -> DataFrame:
    """New CSV files of a landing folder, with ingest columns.

    Give the declared ``schema``; only without one the types are inferred, once,
    from the whole landing folder, and kept in ``schema_file``. With ``rejects``
    the raw line of a malformed row stands in ``_bad``, which is NULL for
    sound rows, so that no unreadable value turns into a silent NULL.
    """
    schema = schema or inferred_schema(spark, folder, schema_file)
    reader = spark.readStream.option("header", True)
    if rejects:
        schema = StructType(list(schema.fields)).add(REJECTED, "string")
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
    reader = reader.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_ingest_columns(reader.csv(folder))


def table_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New files of a Parquet table, stored as a folder or as one file.

    A file source takes a single file only through a pattern, so the name is
    given as one that matches itself.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{parent}/[{name[0]}]{name[1:]}")
