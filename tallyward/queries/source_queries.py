"""Text formats: the given tables written out, read back and checked."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyward.queries.registry import query
from tallyward.session import shared_folder
from tallyward.sources import tables


@query("csv_code_list", "diagnosis_dim", """
    SELECT icd10_code, description, category, chronic_flag, CAST(NULL AS VARCHAR) AS ai_description FROM diagnosis_dim""")
def csv_code_list(spark, folder):
    from tallyward.sources import model

    out = shared_folder(spark, "codes")
    model.diagnosis_dim(spark, folder).drop("ai_description").write.option("header", True).csv(out)
    return tables.diagnosis_codes(spark, out)


@query("csv_malformed", "", """
    SELECT event_id, event_id % 7 = 3 AS rejected, CASE WHEN event_id % 7 <> 3 THEN CAST(event_id % 5 AS INTEGER) END AS severity,
           event_type FROM events""")
def csv_malformed(spark, folder):
    """Rows with an unreadable number keep their raw line for quarantine."""
    out = shared_folder(spark, "rejects")
    number = F.col("event_id")
    severity = F.when(number % 7 == 3, "severe").otherwise((number % 5).cast("string")).alias("severity")
    tables.table(spark, folder, "events").select("event_id", "event_type", severity).write.option("header", True).csv(out)
    schema = StructType.fromDDL("event_id BIGINT, event_type STRING, severity INT")
    rows = tables.csv_with_rejects(spark, out, schema)
    return rows.select("event_id", F.col(tables.REJECTED).isNotNull().alias("rejected"), "severity", "event_type")


@query("json_lines", "", "SELECT conv_id, turn, role, text FROM conversations")
def json_lines(spark, folder):
    out = shared_folder(spark, "json")
    tables.table(spark, folder, "conversations").select(F.to_json(F.struct("*")).alias("value")).write.text(out)
    return tables.json_lines(spark, out, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")


@query("append_tables", "", "SELECT doc_id, quality, toxic FROM labels UNION ALL SELECT doc_id, quality, toxic FROM labels")
def append_tables(spark, folder):
    out = shared_folder(spark, "append")
    labels = tables.table(spark, folder, "labels")
    labels.write.mode("overwrite").parquet(out)
    labels.write.mode("append").parquet(out)
    return spark.read.parquet(out)


@query("ingest_columns", "", """
    SELECT priority, orders, orders AS stamped, 1::BIGINT AS files FROM (
        SELECT o_orderpriority AS priority, count(*) AS orders FROM orders GROUP BY ALL)""")
def ingest_columns(spark, folder):
    """Orders land in one CSV file per priority; each row knows its file and load time."""
    out = shared_folder(spark, "landing")
    orders = tables.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    orders.withColumn("priority", F.col("o_orderpriority")).repartition("priority").write.partitionBy("priority").option("header", True).csv(out)
    rows = tables.with_ingest_columns(tables.csv_table(spark, out, "o_orderkey BIGINT, o_orderpriority STRING"))
    return rows.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("orders"), F.count("_ingest_ts").alias("stamped"), F.countDistinct("_source_file").alias("files")
    )
