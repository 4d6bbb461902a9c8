"""Rewritten layouts hold the same rows; statistics describe their files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyward import schemas
from tallyward.operators import layout, skipping
from tallyward.queries.gold_queries import CLAIM_COLUMNS, monthly
from tallyward.queries.registry import query
from tallyward.session import shared_folder
from tallyward.sources import model

ALL_CLAIMS = f"SELECT {CLAIM_COLUMNS} FROM claims_fact"


def claims(spark, folder):
    return model.claims_fact(spark, folder).select(*CLAIM_COLUMNS.split(", "))


@query("clustered_gold", "monthly_claims_summary", "SELECT * FROM monthly_claims_summary")
def clustered_gold(spark, folder):
    out = shared_folder(spark, "gold")
    return spark.read.parquet(layout.write_clustered(monthly(spark, folder), out, ["claim_month", "payer_id"]))


@query("zorder_layout", "claims_fact", ALL_CLAIMS)
def zorder_layout(spark, folder):
    out = shared_folder(spark, "zorder")
    claims(spark, folder).write.parquet(f"{out}/plain")
    return spark.read.parquet(layout.z_order(spark, f"{out}/plain", f"{out}/z", ["patient_id", "claim_date"], 16))


@query("zorder_admissions", "er_silver", "SELECT admission_id, department, admitted_at FROM er_silver")
def zorder_admissions(spark, folder):
    out = shared_folder(spark, "zorder-er")
    rows = model.er_silver(spark, folder).select("admission_id", "department", "admitted_at")
    rows.write.parquet(f"{out}/plain")
    placed = spark.read.parquet(layout.z_order(spark, f"{out}/plain", f"{out}/z", ["admitted_at", "department"], 8))
    return placed.withColumn("admitted_at", F.col("admitted_at").cast("timestamp_ntz"))


@query("compact", "claims_fact", ALL_CLAIMS)
def compact(spark, folder):
    out = shared_folder(spark, "compact")
    claims(spark, folder).repartition(32, "claim_id").write.parquet(f"{out}/small")
    return spark.read.parquet(layout.compact(spark, f"{out}/small", f"{out}/large"))


@query("rebalanced_write", "claims_fact", ALL_CLAIMS)
def rebalanced_write(spark, folder):
    out = shared_folder(spark, "even")
    return spark.read.parquet(layout.rewrite_rebalanced(claims(spark, folder), out, ["patient_id"]))


@query("file_stats", "claims_fact", """
    SELECT CAST(year(claim_date) AS VARCHAR) AS label, count(*) AS row_count, min(claim_date) AS min_claim_date,
           max(claim_date) AS max_claim_date, min(patient_id) AS min_patient_id, max(patient_id) AS max_patient_id
    FROM claims_fact GROUP BY 1""")
def file_stats(spark, folder):
    """Statistics per file of a table stored by year. The year in the path labels a file; a year of many rows has
    several files, of bounded size, and their statistics are put together."""
    out, described = shared_folder(spark, "stats"), ["claim_date", "patient_id"]
    yearly = claims(spark, folder).withColumn("year", F.year("claim_date"))
    yearly.hint("rebalance", "year").write.partitionBy("year").parquet(out)
    per_file = layout.file_stats(spark.read.parquet(out), described)
    labelled = per_file.withColumn("label", F.regexp_extract("file_path", "year=(\\d+)/", 1)).drop("file_path")
    return layout.merged_stats(labelled, described, "label").select(*labelled.columns)


@query("lookup_probe", "claims_fact", """
    SELECT 'plain' AS layout, count(*) AS rows_found, false AS fewer_files FROM claims_fact WHERE patient_id = '7'
    UNION ALL SELECT 'z', count(*), true FROM claims_fact WHERE patient_id = '7'""")
def lookup_probe(spark, folder):
    """Rows of a patient in the files that a lookup opens, and whether these
    are fewer than without the layout."""
    out = shared_folder(spark, "probe")
    claims(spark, folder).repartition(16, "claim_id").write.parquet(f"{out}/plain")
    layout.z_order(spark, f"{out}/plain", f"{out}/z", ["patient_id", "claim_date"], 16)
    may_hold = F.lit("7").between(F.col("min_patient_id"), F.col("max_patient_id"))

    def probe(name):
        stored = spark.read.parquet(f"{out}/{name}")
        stats = layout.file_stats(stored, ["patient_id"])
        read = layout.files_to_read(stats, "patient_id", "7").select(F.lit(name).alias("layout"), "files_read")
        mine = stored.filter(F.col("patient_id") == "7").groupBy(F.col("_metadata.file_path").alias("file_path")).count()
        found = stats.filter(may_hold).join(mine, "file_path").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows_found"))
        return read.withColumn("rows_found", found.scalar())

    plain = probe("plain")
    both = plain.unionByName(probe("z"))
    before = plain.select("files_read").scalar()
    return both.select("layout", "rows_found", (F.col("files_read") < before).alias("fewer_files"))


@query("point_lookup", "claims_fact", "SELECT count(*) AS claims FROM claims_fact WHERE patient_id = '7'")
def point_lookup(spark, folder):
    return model.claims_fact(spark, folder).filter(F.col("patient_id") == "7").agg(F.count(F.lit(1)).alias("claims"))


@query("point_lookup_skipped", "claims_fact", """
    SELECT CAST(i AS VARCHAR) AS patient_id, (SELECT count(*) FROM claims_fact f WHERE f.patient_id = CAST(i AS VARCHAR)) AS claims,
           true AS opens_few FROM (SELECT unnest(range(1, 6)) AS i)
    UNION ALL SELECT 'absent', 0, true""")
def point_lookup_skipped(spark, folder):
    """Claims written for lookups by patient. Only files that the statistics
    beside the table leave are opened; of fifty patients that are within the
    range of files but in none, hardly one opens a file."""
    out = f"{shared_folder(spark, 'lookup')}/t"
    skipping.write_for_lookup(model.claims_fact(spark, folder).select("patient_id", "claim_id", "claim_amount"), out, "patient_id", 8, 10_000)
    files = spark.read.parquet(f"{out}_files").select("file_path").distinct().count()
    rows = []
    for patient in map(str, range(1, 6)):
        found = skipping.lookup(spark, out, "patient_id", patient).count()
        rows.append((patient, found, skipping.files_with(spark, out, patient).count() <= max(2, files // 4)))
    absent = [f"{n}x" for n in range(1, 51)]
    opened = sum(skipping.files_with(spark, out, patient).count() for patient in absent[:10])
    rows.append(("absent", sum(skipping.lookup(spark, out, "patient_id", p).count() for p in absent[:2]), opened <= 2))
    return spark.createDataFrame(rows, "patient_id STRING, claims BIGINT, opens_few BOOLEAN")


@query("catalog_statistics", "claims_fact", """
    SELECT 'claim_date' AS column_name, count(*) FILTER (claim_date IS NULL) AS null_count, CAST(min(claim_date) AS VARCHAR) AS min_value,
           CAST(max(claim_date) AS VARCHAR) AS max_value, true AS distinct_close, true AS has_histogram FROM claims_fact
    UNION ALL SELECT 'claim_amount', count(*) FILTER (claim_amount IS NULL), CAST(min(claim_amount) AS VARCHAR),
           CAST(max(claim_amount) AS VARCHAR), true, true FROM claims_fact
    UNION ALL SELECT 'payer_id', count(*) FILTER (payer_id IS NULL), NULL, NULL, true, false FROM claims_fact""")
def catalog_statistics(spark, folder):
    """What the catalog knows of a table after ANALYZE: ranges, NULLs, distinct values near the true number, histograms."""
    names = ["claim_date", "claim_amount", "payer_id"]
    name, out = f"claims_{uuid.uuid4().hex}", shared_folder(spark, "catalog")
    model.claims_fact(spark, folder).select(*names).write.mode("overwrite").parquet(out)
    spark.catalog.createTable(name, out, "parquet")
    layout.analyze(spark, name, histograms=True)
    told = layout.catalog_statistics(spark, name, names)
    true = spark.table(name).agg(*[F.countDistinct(c).alias(c) for c in names])
    true = true.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("_true")) for c in names])))
    close = F.abs(F.col("distinct_count") - F.col("_true")) <= 0.1 * F.col("_true")
    return told.join(true, "column_name").withColumn("distinct_close", close).drop("distinct_count", "_true")


@query("column_statistics", "claims_bronze", """
    SELECT 'claim_date' AS column_name, count(*) FILTER (claim_date IS NULL) AS null_count, count(DISTINCT claim_date) AS distinct_count,
           CAST(min(claim_date) AS VARCHAR) AS min_value, CAST(max(claim_date) AS VARCHAR) AS max_value FROM claims_bronze
    UNION ALL SELECT 'payer_id', count(*) FILTER (payer_id IS NULL), count(DISTINCT payer_id), min(payer_id), max(payer_id) FROM claims_bronze
    UNION ALL SELECT 'claim_status', count(*) FILTER (claim_status IS NULL), count(DISTINCT claim_status), min(claim_status),
                     max(claim_status) FROM claims_bronze""")
def column_statistics(spark, folder):
    names = ["claim_date", "payer_id", "claim_status"]
    return layout.column_statistics(model.claims_bronze(spark, folder), names, exact=tuple(names))


@query("declared_table", "provider_dim", """
    SELECT provider_id, provider_name, specialty, npi, network_status, state, CAST(NULL AS VARCHAR) AS hospital_affil,
           CAST(NULL AS TIMESTAMP) AS _updated_ts FROM provider_dim""")
def declared_table(spark, folder):
    """A table declared in the catalog before it has rows, filled in its declared form and read by name."""
    out = shared_folder(spark, "declared")
    schemas.conform(model.provider_dim(spark, folder), "provider_dim").write.mode("overwrite").parquet(out)
    name = f"declared_provider_dim_{uuid.uuid4().hex}"  # two runs at once have a table each
    schemas.create_table(spark, "provider_dim", name, out)
    rows = spark.table(name)
    return rows.withColumn("_updated_ts", F.col("_updated_ts").cast("timestamp_ntz"))
