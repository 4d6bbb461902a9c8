"""Streams that read the given tables to their end and report what was stored."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyward.functions.expressions import exact_sum
from tallyward.operators import history, layout, quality
from tallyward.operators.quality import RuleSet
from tallyward.operators.versions import VersionTable
from tallyward.queries.registry import query
from tallyward.session import shared_folder
from tallyward.sources import model
from tallyward.sources.tables import REJECTED
from tallyward.streaming import admissions, progress, sinks
from tallyward.streaming.sources import csv_stream, table_stream


def er_stream(spark, folder):
    return admissions.cleanse(model.as_admissions(table_stream(spark, f"{folder}/events.parquet")))


def patient_stream(spark, folder):
    return table_stream(spark, f"{folder}/orders.parquet").select(
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.col("o_orderpriority").alias("insurance_plan"),
        F.col("o_totalprice").alias("last_billed"),
        (F.col("o_custkey") % 9).cast("int").alias("chronic_conditions"),
        F.to_date("o_orderdate").alias("event_date"),
        F.col("o_orderkey").alias("event_no"),
    )


MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def finish(started) -> None:
    started.awaitTermination()


def plain_times(df, *names):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})


HOURLY = """SELECT date_trunc('hour', admitted_at) AS window_start, date_trunc('hour', admitted_at) + INTERVAL 1 HOUR AS window_end,
    department, count(*) AS admission_count, avg(severity) AS avg_severity,
    CAST(sum(stay_s) AS DOUBLE) / 3600.0::DOUBLE / count(stay_s) AS avg_los_hours,
    count(DISTINCT patient_id) AS unique_patients, count(*) FILTER (los_hours > 4) AS long_stay_count
    FROM er_silver GROUP BY ALL"""


@query("stream_hourly", "er_silver", f"""
    SELECT * FROM ({HOURLY}) WHERE window_end <= (SELECT max(admitted_at) FROM er_silver) - INTERVAL 2 HOUR""")
def stream_hourly(spark, folder):
    """Append output: only windows that the watermark has closed."""
    out = shared_folder(spark, "hourly")
    finish(sinks.append_table(admissions.hourly_departments(er_stream(spark, folder)), f"{out}/t", f"{out}/c"))
    return plain_times(spark.read.parquet(f"{out}/t"), "window_start", "window_end")


@query("stream_upsert", "er_silver", HOURLY)
def stream_upsert(spark, folder):
    """Update output upserted by key: every window, open ones included. The
    stored rows are per patient, so the distinct count stays exact."""
    out, keys = shared_folder(spark, "gold"), ["_w", "department", "patient_id"]
    finish(sinks.gold_upsert_stream(admissions.hourly_patients(er_stream(spark, folder)), f"{out}/t", f"{out}/c", keys))
    hourly = admissions.departments_from_patients(sinks.gold_state(spark, f"{out}/t", keys))
    return plain_times(hourly, "window_start", "window_end")


@query("batch_hourly", "er_silver", HOURLY)
def batch_hourly(spark, folder):
    return plain_times(admissions.hourly_departments(model.er_silver(spark, folder)), "window_start", "window_end")


ALERTS = """SELECT admission_id, patient_id, department, severity,
    CASE WHEN severity = 5 THEN 'CRITICAL' ELSE 'HIGH' END AS alert_level, admitted_at, provider_id, diagnosis_code,
    true AS raised_in_this_run FROM er_silver WHERE severity >= 4"""


@query("stream_alerts", "er_silver", ALERTS)
def stream_alerts(spark, folder):
    """Alerts carry the time of the batch that raised them; each run has its own."""
    out, begun = shared_folder(spark, "alerts"), datetime.now(timezone.utc)
    finish(sinks.append_table(admissions.alerts(er_stream(spark, folder)), f"{out}/t", f"{out}/c"))
    stored = spark.read.parquet(f"{out}/t")
    # a batch begins after the stream was started; clocks of driver and test are one
    raised = F.col("alert_ts").between(F.lit(begun) - F.expr("INTERVAL 1 SECOND"), F.current_timestamp())
    return plain_times(stored.withColumn("raised_in_this_run", raised).drop("alert_ts"), "admitted_at")


CLEAN = """SELECT admission_id, patient_id, department, severity, admitted_at, discharged_at, los_hours, provider_id, diagnosis_code
    FROM er_silver"""


@query("stream_cleanse", "er_silver", CLEAN)
def stream_cleanse(spark, folder):
    out = shared_folder(spark, "clean")
    checked = quality.apply_rules(er_stream(spark, folder).drop("_ingest_ts"), RuleSet.admissions())
    finish(sinks.append_table(checked, f"{out}/t", f"{out}/c"))
    return plain_times(spark.read.parquet(f"{out}/t"), "admitted_at", "discharged_at")


@query("stream_csv_ingest", "er_silver", CLEAN)
def stream_csv_ingest(spark, folder):
    """Admissions land as CSV files and are read back as a stream whose types
    are inferred once and kept."""
    out = shared_folder(spark, "csv")
    landing = model.er_admissions(spark, folder).drop("_ingest_ts")
    landing.repartition(4, "admission_id").write.option("header", True).option("timestampFormat", MICROS).csv(f"{out}/landing")
    raw = csv_stream(spark, f"{out}/landing", schema_file=f"{out}/schema", files_per_batch=2)
    ids = ["admission_id", "patient_id", "provider_id", "diagnosis_code"]
    silver = admissions.cleanse(raw.withColumns({c: F.col(c).cast("string") for c in ids}))
    finish(sinks.append_table(silver.drop("_ingest_ts", "_source_file"), f"{out}/t", f"{out}/c"))
    return plain_times(spark.read.parquet(f"{out}/t"), "admitted_at", "discharged_at")


@query("stream_malformed", "er_admissions", """
    SELECT 'sound' AS part, count(*) AS lines, CAST(sum(severity) AS BIGINT) AS severity FROM er_admissions WHERE severity <> 5
    UNION ALL SELECT 'malformed', count(*), NULL FROM er_admissions WHERE severity = 5""")
def stream_malformed(spark, folder):
    """Lines whose severity is no number keep their text and reach no table as NULL."""
    out = shared_folder(spark, "malformed")
    severity = F.when(F.col("severity") == 5, F.lit("five")).otherwise(F.col("severity").cast("string")).alias("severity")
    lines = model.er_admissions(spark, folder).select("admission_id", severity, "department")
    lines.repartition(3, "admission_id").write.option("header", True).csv(f"{out}/landing")
    declared = StructType.fromDDL("admission_id STRING, severity INT, department STRING")
    raw = csv_stream(spark, f"{out}/landing", declared, files_per_batch=1, rejects=True)
    finish(sinks.append_table(raw, f"{out}/t", f"{out}/c"))
    bad = F.col(REJECTED).isNotNull() & F.col(REJECTED).contains("five")
    part = F.when(bad, "malformed").otherwise("sound").alias("part")
    return spark.read.parquet(f"{out}/t").groupBy(part).agg(F.count(F.lit(1)).alias("lines"), F.sum("severity").alias("severity"))


@query("stream_late", "er_silver", f"""
    SELECT * FROM ({HOURLY}) WHERE window_end <= (SELECT max(admitted_at) FROM er_silver) - INTERVAL 2 HOUR""")
def stream_late(spark, folder):
    """Three files: the earlier admissions, the later ones, and a late copy of
    old ones, which the watermark drops."""
    out = shared_folder(spark, "late")
    rows = model.er_admissions(spark, folder)
    middle = rows.agg(F.expr("timestamp_micros(percentile_approx(unix_micros(admitted_at), 0.5, 1000))")).scalar()
    early = rows.filter(F.col("admitted_at") <= middle)
    # late rows are judged by the watermark of one batch before
    late = rows.filter((F.col("admitted_at") < middle - F.expr("INTERVAL 3 HOURS")) & (F.col("severity") >= 4))
    for part in (early, rows.filter(F.col("admitted_at") > middle), late):
        part.coalesce(1).write.mode("append").parquet(f"{out}/landing")
    silver = admissions.cleanse(table_stream(spark, f"{out}/landing", files_per_batch=1))
    finish(sinks.append_table(admissions.hourly_departments(silver), f"{out}/t", f"{out}/c"))
    return plain_times(spark.read.parquet(f"{out}/t"), "window_start", "window_end")


@query("stream_progress", "er_admissions", """
    WITH e AS (SELECT min(admitted_at) AS a, max(admitted_at) AS z FROM er_admissions), m AS (SELECT a + (z - a) / 2 AS middle FROM e),
    late AS (SELECT count(*) AS n FROM er_admissions, m WHERE admitted_at < middle - INTERVAL 3 HOUR AND severity >= 4)
    SELECT 0 AS batch, count(*) AS input_rows, CAST(0 AS BIGINT) AS dropped_late FROM er_admissions, m WHERE admitted_at <= middle
    UNION ALL SELECT 1, count(*), 0 FROM er_admissions, m WHERE admitted_at > middle
    UNION ALL SELECT 2, n, n FROM late""")
def stream_progress(spark, folder):
    """What the batches reported: the third holds late copies only, and the
    watermark drops them all. Batches without input are left out."""
    out = shared_folder(spark, "progress")
    rows = model.er_admissions(spark, folder).select("admission_id", "admitted_at", "severity")
    ends = rows.agg(F.min("admitted_at").alias("a"), F.max("admitted_at").alias("z"))
    middle = ends.select(F.timestamp_micros(F.expr("unix_micros(a) + (unix_micros(z) - unix_micros(a)) div 2"))).scalar()
    late = rows.filter((F.col("admitted_at") < middle - F.expr("INTERVAL 3 HOURS")) & (F.col("severity") >= 4))
    for part in (rows.filter(F.col("admitted_at") <= middle), rows.filter(F.col("admitted_at") > middle), late):
        part.coalesce(1).write.mode("append").parquet(f"{out}/landing")
    log = progress.ProgressLog(spark, f"{out}/progress")
    spark.streams.addListener(log)
    try:
        # the watermark, and not the key, must tell late rows: ids are made new by their file
        source = table_stream(spark, f"{out}/landing", files_per_batch=1)
        named = source.withColumn("admission_id", F.concat("admission_id", F.input_file_name()))
        finish(sinks.append_table(admissions.first_within_watermark(named, "admitted_at", ["admission_id"]), f"{out}/t", f"{out}/c"))
        log.wait()
    finally:
        spark.streams.removeListener(log)
    told = progress.progress(spark, f"{out}/progress").filter("input_rows > 0")
    return told.select(F.col("batch_id").cast("int").alias("batch"), "input_rows", "dropped_late")


@query("stream_restart", "er_silver", CLEAN)
def stream_restart(spark, folder):
    """A stream that stops, and goes on from its checkpoint with new files, at
    a fixed interval. Every admission is stored once."""
    out = shared_folder(spark, "restart")
    rows = model.er_admissions(spark, folder)
    half = F.pmod(F.xxhash64("admission_id"), F.lit(2)) == 0

    def start(every):
        silver = admissions.cleanse(table_stream(spark, f"{out}/landing")).drop("_ingest_ts")
        return sinks.append_table(silver, f"{out}/t", f"{out}/c", every)

    rows.filter(half).write.parquet(f"{out}/landing")
    finish(start(None))
    rows.filter(~half).write.mode("append").parquet(f"{out}/landing")
    again = start("1 second")
    try:
        again.processAllAvailable()
    finally:
        again.stop()
    return plain_times(spark.read.parquet(f"{out}/t"), "admitted_at", "discharged_at")


@query("stream_dedup", "er_admissions", "SELECT admission_id, admitted_at FROM er_admissions")
def stream_dedup(spark, folder):
    """Every admission sent twice is kept once."""
    out = shared_folder(spark, "dedup")
    rows = er_stream(spark, folder).select("admission_id", "admitted_at")
    single = admissions.first_within_watermark(rows.union(rows), "admitted_at", ["admission_id"])
    finish(sinks.append_table(single, f"{out}/t", f"{out}/c"))
    return plain_times(spark.read.parquet(f"{out}/t"), "admitted_at")


#: Bytes of stored lines behind each CSV file that lands; as text they are about five times as many.
LANDED_BYTES = 8 << 20

KEY, SEQUENCE, TRACKED = model.PATIENT_KEY, model.PATIENT_SEQUENCE, model.PATIENT_TRACKED


@query("stream_scd1", "patient_changes", """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY event_date DESC, event_no DESC) AS rn
    FROM patient_changes) WHERE rn = 1""")
def stream_scd1(spark, folder):
    out = shared_folder(spark, "scd1")
    finish(sinks.scd1_stream(patient_stream(spark, folder), f"{out}/t", f"{out}/c", KEY, SEQUENCE))
    return sinks.scd1_state(spark, f"{out}/t", KEY, SEQUENCE)


@query("stream_folded", "patient_changes", """
    SELECT 'state' AS part, count(*) AS patients, CAST(sum(event_no) AS BIGINT) AS events, CAST(NULL AS BOOLEAN) AS fewer FROM (
        SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY event_date DESC, event_no DESC) AS rn FROM patient_changes) WHERE rn = 1
    UNION ALL SELECT 'folded', NULL, NULL, true""")
def stream_folded(spark, folder):
    """Type 1 in five batches, folded after every second; readers take the
    last fold and one batch, fewer rows than all batches hold."""
    out = shared_folder(spark, "folded")
    changes = model.patient_changes(spark, folder)
    for n in range(5):
        changes.filter(F.pmod(F.xxhash64("event_no"), F.lit(5)) == n).coalesce(1).write.mode("append").parquet(f"{out}/landing")
    source = table_stream(spark, f"{out}/landing", files_per_batch=1)
    finish(sinks.scd1_stream(source, f"{out}/t", f"{out}/c", KEY, SEQUENCE, fold_every=2))
    state = sinks.scd1_state(spark, f"{out}/t", KEY, SEQUENCE).agg(
        F.count(F.lit(1)).alias("patients"), F.sum("event_no").alias("events")
    )
    every = spark.read.parquet(f"{out}/t").agg(F.count(F.lit(1)).alias("n")).scalar()
    kept = sinks.stored(spark, f"{out}/t").agg(F.count(F.lit(1)).alias("n")).select((F.col("n") < every).alias("fewer"))
    nothing = F.lit(None).cast("bigint")
    return state.select(F.lit("state").alias("part"), "patients", "events", F.lit(None).cast("boolean").alias("fewer")).unionByName(
        kept.select(F.lit("folded").alias("part"), nothing.alias("patients"), nothing.alias("events"), "fewer")
    )


@query("stream_scd2", "patient_versions", """SELECT patient_id, insurance_plan, last_billed, chronic_conditions, event_no,
    start_at AS "__START_AT", end_at AS "__END_AT", is_current AS "__IS_CURRENT" FROM patient_versions""")
def stream_scd2(spark, folder):
    out = shared_folder(spark, "scd2")
    finish(sinks.scd2_stream(patient_stream(spark, folder), f"{out}/t", f"{out}/c", KEY))
    columns = ["patient_id", "insurance_plan", "last_billed", "chronic_conditions", "event_no",
               history.START, history.END, history.CURRENT]
    return sinks.scd2_state(spark, f"{out}/t", KEY, SEQUENCE, TRACKED).select(*columns)


@query("stream_scd2_loaded", "patient_versions", """SELECT patient_id, insurance_plan, last_billed, chronic_conditions, event_no,
    start_at AS "__START_AT", end_at AS "__END_AT", is_current AS "__IS_CURRENT" FROM patient_versions""")
def stream_scd2_loaded(spark, folder):
    """Five batches of events out of order, loaded after every second: a read
    takes finished versions and works in the last batch."""
    out = shared_folder(spark, "versioned")
    changes = model.patient_changes(spark, folder)
    for n in range(5):
        changes.filter(F.pmod(F.xxhash64("event_no"), F.lit(5)) == n).coalesce(1).write.mode("append").parquet(f"{out}/landing")
    table = VersionTable(f"{out}/table", KEY, SEQUENCE, TRACKED, parts=16)
    finish(sinks.versioned_stream(
        table_stream(spark, f"{out}/landing", files_per_batch=1), f"{out}/t", f"{out}/c", table, load_every=2
    ))
    columns = ["patient_id", "insurance_plan", "last_billed", "chronic_conditions", "event_no",
               history.START, history.END, history.CURRENT]
    return sinks.versioned_state(spark, f"{out}/t", table).select(*columns)


@query("stream_quarantine", "claims_unchecked", """
    SELECT 'passed' AS part, count(*) AS rows_stored, CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM claims_unchecked
    WHERE claim_id IS NOT NULL AND patient_id IS NOT NULL AND provider_id IS NOT NULL
    UNION ALL SELECT 'claim_id_not_null', count(*), NULL FROM claims_unchecked WHERE claim_id IS NULL
    UNION ALL SELECT 'patient_id_not_null', count(*), NULL FROM claims_unchecked WHERE patient_id IS NULL
    UNION ALL SELECT 'provider_id_not_null', count(*), NULL FROM claims_unchecked WHERE provider_id IS NULL""")
def stream_quarantine(spark, folder):
    """Claims land as CSV, pass the rules as a stream in two batches and split
    in two tables. The number of files that land grows with the lines."""
    out = shared_folder(spark, "claims")
    faulty = model.claims_unchecked(spark, folder)
    files = max(4, -(-layout.folder_bytes(spark, f"{folder}/lineitem.parquet").first()["bytes"] // LANDED_BYTES))
    faulty.repartition(files, "load_ref").write.option("header", True).csv(f"{out}/landing")
    landed = len(spark.read.text(f"{out}/landing").inputFiles())
    raw = csv_stream(spark, f"{out}/landing", faulty.schema, files_per_batch=-(-landed // 2))
    finish(sinks.split_stream(raw, RuleSet.claims("DATE'2001-12-31'"), "claim_id", f"{out}/passed", f"{out}/held", f"{out}/c"))
    passed = sinks.stored(spark, f"{out}/passed").agg(
        F.count(F.lit(1)).alias("rows_stored"), exact_sum("claim_amount").alias("amount")
    )
    held = sinks.stored(spark, f"{out}/held").groupBy(F.col("dq_rule").alias("part")).agg(F.count(F.lit(1)).alias("rows_stored"))
    return passed.select(F.lit("passed").alias("part"), "rows_stored", "amount").unionByName(
        held.withColumn("amount", F.lit(None).cast("double"))
    )
