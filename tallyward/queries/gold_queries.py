"""Dedup, gold tables and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators import changelog, hotkeys, keyed
from tallyward.plans import gold, incremental, lifecycle
from tallyward.queries import views_sql
from tallyward.queries.registry import query
from tallyward.session import shared_folder, stored_copy
from tallyward.sources import model, tables

CLAIM_COLUMNS = (
    "claim_id, patient_id, provider_id, diagnosis_code, procedure_code, claim_date, claim_amount, "
    "claim_status, payer_id, dob, ssn_last4, patient_address"
)


@query("dedup_latest", "claims_fact", f"SELECT {CLAIM_COLUMNS} FROM claims_fact")
def dedup_latest(spark, folder):
    """Duplicates go on the two numbers of the line key, before orders are joined."""
    lines = keyed.dedup_latest(tables.table(spark, folder, "lineitem"), model.CLAIM_KEY, ["l_shipdate", "l_extendedprice"])
    return model.as_claims(lines, tables.table(spark, folder, "orders")).select(*CLAIM_COLUMNS.split(", "))


@query("duplicate_check", "claims_bronze",
       "SELECT count(*) AS total, count(DISTINCT claim_id) AS unique_keys FROM claims_bronze")
def duplicate_check(spark, folder):
    return keyed.duplicate_check(model.claims_bronze(spark, folder), "claim_id")


def monthly(spark, folder):
    return gold.monthly_claims_summary(model.claims_fact(spark, folder))


def performance(spark, folder):
    return gold.provider_performance(model.claims_fact(spark, folder), model.provider_dim(spark, folder))


def risk(spark, folder):
    return gold.patient_risk_scores(model.claims_fact(spark, folder), model.patient_dim(spark, folder))


def trends(spark, folder):
    return gold.diagnosis_trends(model.claims_fact(spark, folder), model.diagnosis_dim(spark, folder))


def departments(spark, folder):
    return gold.er_dept_summary(model.er_silver(spark, folder))


def network(spark, folder):
    return gold.network_utilization(model.claims_fact(spark, folder), model.provider_dim(spark, folder))


def denials(spark, folder):
    return gold.payer_denial_analysis(model.claims_fact(spark, folder))


query("monthly_claims_summary", "monthly_claims_summary", "SELECT * FROM monthly_claims_summary")(monthly)
query("provider_performance", "provider_performance", "SELECT * FROM provider_performance")(performance)
@query("provider_rank_sliced", "provider_performance", "SELECT provider_id, specialty, specialty_rank FROM provider_performance")
def provider_rank_sliced(spark, folder):
    """Every specialty of three or more providers in slices."""
    providers = model.provider_dim(spark, folder)
    crowded = stored_copy(hotkeys.hot_keys(providers, ["specialty"], 3), "crowded")
    ranked = gold.provider_performance(model.claims_fact(spark, folder), providers, crowded)
    return ranked.select("provider_id", "specialty", "specialty_rank")


query("patient_risk_scores", "patient_risk_scores", "SELECT * FROM patient_risk_scores")(risk)
query("diagnosis_trends", "diagnosis_trends", "SELECT * FROM diagnosis_trends")(trends)
query("er_dept_summary", "er_dept_summary", "SELECT * FROM er_dept_summary")(departments)
query("network_utilization", "network_utilization", "SELECT * FROM network_utilization")(network)
query("payer_denial_analysis", "payer_denial_analysis", "SELECT * FROM payer_denial_analysis")(denials)


# Claims in three commits: loads up to 1997, up to 1999, and later ones. A load
# of 49 units or more withdraws the claim.
_LEFT = """claims_left AS (SELECT * EXCLUDE (v, r, gone) FROM (
    SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY v DESC, ingest_ts DESC, claim_amount DESC) AS r FROM (
        SELECT l_orderkey || '-' || l_linenumber AS claim_id, CAST(o_custkey AS VARCHAR) AS patient_id,
               CAST(l_suppkey AS VARCHAR) AS provider_id, CAST(l_partkey AS VARCHAR) AS diagnosis_code,
               CAST(o_orderdate AS DATE) AS claim_date, l_extendedprice AS claim_amount,
               CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'R' THEN 'DENIED' ELSE 'PENDING' END AS claim_status,
               o_orderpriority AS payer_id, l_shipdate AS ingest_ts, l_quantity >= 49 AS gone,
               CASE WHEN year(l_shipdate) <= 1997 THEN 0 WHEN year(l_shipdate) <= 1999 THEN 1 ELSE 2 END AS v
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)) WHERE r = 1 AND NOT gone)"""
_FACT = ["claim_id", "patient_id", "provider_id", "diagnosis_code", "claim_date", "claim_amount", "claim_status", "payer_id"]


def claim_commits(spark, folder):
    """The change log of the three commits, stored by commit.

    The log is keyed by the two numbers of the line and not by the claim id made of them: rows joined by
    order already lie together by these numbers, so no row is shuffled again for the log."""
    year = F.year("l_shipdate")
    loads = tables.table(spark, folder, "lineitem").withColumns({
        "version": F.when(year <= 1997, 0).when(year <= 1999, 1).otherwise(2), "gone": F.col("l_quantity") >= 49,
    })
    keys = [*model.CLAIM_KEY, "version"]
    steps = keyed.latest_per_key(loads, keys, model.claim_newest())
    rows = model.as_claims(steps, tables.table(spark, folder, "orders"), *keys, "gone")
    stamp = rows.select(*_FACT, *keys, "gone", F.current_timestamp().alias("stamp"))
    log = changelog.log_commits(stamp, model.CLAIM_KEY, "version", "stamp", [F.lit(1)], F.col("gone"))
    out = shared_folder(spark, "claim-commits")
    log.select(*_FACT, *changelog.META).write.partitionBy(changelog.VERSION).parquet(out)
    return spark.read.parquet(out)


def incrementally(spark, folder, measures):
    """The state of a gold table after three batches, folded after the second."""
    log = claim_commits(spark, folder)
    table = incremental.IncrementalTable(shared_folder(spark, "incremental"), measures, parts=16)
    for number in range(3):
        table.apply(log.filter(F.col(changelog.VERSION) == number), number)
        if number == 1:
            table.fold(spark, 1)
    return table.state(spark)


@query("gold_incremental", "", views_sql.over("monthly_claims_summary", _LEFT, "SELECT * FROM monthly_claims_summary"))
def gold_incremental(spark, folder):
    return incremental.monthly_claims_summary(incrementally(spark, folder, incremental.monthly_measures()))


@query("gold_incremental_providers", "", views_sql.over("provider_performance", _LEFT, "SELECT * FROM provider_performance"))
def gold_incremental_providers(spark, folder):
    state = incrementally(spark, folder, incremental.provider_measures())
    return incremental.provider_performance(state, model.provider_dim(spark, folder))


@query("gold_incremental_patients", "", views_sql.over("patient_risk_scores", _LEFT, "SELECT * FROM patient_risk_scores"))
def gold_incremental_patients(spark, folder):
    """Last claim dates too, which move back where the newest claim is withdrawn."""
    state = incrementally(spark, folder, incremental.patient_measures())
    return incremental.patient_risk_scores(state, model.patient_dim(spark, folder))


@query("gold_incremental_denials", "", views_sql.over("payer_denial_analysis", _LEFT, "SELECT * FROM payer_denial_analysis"))
def gold_incremental_denials(spark, folder):
    return incremental.payer_denial_analysis(incrementally(spark, folder, incremental.denial_measures()))


@query("latest_months", "monthly_claims_summary", """
    SELECT claim_month, payer_id, total_claims, approval_rate_pct FROM monthly_claims_summary
    ORDER BY claim_month DESC, payer_id LIMIT 5""")
def latest_months(spark, folder):
    return gold.latest_months(monthly(spark, folder))


@query("top_providers", "provider_performance", """
    SELECT provider_id, specialty, total_claims, approval_rate_pct, specialty_rank, total_billed
    FROM provider_performance ORDER BY total_billed DESC, provider_id LIMIT 5""")
def top_providers(spark, folder):
    return gold.top_providers(performance(spark, folder))


@query("top_diagnoses", "diagnosis_trends", """
    SELECT claim_month, diagnosis_code, diagnosis_description, claim_count FROM diagnosis_trends
    ORDER BY claim_count DESC, diagnosis_code, claim_month LIMIT 5""")
def top_diagnoses(spark, folder):
    return gold.top_diagnoses(trends(spark, folder))


@query("risk_tier_rollup", "patient_risk_scores", """
    SELECT risk_tier, count(*) AS patient_count,
           CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_spend
    FROM patient_risk_scores GROUP BY risk_tier""")
def risk_tier_rollup(spark, folder):
    return gold.risk_tier_rollup(risk(spark, folder))


@query("er_department_rollup", "er_dept_summary", """
    SELECT department, CAST(sum(total_admissions) AS BIGINT) AS admissions, round(avg(avg_los_hours), 1) AS avg_los
    FROM er_dept_summary GROUP BY department""")
def er_department_rollup(spark, folder):
    return gold.department_rollup(departments(spark, folder))


@query("network_rollup", "network_utilization", """
    SELECT network_status, CAST(sum(claim_count) AS BIGINT) AS claims,
           round(CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / 1e6, 2) AS total_amount_m
    FROM network_utilization GROUP BY network_status""")
def network_rollup(spark, folder):
    return gold.network_rollup(network(spark, folder))


@query("payer_rollup", "payer_denial_analysis", """
    SELECT payer_id, CAST(sum(total_claims) AS BIGINT) AS claims,
           round(CAST(sum(CAST(denial_rate_pct AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS avg_denial_rate
    FROM payer_denial_analysis GROUP BY payer_id""")
def payer_rollup(spark, folder):
    return gold.payer_rollup(denials(spark, folder))


@query("claim_stats", "diagnosis_trends", """
    SELECT diagnosis_code, CAST(sum(claim_count) AS BIGINT) AS total_claims,
           round(CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / 1e6, 2) AS total_amount_m,
           round(CAST(sum(CAST(avg_amount AS DECIMAL(28,8))) AS DOUBLE) / count(avg_amount), 0) AS avg_claim_amount
    FROM diagnosis_trends GROUP BY diagnosis_code""")
def claim_stats(spark, folder):
    return gold.claim_stats(trends(spark, folder))


GOLD = {
    "monthly_claims_summary": monthly,
    "provider_performance": performance,
    "patient_risk_scores": risk,
    "diagnosis_trends": trends,
    "er_dept_summary": departments,
    "network_utilization": network,
    "payer_denial_analysis": denials,
}
#: Rows wanted of some gold tables; no data reach the last one.
WANTED = {"monthly_claims_summary": 100, "provider_performance": 10, "payer_denial_analysis": 10**12}


@query("gold_row_counts", " ".join(GOLD), "SELECT *, CASE WHEN row_count >= coalesce(expected * 0.99, 1) THEN 'OK' ELSE 'LOW' END AS status FROM ("
       + " UNION ALL ".join(
           f"SELECT '{n}' AS table_name, count(*) AS row_count, CAST({WANTED.get(n, 'NULL')} AS BIGINT) AS expected FROM {n}" for n in GOLD
       ) + ")")
def gold_row_counts(spark, folder):
    return gold.row_counts({n: f(spark, folder) for n, f in GOLD.items()}, WANTED)


# Every written gold table in three numbers: rows, a count and an amount.
MEASURES = {
    "monthly_claims_summary": ("total_claims", "total_amount"),
    "provider_performance": ("total_claims", "total_billed"),
    "patient_risk_scores": ("total_claims", "total_spend"),
    "diagnosis_trends": ("claim_count", "total_amount"),
    "er_dept_summary": ("total_admissions", "avg_los_hours"),
    "network_utilization": ("claim_count", "total_amount"),
    "payer_denial_analysis": ("denied_count", "denied_amount"),
}


@query("pipeline_batch_gold", " ".join(GOLD) + " claims_bronze", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, CAST(sum({c}) AS BIGINT) AS total, "
    f"CAST(sum(CAST({m} AS DECIMAL(28,6))) AS DOUBLE) AS amount, true AS stamped FROM {n}" for n, (c, m) in MEASURES.items()))
def pipeline_batch_gold(spark, folder):
    """The whole batch life cycle, and what its gold tables hold."""
    paths = lifecycle.run(
        spark, model.claims_bronze(spark, folder), model.er_silver(spark, folder),
        {"providers": model.provider_dim(spark, folder), "patients": model.patient_dim(spark, folder),
         "diagnoses": model.diagnosis_dim(spark, folder)},
        shared_folder(spark, "lifecycle"), "DATE'2001-12-31'",
    )
    lines = None
    for name, (count, amount) in MEASURES.items():
        line = spark.read.parquet(paths[name]).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(count).cast("bigint").alias("total"),
            F.sum(F.col(amount).cast("decimal(28,6)")).cast("double").alias("amount"),
            (F.count("_updated_ts") == F.count(F.lit(1))).alias("stamped"),
        ).select(F.lit(name).alias("table_name"), "row_count", "total", "amount", "stamped")
        lines = line if lines is None else lines.unionByName(line)
    return lines


_PASSED = """claims_left AS (SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY load_date DESC, claim_amount DESC) AS r FROM claims_unchecked
    WHERE claim_id IS NOT NULL AND patient_id IS NOT NULL AND provider_id IS NOT NULL) WHERE r = 1)"""


def _landed_sql() -> str:
    body = lambda name: f"{name} AS ({views_sql.VIEWS[name][1].replace('claims_fact', 'claims_left')})"
    return f"""WITH {_PASSED}, {body("monthly_claims_summary")}, {body("provider_performance")}, {body("patient_risk_scores")}
        SELECT 'monthly_claims_summary' AS table_name, count(*) AS row_count, CAST(sum(total_claims) AS BIGINT) AS claims,
               CAST(sum(CAST(total_amount AS DECIMAL(28,2))) AS DOUBLE) AS amount, CAST(sum(unique_patients) AS BIGINT) AS marks
        FROM monthly_claims_summary
        UNION ALL SELECT 'provider_performance', count(*), CAST(sum(total_claims) AS BIGINT),
               CAST(sum(CAST(total_billed AS DECIMAL(28,2))) AS DOUBLE), CAST(sum(specialty_rank) AS BIGINT) FROM provider_performance
        UNION ALL SELECT 'patient_risk_scores', count(*), CAST(sum(total_claims) AS BIGINT),
               CAST(sum(CAST(total_spend AS DECIMAL(28,2))) AS DOUBLE), count(*) FILTER (risk_tier = 'HIGH') FROM patient_risk_scores
        UNION ALL SELECT 'quarantine', count(*), NULL, NULL, NULL FROM (
            SELECT unnest([claim_id, patient_id, provider_id]) AS k FROM claims_unchecked) WHERE k IS NULL"""


@query("landing_to_gold", "claims_unchecked provider_dim patient_dim", _landed_sql())
def landing_to_gold(spark, folder):
    """CSV files in landing folders, in two deliveries, to silver tables and gold."""
    out = shared_folder(spark, "landed")
    claims = model.claims_unchecked(spark, folder)
    providers = model.provider_dim(spark, folder).withColumn("updated_at", F.lit("2020-01-01").cast("date"))
    events = model.patient_changes(spark, folder)
    stale = providers.withColumns({"network_status": F.lit("UNKNOWN"), "updated_at": F.lit("2019-01-01").cast("date")})
    deliveries = {"claims": (claims, "load_ref"), "providers": (providers, "provider_id"), "patients": (events, "event_no")}
    feeds = {
        "claims": lifecycle.Feed(f"{out}/in/claims", claims.schema, ["claim_id"], ["load_date", "claim_amount"]),
        "providers": lifecycle.Feed(f"{out}/in/providers", providers.schema, ["provider_id"], ["updated_at"]),
        "patients": lifecycle.Feed(f"{out}/in/patients", events.schema, model.PATIENT_KEY, model.PATIENT_SEQUENCE, model.PATIENT_TRACKED),
    }
    for half in (0, 1):
        for name, (rows, key) in deliveries.items():
            if name == "providers" and half == 0:
                rows = stale  # the second delivery corrects all of the first
            elif name != "providers":
                rows = rows.filter(F.pmod(F.xxhash64(key), F.lit(2)) == half)
            rows.write.mode("append").option("header", True).csv(feeds[name].landing)
        silver = lifecycle.load_landed(spark, **feeds, folder=f"{out}/tables", as_of="DATE'2001-12-31'")
    facts = stored_copy(silver["claims"], "silver-claims")
    names = tables.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("patient_id"), F.col("c_mktsegment").alias("first_name"), F.col("c_name").alias("last_name")
    )
    patients = silver["patients"].join(names, "patient_id", "left")
    built = {
        "monthly_claims_summary": (gold.monthly_claims_summary(facts), "total_amount", F.sum("unique_patients")),
        "provider_performance": (gold.provider_performance(facts, silver["providers"]), "total_billed", F.sum("specialty_rank")),
        "patient_risk_scores": (gold.patient_risk_scores(facts, patients), "total_spend", F.count_if(F.col("risk_tier") == "HIGH")),
    }
    nothing = F.lit(None).cast("bigint")
    lines = silver["quarantine"].agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("quarantine").alias("table_name"), "row_count", nothing.alias("claims"), F.lit(None).cast("double").alias("amount"),
        nothing.alias("marks"),
    )
    for name, (df, amount, marks) in built.items():
        lines = lines.unionByName(df.agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("total_claims").cast("bigint").alias("claims"),
            F.sum(F.col(amount).cast("decimal(28,2)")).cast("double").alias("amount"), marks.cast("bigint").alias("marks"),
        ).select(F.lit(name).alias("table_name"), "*"))
    return lines


@query("source_row_counts", "", """
    SELECT *, CASE WHEN row_count >= expected * 0.99 THEN 'OK' ELSE 'LOW' END AS status FROM (
    SELECT 'lineitem' AS table_name, count(*) AS row_count, 5000::BIGINT AS expected FROM lineitem
    UNION ALL SELECT 'orders', count(*), 1000::BIGINT FROM orders
    UNION ALL SELECT 'nation', count(*), 26::BIGINT FROM nation)""")
def source_row_counts(spark, folder):
    wanted = {"lineitem": 5000, "orders": 1000, "nation": 26}
    return gold.row_counts({n: tables.table(spark, folder, n) for n in wanted}, wanted)
