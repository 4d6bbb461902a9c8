"""Upserts, slowly changing dimensions, change log and point-in-time reads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyward.functions.expressions import exact_sum, tally
from tallyward.operators import changelog, evolution, history, keyed, retention
from tallyward.operators.versions import VersionTable
from tallyward.plans import feeds
from tallyward.queries.registry import query
from tallyward.session import shared_folder, stored_copy
from tallyward.sources import model, tables

PLAN = "patient_id, insurance_plan, last_billed, chronic_conditions, event_date, event_no"
VERSION_SQL = """patient_id, insurance_plan, last_billed, chronic_conditions, event_no,
    start_at AS "__START_AT", end_at AS "__END_AT", is_current AS "__IS_CURRENT" """
VERSION_COLUMNS = [
    "patient_id", "insurance_plan", "last_billed", "chronic_conditions", "event_no",
    history.START, history.END, history.CURRENT,
]
KEY, SEQUENCE, TRACKED = model.PATIENT_KEY, model.PATIENT_SEQUENCE, model.PATIENT_TRACKED
MIDDLE = "1998-06-30"


@query("patient_change_feed", "patient_changes", f"SELECT {PLAN} FROM patient_changes WHERE patient_id IS NOT NULL")
def patient_change_feed(spark, folder):
    return keyed.not_null(model.patient_changes(spark, folder), KEY)


@query("distinct_providers", "claims_bronze", "SELECT DISTINCT provider_id FROM claims_bronze")
def distinct_providers(spark, folder):
    return keyed.distinct_keys(model.claims_bronze(spark, folder).select("provider_id"), ["provider_id"])


_NONE = "CAST(NULL AS VARCHAR)"


@query("provider_change_feed", "claims_bronze", f"""
    SELECT DISTINCT provider_id, {_NONE} AS provider_name, {_NONE} AS specialty, {_NONE} AS npi,
           'IN_NETWORK' AS network_status, {_NONE} AS state, {_NONE} AS hospital_affil, ingest_ts AS _updated_ts FROM claims_bronze""")
def provider_change_feed(spark, folder):
    feed = feeds.provider_changes(model.claims_bronze(spark, folder))
    return feed.withColumn("_updated_ts", F.col("_updated_ts").cast("timestamp_ntz"))


@query("member_change_feed", "claims_bronze", f"""
    SELECT DISTINCT patient_id, {_NONE} AS first_name, {_NONE} AS last_name, dob, {_NONE} AS gender, patient_address AS address,
           {_NONE} AS city, {_NONE} AS state, {_NONE} AS zip_code, {_NONE} AS insurance_plan, 0 AS chronic_conditions,
           ingest_ts AS _updated_ts FROM claims_bronze""")
def member_change_feed(spark, folder):
    feed = feeds.patient_changes(model.claims_bronze(spark, folder))
    return feed.withColumn("_updated_ts", F.col("_updated_ts").cast("timestamp_ntz"))


@query("provider_feed_applied", "claims_bronze provider_dim", """
    SELECT d.provider_id, provider_name, specialty, npi, CASE WHEN f.provider_id IS NULL THEN network_status ELSE 'IN_NETWORK' END
           AS network_status, state, coalesce(f.at, TIMESTAMP '1990-01-01') AS _updated_ts
    FROM provider_dim d LEFT JOIN (SELECT provider_id, max(ingest_ts) AS at FROM claims_bronze GROUP BY ALL) f
    ON d.provider_id = f.provider_id""")
def provider_feed_applied(spark, folder):
    """The feed knows only the network status; stored attributes survive its NULLs."""
    dim = model.provider_dim(spark, folder).withColumn("_updated_ts", F.lit("1990-01-01").cast("timestamp"))
    feed = feeds.provider_changes(model.claims_bronze(spark, folder)).drop("hospital_affil")
    done = history.scd1_apply(dim, feed, ["provider_id"], ["_updated_ts"], ignore_nulls=True)
    return done.withColumn("_updated_ts", F.col("_updated_ts").cast("timestamp_ntz"))


@query("scd1_apply", "patient_changes", f"""
    SELECT {PLAN} FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY event_date DESC, event_no DESC) AS rn
    FROM patient_changes) WHERE rn = 1""")
def scd1_apply(spark, folder):
    """Late half first, early half second: the later event must still win."""
    feed = model.patient_changes(spark, folder)
    late = history.scd1_apply(None, feed.filter(F.col("event_date") > MIDDLE), KEY, SEQUENCE)
    return history.scd1_apply(late, feed.filter(F.col("event_date") <= MIDDLE), KEY, SEQUENCE)


@query("scd1_ignore_nulls", "patient_changes", """
    SELECT patient_id, arg_max(insurance_plan, seq) FILTER (insurance_plan <> '5-LOW') AS insurance_plan,
           max(event_date) AS event_date, arg_max(event_no, seq) AS event_no
    FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY event_date, event_no) AS seq FROM patient_changes)
    GROUP BY patient_id""")
def scd1_ignore_nulls(spark, folder):
    """Feeds that lack a value keep the one before."""
    plan = F.when(F.col("insurance_plan") != "5-LOW", F.col("insurance_plan")).alias("insurance_plan")
    feed = model.patient_changes(spark, folder).select("patient_id", plan, "event_date", "event_no")
    early = history.scd1_apply(None, feed.filter(F.col("event_date") <= MIDDLE), KEY, SEQUENCE, ignore_nulls=True)
    return history.scd1_apply(early, feed.filter(F.col("event_date") > MIDDLE), KEY, SEQUENCE, ignore_nulls=True)


@query("scd2_apply", "patient_versions", f"SELECT {VERSION_SQL} FROM patient_versions")
def scd2_apply(spark, folder):
    feed = model.patient_changes(spark, folder)
    return history.scd2_apply(None, None, feed, KEY, SEQUENCE, TRACKED).select(*VERSION_COLUMNS)


@query("scd2_incremental", "patient_versions", f"SELECT {VERSION_SQL} FROM patient_versions")
def scd2_incremental(spark, folder):
    """Three loads out of order, cut by event and not by time, give the versions of one load."""
    feed = model.patient_changes(spark, folder)
    load = F.pmod(F.xxhash64("event_no"), F.lit(3))
    table = history.scd2_apply(None, None, feed.filter(load == 2), KEY, SEQUENCE, TRACKED)
    table = stored_copy(table, "patients")
    table = history.scd2_apply(table, feed.filter(load == 2), feed.filter(load == 0), KEY, SEQUENCE, TRACKED)
    table = stored_copy(table, "patients")
    table = history.scd2_apply(table, feed.filter(load != 1), feed.filter(load == 1), KEY, SEQUENCE, TRACKED)
    return table.select(*VERSION_COLUMNS)


@query("scd2_stored", "patient_versions", f"SELECT {VERSION_SQL} FROM patient_versions")
def scd2_stored(spark, folder):
    """The same three loads into a stored table, of which each load reads and
    replaces only the partitions that its keys are in."""
    feed = model.patient_changes(spark, folder)
    load = F.pmod(F.xxhash64("event_no"), F.lit(3))
    table = VersionTable(shared_folder(spark, "versions"), KEY, SEQUENCE, TRACKED, parts=16)
    for number, n in enumerate((2, 0, 1)):
        table.load(feed.filter(load == n), number)
    return table.state(spark).select(*VERSION_COLUMNS)


@query("scd2_current", "patient_versions", """
    SELECT patient_id, insurance_plan, start_at AS "__START_AT" FROM patient_versions WHERE is_current""")
def scd2_current(spark, folder):
    versions = history.scd2_versions(model.patient_changes(spark, folder), KEY, SEQUENCE, TRACKED)
    return history.current_rows(versions).select("patient_id", "insurance_plan", history.START)


@query("scd2_history", "patient_versions", f"SELECT {VERSION_SQL} FROM patient_versions WHERE patient_id = '1'")
def scd2_history(spark, folder):
    """The audit of one patient; the filter reaches the scan."""
    feed = model.patient_changes(spark, folder).filter(F.col("patient_id") == "1")
    return history.version_history(history.scd2_versions(feed, KEY, SEQUENCE, TRACKED)).select(*VERSION_COLUMNS)


CLAIM = "claim_id, patient_id, provider_id, claim_date, claim_amount, claim_status"


def _claims_by(spark, folder, day, earlier: bool):
    """Latest claim rows among the loads up to a day, or after it."""
    lines = tables.table(spark, folder, "lineitem")
    wanted = F.col("l_shipdate") <= F.lit(day).cast("timestamp_ntz")
    rows = model.as_claims(
        keyed.latest_per_key(lines.filter(wanted if earlier else ~wanted), model.CLAIM_KEY, model.claim_newest()),
        tables.table(spark, folder, "orders"),
    )
    return rows.select(*CLAIM.split(", "))


_HALF = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY ingest_ts DESC, claim_amount DESC) AS rn
    FROM claims_bronze WHERE ingest_ts {op} TIMESTAMP '1999-12-31') WHERE rn = 1)"""
_OLD, _NEW = _HALF.format(op="<="), _HALF.format(op=">")
SPLIT = "1999-12-31"


@query("merge_upsert", "claims_bronze", f"""
    SELECT coalesce(o.claim_id, n.claim_id) AS claim_id, coalesce(o.patient_id, n.patient_id) AS patient_id,
           coalesce(o.provider_id, n.provider_id) AS provider_id, coalesce(o.claim_date, n.claim_date) AS claim_date,
           coalesce(n.claim_amount, o.claim_amount) AS claim_amount, coalesce(n.claim_status, o.claim_status) AS claim_status
    FROM {_OLD} o FULL JOIN {_NEW} n ON o.claim_id = n.claim_id""")
def merge_upsert(spark, folder):
    old, new = _claims_by(spark, folder, SPLIT, True), _claims_by(spark, folder, SPLIT, False)
    return keyed.merge_upsert(old, new, ["claim_id"], ["claim_status", "claim_amount"], source_is_unique=True)


_MERGED = f"""SELECT count(*) AS claims, count(DISTINCT coalesce(o.claim_id, n.claim_id)) AS claim_ids,
    CAST(sum(CAST(coalesce(n.claim_amount, o.claim_amount) AS DECIMAL(18,2))) AS DOUBLE) AS amount,
    count(*) FILTER (coalesce(n.claim_status, o.claim_status) = 'PENDING') AS pending
    FROM {_OLD} o FULL JOIN {_NEW} n ON o.claim_id = n.claim_id"""


@query("merge_twice", "claims_bronze", f"""SELECT part, m.*, CAST(0 AS BIGINT) AS differing_rows
    FROM (SELECT unnest(['once', 'twice']) AS part), ({_MERGED}) m""")
def merge_twice(spark, folder):
    """The same batch merged twice leaves the table as it was: what both hold, and rows in which they differ."""
    old, new = _claims_by(spark, folder, SPLIT, True), _claims_by(spark, folder, SPLIT, False)
    columns = ["claim_status", "claim_amount"]
    once = stored_copy(keyed.merge_upsert(old, new, ["claim_id"], columns, source_is_unique=True), "merged")
    twice = keyed.merge_upsert(once, new, ["claim_id"], columns, source_is_unique=True)
    differing = changelog.snapshot_diff(once, twice, ["claim_id"]).agg(F.count(F.lit(1)).alias("differing_rows"))

    def held(part, df):
        return df.agg(
            F.count(F.lit(1)).alias("claims"), F.countDistinct("claim_id").alias("claim_ids"), exact_sum("claim_amount").alias("amount"),
            tally(F.col("claim_status") == "PENDING").alias("pending"),
        ).select(F.lit(part).alias("part"), "*")

    return held("once", once).unionByName(held("twice", twice)).withColumn("differing_rows", differing.scalar())


@query("merge_update_if", "claims_bronze", f"""
    SELECT o.claim_id, o.patient_id, o.provider_id, o.claim_date, o.claim_amount,
           CASE WHEN o.claim_status = 'PENDING' AND n.claim_id IS NOT NULL THEN n.claim_status ELSE o.claim_status END AS claim_status
    FROM {_OLD} o LEFT JOIN {_NEW} n ON o.claim_id = n.claim_id""")
def merge_update_if(spark, folder):
    """Only pending claims take the later status; nothing is inserted."""
    old, new = _claims_by(spark, folder, SPLIT, True), _claims_by(spark, folder, SPLIT, False)
    return keyed.merge_update_if(old, new, ["claim_id"], ["claim_status"], F.col("claim_status") == "PENDING")


@query("snapshot_diff", "claims_bronze", f"""
    WITH o AS (SELECT {CLAIM} FROM {_OLD}), n AS (SELECT {CLAIM} FROM {_NEW})
    SELECT *, 'delete' AS _change_type FROM o WHERE claim_id NOT IN (SELECT claim_id FROM n)
    UNION ALL SELECT *, 'insert' FROM n WHERE claim_id NOT IN (SELECT claim_id FROM o)
    UNION ALL SELECT o.*, 'update_preimage' FROM o JOIN n ON o.claim_id = n.claim_id WHERE o IS DISTINCT FROM n
    UNION ALL SELECT n.*, 'update_postimage' FROM o JOIN n ON o.claim_id = n.claim_id WHERE o IS DISTINCT FROM n""")
def snapshot_diff(spark, folder):
    old, new = _claims_by(spark, folder, SPLIT, True), _claims_by(spark, folder, SPLIT, False)
    return changelog.snapshot_diff(old, new, ["claim_id"])


@query("keyed_joins", "claims_bronze", f"""
    SELECT 'both' AS part, count(*) AS claims FROM {_OLD} o WHERE claim_id IN (SELECT claim_id FROM {_NEW})
    UNION ALL SELECT 'old_only', count(*) FROM {_OLD} o WHERE claim_id NOT IN (SELECT claim_id FROM {_NEW})
    UNION ALL SELECT 'new_only', count(*) FROM {_NEW} n WHERE claim_id NOT IN (SELECT claim_id FROM {_OLD})""")
def keyed_joins(spark, folder):
    """Inner and anti joins on the key, put together by name."""
    old, new = (_claims_by(spark, folder, SPLIT, side).select("claim_id") for side in (True, False))

    def part(name, df):
        return df.agg(F.count(F.lit(1)).alias("claims")).select(F.lit(name).alias("part"), "claims")

    return (
        part("both", old.join(new, "claim_id", "inner"))
        .unionByName(part("old_only", old.join(new, "claim_id", "left_anti")))
        .unionByName(part("new_only", new.join(old, "claim_id", "left_anti")))
    )


# A claim table with one commit per load year; a load of 49 units or more
# withdraws the claim.
LOG_COLUMNS = ["claim_id", "quantity", "amount", "status"]


def claim_log(spark, folder):
    lines = tables.table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("claim_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("status"),
        F.year("l_shipdate").cast("bigint").alias("version"),
        F.make_date(F.year("l_shipdate"), F.lit(12), F.lit(31)).cast("timestamp_ntz").alias("stamp"),
        F.col("l_shipdate").alias("loaded"),
    )
    newest = [F.col("loaded").desc(), F.col("amount").desc()]
    log = changelog.log_commits(lines, ["claim_id"], "version", "stamp", newest, F.col("quantity") >= 49)
    return log.select(*LOG_COLUMNS, *changelog.META)


_STEPS = """
    steps AS (SELECT * FROM (
        SELECT l_orderkey || '-' || l_linenumber AS claim_id, l_quantity AS quantity, l_extendedprice AS amount,
               l_returnflag AS status, year(l_shipdate) AS v,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber, year(l_shipdate)
                                  ORDER BY l_shipdate DESC, l_extendedprice DESC) AS rn
        FROM lineitem) WHERE rn = 1),
    pairs AS (SELECT *, lag({claim_id: claim_id, quantity: quantity, amount: amount, status: status})
                  OVER (PARTITION BY claim_id ORDER BY v) AS o FROM steps),
    flow AS (SELECT *, quantity >= 49 AS gone, o IS NOT NULL AND o.quantity < 49 AS had,
                    {claim_id: claim_id, quantity: quantity, amount: amount, status: status} AS n FROM pairs),
    log AS (SELECT r.claim_id AS claim_id, r.quantity AS quantity, r.amount AS amount, r.status AS status, _change_type,
                   v AS _commit_version, CAST(make_date(v, 12, 31) AS TIMESTAMP) AS _commit_timestamp
            FROM (SELECT v, o AS r, 'delete' AS _change_type FROM flow WHERE gone AND had
                  UNION ALL SELECT v, n, 'insert' FROM flow WHERE NOT gone AND NOT had
                  UNION ALL SELECT v, o, 'update_preimage' FROM flow WHERE NOT gone AND had AND o IS DISTINCT FROM n
                  UNION ALL SELECT v, n, 'update_postimage' FROM flow WHERE NOT gone AND had AND o IS DISTINCT FROM n))"""


def _state(condition: str) -> str:
    return f"""(SELECT claim_id, quantity, amount, status FROM (
        SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY v DESC) AS r FROM steps WHERE {condition})
        WHERE r = 1 AND quantity < 49)"""


@query("change_feed", "", f"WITH {_STEPS} SELECT * FROM log")
def change_feed(spark, folder):
    return claim_log(spark, folder)


@query("changes_between", "", f"WITH {_STEPS} SELECT * FROM log WHERE _commit_version BETWEEN 1998 AND 1999")
def changes_between(spark, folder):
    return changelog.changes(claim_log(spark, folder), 1998, 1999)


@query("newest_changes", "", f"""WITH {_STEPS} SELECT * FROM log WHERE _commit_version >= 1996
    ORDER BY _commit_timestamp DESC, _commit_version DESC, claim_id, _change_type LIMIT 20""")
def newest_changes(spark, folder):
    return changelog.newest_changes(claim_log(spark, folder), 1996, ["claim_id"])


@query("change_counts", "", f"WITH {_STEPS} SELECT _change_type, count(*) AS row_count FROM log WHERE _commit_version >= 1996 GROUP BY ALL")
def change_counts(spark, folder):
    return changelog.change_counts(claim_log(spark, folder), 1996)


@query("as_of_version", "", f"WITH {_STEPS} SELECT * FROM {_state('v <= 1998')}")
def as_of_version(spark, folder):
    return changelog.as_of(claim_log(spark, folder), ["claim_id"], version=1998)


@query("as_of_timestamp", "", f"WITH {_STEPS} SELECT * FROM {_state('v <= 1999')}")
def as_of_timestamp(spark, folder):
    at = F.lit("2000-06-01 00:00:00").cast("timestamp_ntz")
    return changelog.as_of(claim_log(spark, folder), ["claim_id"], timestamp=at)


@query("net_new_rows", "", f"""WITH {_STEPS} SELECT b AS rows_before, a AS rows_after, a - b AS net_new_rows
    FROM (SELECT (SELECT count(*) FROM {_state('v <= 1997')}) AS b, (SELECT count(*) FROM {_state('v <= 2000')}) AS a)""")
def net_new_rows(spark, folder):
    return changelog.net_new_rows(claim_log(spark, folder), 1997, 2000)


@query("restore_diff", "", f"""WITH {_STEPS}, o AS (FROM {_state('true')}), n AS (FROM {_state('v <= 1998')})
    SELECT *, CAST(2100 AS BIGINT) AS _commit_version, TIMESTAMP '2100-01-01' AS _commit_timestamp FROM (
        SELECT *, 'delete' AS _change_type FROM o WHERE claim_id NOT IN (SELECT claim_id FROM n)
        UNION ALL SELECT *, 'insert' FROM n WHERE claim_id NOT IN (SELECT claim_id FROM o)
        UNION ALL SELECT o.*, 'update_preimage' FROM o JOIN n ON o.claim_id = n.claim_id WHERE o IS DISTINCT FROM n
        UNION ALL SELECT n.*, 'update_postimage' FROM o JOIN n ON o.claim_id = n.claim_id WHERE o IS DISTINCT FROM n)""")
def restore_diff(spark, folder):
    stamp = F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    return changelog.restore(claim_log(spark, folder), ["claim_id"], 1998, 2100, stamp)


@query("log_history", "", f"""WITH {_STEPS} SELECT _commit_version, max(_commit_timestamp) AS _commit_timestamp,
    count(*) FILTER (_change_type = 'insert') AS rows_inserted, count(*) FILTER (_change_type = 'update_postimage') AS rows_updated,
    count(*) FILTER (_change_type = 'delete') AS rows_deleted FROM log GROUP BY _commit_version""")
def log_history(spark, folder):
    return changelog.history(claim_log(spark, folder))


_CUT = "TIMESTAMP '1999-01-01'"


@query("log_retention", "", f"""WITH {_STEPS} SELECT * FROM log WHERE _commit_timestamp >= {_CUT}
    UNION ALL SELECT * EXCLUDE (r) REPLACE ('insert' AS _change_type) FROM (
        SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY _commit_version DESC) AS r FROM log
        WHERE _commit_timestamp < {_CUT} AND _change_type <> 'update_preimage') WHERE r = 1 AND _change_type <> 'delete'""")
def log_retention(spark, folder):
    cut = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return changelog.fold_before(claim_log(spark, folder), ["claim_id"], cut)


@query("log_retention_dry_run", "", f"""WITH {_STEPS}, old AS (SELECT * FROM log WHERE _commit_timestamp < {_CUT})
    SELECT count(*) AS rows_older, count(*) - (SELECT count(*) FROM {_state('v <= 1998')}) AS rows_removed FROM old""")
def log_retention_dry_run(spark, folder):
    cut = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return changelog.fold_dry_run(claim_log(spark, folder), ["claim_id"], cut)


@query("log_retention_stored", "", f"""WITH {_STEPS}, old AS (SELECT * EXCLUDE (r) FROM (
        SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY _commit_version DESC) AS r FROM log
        WHERE _commit_timestamp < {_CUT} AND _change_type <> 'update_preimage') WHERE r = 1 AND _change_type <> 'delete'),
    per AS (SELECT _commit_version AS version, count(*) AS rows_before, max(_commit_timestamp) < {_CUT} AS o FROM log GROUP BY 1),
    kept AS (SELECT _commit_version AS version, count(*) AS k FROM old GROUP BY 1)
    SELECT version, CASE WHEN NOT o THEN 'keep' WHEN k IS NULL THEN 'delete' ELSE 'replace' END AS action, rows_before,
           CASE WHEN NOT o THEN rows_before ELSE coalesce(k, 0) END AS rows_after,
           CASE WHEN NOT o THEN rows_before ELSE coalesce(k, 0) END AS rows_stored, true AS same_state
    FROM per LEFT JOIN kept USING (version)""")
def log_retention_stored(spark, folder):
    """The stored log folded in place: what was planned for each commit, what
    its folder holds now, and whether the table it leads to is the same."""
    cut, out = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"), shared_folder(spark, "log")
    claim_log(spark, folder).write.partitionBy(changelog.VERSION).parquet(out)
    state = stored_copy(changelog.as_of(spark.read.parquet(out), ["claim_id"]), "state")
    plan = retention.fold_stored_log(spark, out, ["claim_id"], cut)
    now = spark.read.parquet(out)
    stored = now.groupBy(F.col(changelog.VERSION).cast("bigint").alias("version")).agg(F.count(F.lit(1)).alias("rows_stored"))
    differing = changelog.same_table(state, changelog.as_of(now, ["claim_id"])).agg(F.count(F.lit(1)) == 0).scalar()
    return plan.join(stored, "version", "left").withColumns({
        "rows_stored": F.coalesce("rows_stored", F.lit(0)), "same_state": differing,
    })


@query("sql_table_changes", "", f"""WITH {_STEPS} SELECT _change_type, _commit_version, count(*) AS row_count,
    CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM log WHERE _commit_version BETWEEN 1998 AND 1999 GROUP BY ALL""")
def sql_table_changes(spark, folder):
    """The change feed as a table function of SQL, over a view that is its own."""
    function = f"claim_changes_{uuid.uuid4().hex}"
    changelog.table_function(claim_log(spark, folder), function)
    return spark.sql(
        f"""SELECT _change_type, _commit_version, count(*) AS row_count, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
            FROM {function}(1998, 1999) GROUP BY ALL"""
    )


@query("evolved_loads", "claims_fact", """
    SELECT claim_id, CAST(claim_amount AS DOUBLE) AS claim_amount, n, note FROM (
        SELECT claim_id, claim_amount, CAST(1 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS note FROM claims_fact WHERE claim_status = 'APPROVED'
        UNION ALL SELECT claim_id, claim_amount, 5000000000, NULL FROM claims_fact WHERE claim_status = 'DENIED'
        UNION ALL SELECT claim_id, NULL, 3, payer_id FROM claims_fact WHERE claim_status = 'PENDING')""")
def evolved_loads(spark, folder):
    """Three loads on storage: the second has a wider number, the third one column more and one less."""
    out = shared_folder(spark, "loads")
    facts = stored_copy(model.claims_fact(spark, folder), "claims")
    amount = F.col("claim_amount")
    for k, (status, columns) in enumerate((
        ("APPROVED", [amount, F.lit(1).alias("n")]),
        ("DENIED", [amount, F.lit(5_000_000_000).alias("n")]),
        ("PENDING", [F.lit(3).cast("short").alias("n"), F.col("payer_id").alias("note")]),
    )):
        facts.filter(F.col("claim_status") == status).select("claim_id", *columns).write.parquet(f"{out}/load={k}")
    return evolution.read_loads(spark, [f"{out}/load={k}" for k in range(3)]).select("claim_id", "claim_amount", "n", "note")


@query("evolved_append", "claims_fact provider_dim", """
    SELECT provider_id, network_status, CAST(NULL AS VARCHAR) AS npi FROM provider_dim
    UNION ALL SELECT provider_id, network_status, npi FROM provider_dim""")
def evolved_append(spark, folder):
    dim = model.provider_dim(spark, folder)
    return keyed.evolve_union(
        dim.select("provider_id", "network_status"), dim.select("provider_id", "network_status", "npi")
    )
