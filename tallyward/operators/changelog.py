"""Row-level change log: production, point-in-time reads, restore, retention.

A log is a DataFrame of full rows plus ``_change_type``, ``_commit_version``
and ``_commit_timestamp``. Stored partitioned by ``_commit_version``, a read of
some versions touches only their folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.keyed import latest_per_key

TYPE, VERSION, STAMP = "_change_type", "_commit_version", "_commit_timestamp"
META = [TYPE, VERSION, STAMP]
INSERT, PRE, POST, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def _change_rows(paired: DataFrame, gone: Column, came: Column, changed: Column) -> DataFrame:
    """A row for each change of ``_old`` to ``_new``: its kind is taken first, and then the image that belongs to it."""
    kinds = F.when(gone, F.array(F.lit(DELETE))).when(came, F.array(F.lit(INSERT))).when(changed, F.array(F.lit(PRE), F.lit(POST)))
    image = F.when(F.col(TYPE).isin(DELETE, PRE), F.col("_old")).otherwise(F.col("_new"))
    return paired.withColumn(TYPE, F.explode(kinds)).withColumn("_row", image)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Changes that turn ``old`` into ``new``; equal rows yield nothing."""
    names = old.columns
    o = old.select(*keys, F.struct(*names).alias("_old"))
    n = new.select(*keys, F.struct(*names).alias("_new"))
    gone, came = F.col("_new").isNull(), F.col("_old").isNull()
    both = ~gone & ~came
    changed = o.join(n, keys, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    return _change_rows(changed, gone & ~came, came & ~gone, both).select("_row.*", TYPE)


def commit(changes: DataFrame, version: int, stamp: Column) -> DataFrame:
    return changes.withColumn(VERSION, F.lit(version).cast("bigint")).withColumn(STAMP, stamp)


def log_commits(
    rows: DataFrame, keys: list[str], version: str, stamp: str, newest_first: list[Column], deleted: Column
) -> DataFrame:
    """The change log of a table that took keyed upserts and deletes per commit.

    The last row per key and commit is kept before the shuffle; what remains
    per key is at most one row per commit, so the window below stays small.
    """
    values = [c for c in rows.columns if c not in (version, stamp)]
    steps = latest_per_key(rows, [*keys, version], newest_first).select(
        *keys, version, stamp, F.struct(*values).alias("_new"), F.coalesce(deleted, F.lit(False)).alias("_gone")
    )
    by_commit = Window.partitionBy(*keys).orderBy(version)
    prior = F.lag(F.when(~F.col("_gone"), F.col("_new"))).over(by_commit)
    paired = steps.withColumn("_old", prior)
    live, had = ~F.col("_gone"), F.col("_old").isNotNull()
    changed = live & had & ~F.col("_old").eqNullSafe(F.col("_new"))
    marked = paired.withColumns({VERSION: F.col(version).cast("bigint"), STAMP: F.col(stamp)})
    return _change_rows(marked, ~live & had, live & ~had, changed).select("_row.*", TYPE, VERSION, STAMP)


def changes(log: DataFrame, from_version: int, to_version: int | None = None) -> DataFrame:
    rows = log.filter(F.col(VERSION) >= from_version)
    return rows if to_version is None else rows.filter(F.col(VERSION) <= to_version)


def table_function(log: DataFrame, name: str) -> None:
    """A temporary SQL function ``name(from, to)`` whose rows are the changes
    of these versions; it reads the log by a view, ``<name>_log``. The version
    filter is part of the query that calls it, and so prunes stored commits."""
    log.createOrReplaceTempView(f"{name}_log")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in log.schema.fields)
    log.sparkSession.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(from_version BIGINT, to_version BIGINT) RETURNS TABLE ({columns})
            RETURN SELECT * FROM {name}_log WHERE {VERSION} BETWEEN from_version AND to_version"""
    )


def newest_changes(log: DataFrame, from_version: int, tie: list[str], limit: int = 20) -> DataFrame:
    order = [F.col(STAMP).desc(), F.col(VERSION).desc(), *[F.col(t) for t in tie], F.col(TYPE)]
    return changes(log, from_version).orderBy(*order).limit(limit)


def change_counts(log: DataFrame, from_version: int = 0) -> DataFrame:
    return changes(log, from_version).groupBy(TYPE).agg(F.count(F.lit(1)).alias("row_count"))


def as_of(
    log: DataFrame, keys: list[str], version: int | None = None, timestamp: Column | None = None
) -> DataFrame:
    """The table as it stood after a version or at a time."""
    upto = log
    if version is not None:
        upto = upto.filter(F.col(VERSION) <= version)
    if timestamp is not None:
        upto = upto.filter(F.col(STAMP) <= timestamp)
    after_images = upto.filter(F.col(TYPE) != PRE)
    last = latest_per_key(after_images, keys, [F.col(VERSION).desc()])
    return last.filter(F.col(TYPE) != DELETE).drop(*META)


def net_new_rows(log: DataFrame, from_version: int, to_version: int) -> DataFrame:
    """Row counts at two versions from the log alone: every insert adds a row
    and every delete takes one, so no state has to be rebuilt."""
    step = F.when(F.col(TYPE) == INSERT, 1).when(F.col(TYPE) == DELETE, -1).otherwise(0)

    def rows_at(v: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col(VERSION) <= v, step).otherwise(0)), F.lit(0)).cast("bigint")

    return log.agg(rows_at(from_version).alias("rows_before"), rows_at(to_version).alias("rows_after")).withColumn(
        "net_new_rows", F.col("rows_after") - F.col("rows_before")
    )


def restore(log: DataFrame, keys: list[str], version: int, new_version: int, stamp: Column) -> DataFrame:
    """The changes to append, as a new commit, to return to ``version``."""
    return commit(snapshot_diff(as_of(log, keys), as_of(log, keys, version=version), keys), new_version, stamp)


def history(log: DataFrame) -> DataFrame:
    """One row per commit with the rows of each change type."""
    return log.groupBy(VERSION).agg(
        F.max(STAMP).alias(STAMP),
        F.count_if(F.col(TYPE) == INSERT).alias("rows_inserted"),
        F.count_if(F.col(TYPE) == POST).alias("rows_updated"),
        F.count_if(F.col(TYPE) == DELETE).alias("rows_deleted"),
    )


def fold_before(log: DataFrame, keys: list[str], cutoff: Column) -> DataFrame:
    """Drop history older than ``cutoff``, keeping the state it led to.

    Rows at or after the cutoff stay. Older rows shrink to the last image per
    key, stored as inserts; keys deleted by then vanish.
    """
    recent = log.filter(F.col(STAMP) >= cutoff)
    older = log.filter((F.col(STAMP) < cutoff) & (F.col(TYPE) != PRE))
    base = latest_per_key(older, keys, [F.col(VERSION).desc()]).filter(F.col(TYPE) != DELETE)
    return base.withColumn(TYPE, F.lit(INSERT)).select(*log.columns).unionByName(recent)


def fold_dry_run(log: DataFrame, keys: list[str], cutoff: Column) -> DataFrame:
    """How many log rows :func:`fold_before` would remove."""
    per_key = log.filter(F.col(STAMP) < cutoff).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max_by(TYPE, F.when(F.col(TYPE) != PRE, F.col(VERSION))).alias("_last"),
    )
    kept = F.when(F.col("_last") == DELETE, 0).otherwise(1)
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_older"),
        F.coalesce(F.sum(F.col("_rows") - kept), F.lit(0)).cast("bigint").alias("rows_removed"),
    )


def same_table(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows found in only one of two tables, duplicates counted."""
    left = a.exceptAll(b.select(*a.columns)).withColumn("side", F.lit("left"))
    return left.unionByName(b.select(*a.columns).exceptAll(a).withColumn("side", F.lit("right")))

