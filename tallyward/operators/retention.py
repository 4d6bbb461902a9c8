"""Retention that frees space: folded commits, folded batches, old working folders.

Folders are deleted through the file system of their path, by the driver, one
call for each folder; no row is read for it. Every function has a dry run that
names what it would delete. Files of folders that are not named stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators import changelog
from tallyward.session import stored_copy


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def subfolders(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names of the folders in a folder, and when they were changed (milliseconds)."""
    files, path = _file_system(spark, folder)
    if not files.exists(path):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(path) if s.isDirectory()}


def delete_folders(spark: SparkSession, folder: str, names: list[str]) -> None:
    files, _ = _file_system(spark, folder)
    for name in names:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"), True)


def fold_stored_log(spark: SparkSession, folder: str, keys: list[str], cutoff: Column, dry_run: bool = False) -> DataFrame:
    """Fold the commits before ``cutoff`` of a log stored by ``_commit_version``.

    Returns what happens to each folder: (version, action, rows_before,
    rows_after). Folders of old commits that still hold the last image of some
    key are replaced by dynamic partition overwrite, those that hold none are
    deleted, and newer ones keep their files. If it stops half-way the state is
    the same, as an image that was not folded yet is older than the one kept;
    running it again completes it.
    """
    log = spark.read.parquet(folder)
    older = log.filter(F.col(changelog.STAMP) < cutoff)
    base = stored_copy(changelog.fold_before(older, keys, cutoff), "folded-log")
    before = log.groupBy(changelog.VERSION).agg(F.count(F.lit(1)).alias("rows_before"), (F.max(changelog.STAMP) < cutoff).alias("_old"))
    after = base.groupBy(changelog.VERSION).agg(F.count(F.lit(1)).alias("_kept"))
    kept = F.when(F.col("_old"), F.coalesce("_kept", F.lit(0))).otherwise(F.col("rows_before"))
    action = F.when(~F.col("_old"), "keep").when(F.col("_kept").isNull(), "delete").otherwise("replace")
    plan = stored_copy(
        before.join(after, changelog.VERSION, "left").select(
            F.col(changelog.VERSION).cast("bigint").alias("version"), action.alias("action"), "rows_before", kept.alias("rows_after")
        ),
        "fold-plan",
    )
    if not dry_run:
        base.hint("rebalance", changelog.VERSION).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            changelog.VERSION
        ).parquet(folder)
        gone = plan.filter("action = 'delete'").select("version").collect()  # one number for each commit
        delete_folders(spark, folder, [f"{changelog.VERSION}={r['version']}" for r in gone])
    return plan


def _numbered(names, mark: str, upto: int) -> list[str]:
    return sorted(n for n in names if n.startswith(mark) and n[len(mark):].isdigit() and int(n[len(mark):]) <= upto)


def expire_batches(spark: SparkSession, folder: str, upto: int | None, batch: str = "_batch", dry_run: bool = False) -> list[str]:
    """Delete batch folders that a fold has taken in: those up to ``upto``, the
    last fold's mark, and earlier folds of it. Without a fold nothing goes."""
    if upto is None:
        return []
    batches = _numbered(subfolders(spark, folder), f"{batch}=", upto)
    folds = _numbered(subfolders(spark, f"{folder}_folded"), "upto=", upto - 1)
    if not dry_run:
        delete_folders(spark, folder, batches)
        delete_folders(spark, f"{folder}_folded", folds)
    return [f"{folder}/{n}" for n in batches] + [f"{folder}_folded/{n}" for n in folds]


def expire_scratch(spark: SparkSession, base: str, older_than_ms: int, purposes: tuple[str, ...], dry_run: bool = True) -> list[str]:
    """Delete working folders (``<purpose>-<hexadecimal>``) of the named purposes
    that were last changed before a time. Others in the shared folder are left alone."""
    old = [
        n for n, changed in subfolders(spark, base).items()
        if changed < older_than_ms and any(n.startswith(f"{p}-") and set(n[len(p) + 1 :]) <= set("0123456789abcdef") for p in purposes)
    ]
    if not dry_run:
        delete_folders(spark, base, old)
    return sorted(f"{base.rstrip('/')}/{n}" for n in old)
