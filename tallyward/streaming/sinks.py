"""Stream sinks on plain Parquet.

Upserts never rewrite the table per micro-batch. Each batch stores its reduced
rows in a folder of its own, ``_batch=<id>``, overwritten when the batch is
retried, so every batch counts once. The table state is a reduction over the
stored rows. Every ``fold_every`` batches, the rows so far are reduced into one
folder; a mark that is written last tells readers up to which batch it holds,
so a fold that fails half-way is never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyward.operators import history, keyed, quality
from tallyward.operators.quality import RuleSet
from tallyward.operators.versions import VersionTable

BATCH = "_batch"


def _trigger(writer, every: str | None):
    """A fixed interval, or everything that is there now and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_table(df: DataFrame, folder: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Exactly-once append to a Parquet folder; restarts at its checkpoint."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start(folder)


def upsert_log(
    df: DataFrame,
    folder: str,
    checkpoint: str,
    reduce_batch: Callable[[DataFrame], DataFrame],
    every: str | None = None,
    mode: str = "append",
    fold_every: int | None = None,
    reduce_stored: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """``reduce_stored`` takes and returns stored rows, their batch number included."""

    def store(batch: DataFrame, batch_id: int) -> None:
        reduce_batch(batch).write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")
        if fold_every and reduce_stored and batch_id % fold_every == fold_every - 1:
            fold(batch.sparkSession, folder, batch_id, reduce_stored)

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(store)
    return _trigger(writer, every).start()


def split_stream(
    df: DataFrame, rule_set: RuleSet, key: str, passed: str, held: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Rules on a stream with both outputs: rows that go on, and quarantine.

    Each output reads the batch from its source, which gives the same rows each time. No copy of it is kept in the
    memory of the executors, however large a batch is.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        quality.apply_rules(batch, rule_set).write.mode("overwrite").parquet(f"{passed}/{BATCH}={batch_id}")
        quality.quarantine(batch, rule_set, key).write.mode("overwrite").parquet(f"{held}/{BATCH}={batch_id}")

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return _trigger(writer, every).start()


def _last_fold(spark: SparkSession, folder: str) -> int | None:
    try:
        return spark.read.parquet(f"{folder}_folds").agg(F.max("upto")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """The last fold and the batches after it; folders of earlier batches are not read."""
    batches, upto = spark.read.parquet(folder), _last_fold(spark, folder)
    if upto is None:
        return batches
    folded = spark.read.parquet(f"{folder}_folded/upto={upto}")
    return folded.unionByName(batches.filter(F.col(BATCH) > upto).withColumn(BATCH, F.col(BATCH).cast("int")))


def fold(
    spark: SparkSession, folder: str, upto: int, reduce_stored: Callable[[DataFrame], DataFrame], parted: list[str] | None = None
) -> None:
    """Reduce the stored rows up to a batch into one folder, then mark it as valid.
    Folders of those batches can be deleted afterwards."""
    rows = stored(spark, folder).filter(F.col(BATCH) <= upto)
    reduced = reduce_stored(rows).withColumn(BATCH, F.col(BATCH).cast("int"))
    reduced.write.mode("overwrite").partitionBy(*parted or []).parquet(f"{folder}_folded/upto={upto}")
    spark.range(1).select(F.lit(upto).alias("upto")).write.mode("append").parquet(f"{folder}_folds")


def scd1_stream(
    df: DataFrame, folder: str, checkpoint: str, keys: list[str], sequence: list[str], every=None, fold_every: int | None = None
):
    """Type 1 upserts: each batch keeps its newest row per key."""
    newest = lambda b: history.scd1_apply(None, b, keys, sequence)
    return upsert_log(df, folder, checkpoint, newest, every, fold_every=fold_every, reduce_stored=newest)


def scd1_state(spark: SparkSession, folder: str, keys: list[str], sequence: list[str]) -> DataFrame:
    return history.scd1_apply(None, stored(spark, folder).drop(BATCH), keys, sequence)


def scd2_stream(df: DataFrame, folder: str, checkpoint: str, keys: list[str], every=None):
    """Type 2 keeps the events themselves; versions are derived on read, so
    an event that arrives late still splits the right version."""
    return upsert_log(df, folder, checkpoint, lambda b: keyed.not_null(b, keys), every)


def scd2_state(spark: SparkSession, folder: str, keys: list[str], sequence: list[str], track: list[str]) -> DataFrame:
    return history.scd2_versions(stored(spark, folder).drop(BATCH), keys, sequence, track)


def versioned_stream(
    df: DataFrame, folder: str, checkpoint: str, table: VersionTable, every: str | None = None, load_every: int = 8
) -> StreamingQuery:
    """Type 2 kept in a ``VersionTable``. Each batch stores its events; after
    every ``load_every`` batches these are loaded, which renews only the
    partitions they touch, and a mark tells readers which batches are in."""

    def store(batch: DataFrame, batch_id: int) -> None:
        keyed.not_null(batch, table.keys).write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")
        if batch_id % load_every == load_every - 1:
            spark = batch.sparkSession
            newer = _after_fold(spark, folder).filter(F.col(BATCH) <= batch_id)
            table.load(newer.select(*batch.columns), batch_id)
            spark.range(1).select(F.lit(batch_id).alias("upto")).write.mode("append").parquet(f"{folder}_folds")

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return _trigger(writer, every).start()


def _after_fold(spark: SparkSession, folder: str) -> DataFrame:
    upto = _last_fold(spark, folder)
    batches = spark.read.parquet(folder)
    return batches if upto is None else batches.filter(F.col(BATCH) > upto)


def versioned_state(spark: SparkSession, folder: str, table: VersionTable) -> DataFrame:
    """The versions as loaded, and the batches since worked in."""
    return table.state(spark, _after_fold(spark, folder).drop(BATCH))


def gold_upsert_stream(
    df: DataFrame, folder: str, checkpoint: str, keys: list[str], every=None, fold_every: int | None = None
) -> StreamingQuery:
    """Aggregates in update mode: a group is stored again when it changes.
    ``keys`` are the group columns, as for :func:`gold_state`."""
    missing = set(keys) - set(df.columns)
    if missing:
        raise ValueError(f"no such group columns: {sorted(missing)}")
    last = lambda rows: keyed.latest_per_key(rows, keys, [F.col(BATCH).desc()])
    return upsert_log(df, folder, checkpoint, lambda b: b, every, "update", fold_every, last)


def gold_state(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    rows = stored(spark, folder)
    return keyed.latest_per_key(rows, keys, [F.col(BATCH).desc()]).drop(BATCH)
