"""Type 2 tables stored by key hash, loaded and read without their whole history.

``events`` holds every event, by load and by a hash of its key; ``versions``
holds the finished versions by the same hash. A load writes its events, finds
the touched partitions, and replaces only these. Of the versions it reads the
touched keys; of the events, as a rule, nothing:

A version stands for a run of events with equal tracked values. Its first and
last event say all that a later load needs, wherever a new event falls, but in
one case: the new event lies strictly inside a run and has other tracked
values. It then splits the run, and what the parts held at the cut is only in
the events. Such keys are found first, and their events are read from their
partitions (dynamic partition pruning). So the result of loads in any order is
that of one load, and a load costs what it touches.

A load that failed may be run again under its number: its events are replaced,
and events that are already part of a version change nothing. One writer at a
time is assumed; a reader during a commit may see some partitions before and
some after the load.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators import hotkeys
from tallyward.operators.history import START, scd2_versions
from tallyward.operators.keyed import not_null
from tallyward.session import stored_copy

PART, LOAD, LAST = "_part", "_load", "_last"


def read_if_there(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


@dataclass(frozen=True)
class VersionTable:
    """``sequence`` orders the events of a key without ties between different
    events; ``track`` are the columns whose change opens a version; ``parts``
    is fixed for the life of the table."""

    folder: str
    keys: list[str]
    sequence: list[str]
    track: list[str]
    parts: int = 64

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows with their partition; rows without key or time are left out."""
        return not_null(rows, [*self.keys, self.sequence[0]]).withColumn(
            PART, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")
        )

    def events(self, spark: SparkSession) -> DataFrame | None:
        return read_if_there(spark, f"{self.folder}/events")

    def versions(self, spark: SparkSession) -> DataFrame | None:
        return read_if_there(spark, f"{self.folder}/versions")

    def in_parts(self, stored: DataFrame, touched: DataFrame) -> DataFrame:
        """The stored rows of touched keys. The list of partitions has at most
        ``parts`` rows, so it is broadcast and prunes the scan at run time; the
        keys may be many, and how they are joined is left to Spark."""
        parts = touched.select(PART).filter(F.col(PART) >= 0).distinct()
        return stored.join(F.broadcast(parts), PART, "left_semi").join(touched, [PART, *self.keys], "left_semi")

    def _ends(self, versions: DataFrame, columns: list[str]) -> DataFrame:
        """The first and the last event of each version. ``_mark`` holds the
        tracked values and whether the run goes on after this event."""
        when, *ties = self.sequence
        first = F.struct(F.col(START).alias(when), *ties)
        runs = first != F.col(LAST)
        marks = lambda place, on: F.struct(place.alias("at"), on.alias("on"))
        both = F.filter(
            F.array(F.when(runs, marks(first, F.lit(True))), marks(F.col(LAST), F.lit(False))), lambda m: m.isNotNull()
        )
        rest = [c for c in columns if c not in self.sequence]
        return versions.select(*rest, F.explode(both).alias("_m")).select(
            *rest, *[F.col(f"_m.at.{c}").alias(c) for c in self.sequence],
            F.struct(F.struct(*self.track).alias("values"), F.col("_m.on").alias("on")).alias("_mark"),
        )

    def _renewed(self, known: DataFrame, changes: DataFrame, touched: DataFrame, hot: DataFrame | None) -> DataFrame:
        """All versions of the touched keys. ``changes``: placed and stored."""
        columns = changes.columns
        ends = self._ends(self.in_parts(known, touched), columns)
        nothing = F.lit(None).cast(ends.schema["_mark"].dataType).alias("_mark")
        mixed = ends.unionByName(changes.select(*columns, nothing)).withColumn("_new", F.col("_mark").isNull())
        order = [*self.sequence, "_new"]
        cut = hotkeys.cut_hot_keys(mixed, self.keys, order, hot)
        within = hotkeys.last_known(cut, self.keys, order, "_mark", "_within")
        splits = F.col("_new") & F.col("_within.on") & ~F.col("_within.values").eqNullSafe(F.struct(*self.track))
        split = stored_copy(within.filter(splits).select(PART, *self.keys).distinct(), "versions-split")
        told = mixed.join(split, [PART, *self.keys], "left_anti").select(*columns)
        again = changes.join(split, [PART, *self.keys], "left_semi").select(*columns)
        history = self.events(changes.sparkSession)
        if history is not None:
            again = again.unionByName(self.in_parts(history, split).select(*columns))
        return self._derived(told.unionByName(again), hot)

    def _derived(self, events: DataFrame, hot: DataFrame | None) -> DataFrame:
        return scd2_versions(events, [PART, *self.keys], self.sequence, self.track, hot, LAST)

    def load(self, changes: DataFrame, number: int, hot: DataFrame | None = None) -> None:
        """Store the events of one load and renew the partitions it touches."""
        spark, own = changes.sparkSession, f"{self.folder}/events/{LOAD}={number}"
        placed = self.placed(changes)
        placed.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(own)
        changes = spark.read.schema(placed.schema).parquet(own)
        known = self.versions(spark)
        if known is None:
            rows = self._derived(changes, self._hot(hot))
        else:
            touched = changes.select(PART, *self.keys).distinct()
            parts = touched.select(PART).filter(F.col(PART) >= 0).distinct()
            near = known.join(F.broadcast(parts), PART, "left_semi")
            kept = near.join(touched, [PART, *self.keys], "left_anti")
            rows = kept.unionByName(self._renewed(known, changes, touched, self._hot(hot)).select(*kept.columns))
        # only partitions that occur in the rows are replaced
        rows.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(
            f"{self.folder}/versions"
        )

    def _hot(self, hot: DataFrame | None) -> DataFrame | None:
        return None if hot is None else self.placed(hot.withColumn(self.sequence[0], F.lit(0))).drop(self.sequence[0])

    def state(self, spark: SparkSession, newer: DataFrame | None = None, hot: DataFrame | None = None) -> DataFrame:
        """The versions, with events that no load has taken yet (``newer``, from
        storage) worked in. Keys without newer events pass through as stored."""
        known = self.versions(spark)
        if known is None and newer is None:
            raise ValueError(f"nothing is stored in {self.folder}")
        if newer is None:
            return known.drop(PART, LAST)
        changes = self.placed(newer)
        if known is None:
            return self._derived(changes, self._hot(hot)).drop(PART, LAST)
        touched = changes.select(PART, *self.keys).distinct()
        renewed = self._renewed(known, changes, touched, self._hot(hot))
        kept = known.join(touched, [PART, *self.keys], "left_anti")
        return kept.unionByName(renewed.select(*kept.columns)).drop(PART, LAST)
