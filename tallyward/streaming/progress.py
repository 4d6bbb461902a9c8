"""Progress of streams as a table: one row per batch, from Spark's own reports."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "query_id STRING, run_id STRING, batch_id BIGINT, input_rows BIGINT, state_rows BIGINT, state_updated BIGINT, "
    "dropped_late BIGINT, watermark STRING, batch_ms BIGINT"
)


class ProgressLog(StreamingQueryListener):
    """Writes what each batch reports to a folder of its own, so that a report
    that comes twice is stored once. Register it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._ended = spark, folder, threading.Event()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - names that Spark calls
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        states = p.stateOperators
        row = (
            str(p.id), str(p.runId), p.batchId, p.numInputRows, sum(s.numRowsTotal for s in states),
            sum(s.numRowsUpdated for s in states), sum(s.numRowsDroppedByWatermark for s in states),
            p.eventTime.get("watermark"), p.batchDuration,
        )
        one = self.spark.createDataFrame([row], PROGRESS).coalesce(1)
        one.write.mode("overwrite").parquet(f"{self.folder}/query={p.id}/batch={p.batchId}")

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended.set()

    def wait(self, seconds: float = 60.0) -> None:
        """Until the end of a query has been reported; its progress comes before."""
        if not self._ended.wait(seconds):
            raise TimeoutError("no stream has ended")
        self._ended.clear()


def progress(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PROGRESS).option("recursiveFileLookup", True).parquet(folder)
