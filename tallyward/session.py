"""Session settings and shared working folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "tallyward") -> SparkSession:
    """A session for tests and benchmarks. On a cluster, bring your own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared storage in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a folder of its own; a cluster
    without it is refused, because a machine-local folder would be lost with
    the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix=f"run-{purpose}-", dir="/tmp")


def stored_copy(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to shared storage and read back: its lineage ends
    there, and several uses do not compute it again."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)
