"""Point lookups that open only files which can hold the key.

A table is written sorted by its lookup column, with Parquet bloom filters on
it, and a small statistics table beside it: per file the range of the column,
and a bloom filter of its values as bitmaps. A lookup reads the statistics, and
then opens the files that are left; a key that lies within a file's range but is
not in it opens none, but for a share of false alarms that the number of bits
sets. Inside an opened file Parquet's own bloom filter and row-group ranges
skip what is left. The statistics are one aggregate over the written column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators.layout import spread

#: Bits of the bloom filter for each value, and bits set by a value: about 1 false alarm in 100.
BITS, HASHES = 10, 7
#: Bits of one bitmap of Spark's bitmap functions.
BITMAP = 32_768


def _positions(value: Column, bits: Column) -> Column:
    """The bits of a value, by double hashing, in a filter of so many bits."""
    text = value.cast("string")
    first, second = F.xxhash64(text), F.xxhash64(F.concat(F.lit("#"), text))
    return F.transform(
        F.array(*[F.lit(k) for k in range(HASHES)]),
        lambda k: F.pmod(F.pmod(first, bits) + k * F.pmod(second, bits), bits),
    )


def write_for_lookup(df: DataFrame, folder: str, column: str, files: int, rows_per_file: int) -> str:
    """Write ``df`` by ranges of ``column`` and the statistics of its files to
    ``<folder>_files``. A busy value fills several files; NULL is in no range."""
    placed = df.repartitionByRange(files, F.col(column), spread(df)).sortWithinPartitions(column)
    (
        placed.write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option(f"parquet.bloom.filter.enabled#{column}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{column}", str(rows_per_file))
        .parquet(folder)
    )
    file_statistics(df.sparkSession.read.parquet(folder), column).write.mode("overwrite").parquet(f"{folder}_files")
    return folder


def file_statistics(stored: DataFrame, column: str) -> DataFrame:
    """(file_path, rows, low, high, bits, part, bitmap): one row for each bitmap of each file.

    Values are made distinct per file first, so a value that fills a file sets its bits once."""
    values = stored.select(F.col("_metadata.file_path").alias("file_path"), F.col(column).alias("_v"))
    counted = values.groupBy("file_path", "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranges = counted.groupBy("file_path").agg(
        F.sum("_n").alias("rows"), F.min("_v").alias("low"), F.max("_v").alias("high"),
        # whole bitmaps, so that positions are spread over all their bits
        (F.ceil(F.greatest(F.count("_v"), F.lit(1)) * BITS / BITMAP) * BITMAP).cast("bigint").alias("bits"),
    )
    bits = counted.filter(F.col("_v").isNotNull()).join(ranges.select("file_path", "bits"), "file_path").select(
        "file_path", F.explode(_positions(F.col("_v"), F.col("bits"))).alias("_p")
    )
    filters = bits.groupBy("file_path", F.floor(F.col("_p") / BITMAP).alias("part")).agg(
        F.bitmap_construct_agg(F.pmod("_p", F.lit(BITMAP))).alias("bitmap")
    )
    return ranges.join(filters, "file_path", "left")


def _bit(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1


def files_with(spark: SparkSession, folder: str, value) -> DataFrame:
    """(file_path, rows) of the files that may hold a value. Statistics only are read."""
    key = F.lit(value)
    stats = spark.read.parquet(f"{folder}_files").filter(key.between(F.col("low"), F.col("high")))
    asked = stats.select("file_path", "rows", "part", "bitmap", F.explode(_positions(key, F.col("bits"))).alias("_p")).filter(
        F.floor(F.col("_p") / BITMAP) == F.col("part")
    )
    # every one of the value's bits must be found set in some bitmap of the file
    hit = _bit(F.col("bitmap"), F.pmod("_p", F.lit(BITMAP)))
    return asked.groupBy("file_path", "rows").agg(F.count_if(hit).alias("_set")).filter(F.col("_set") == HASHES).drop("_set")


def lookup(spark: SparkSession, folder: str, column: str, value) -> DataFrame:
    """The rows of a value. The driver gets the names of the files to open, few for a point."""
    names = [r["file_path"] for r in files_with(spark, folder, value).select("file_path").collect()]
    table = spark.read.parquet(*names) if names else spark.read.parquet(folder).limit(0)
    return table.filter(F.col(column) == F.lit(value))
