"""File layout: clustering, Z-order, compaction and file statistics.

Every operator writes a new folder and returns its path or a DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.functions.fixed_values import COMPACT_BYTES


def spread(df: DataFrame) -> Column:
    """A value per row that splits rows with equal clustering keys, so that a
    hot key fills several files and not one."""
    return F.xxhash64(*df.columns)


def write_clustered(df: DataFrame, folder: str, columns: list[str], files: int | None = None, rows_per_file: int = 0) -> str:
    """Overwrite a folder with rows clustered by columns; the schema may change."""
    by = [*[F.col(c) for c in columns], spread(df)]
    placed = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    writer = placed.sortWithinPartitions(*columns).write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(folder)
    return folder


#: Bytes of a string, after the prefix that all strings of the column share, that decide its place in a Z-order. Longer
#: common beginnings only place rows less well: no result depends on it.
STRING_BYTES = 7


def _numbers(stored: DataFrame, columns: list[str]) -> dict[str, Column]:
    """Each column as a number that grows with it: dates and times as counts,
    strings as the bytes that follow the prefix all of them share."""
    types = dict(stored.dtypes)
    texts = [c for c in columns if types[c] == "string"]
    ends = stored.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(texts) for n, f in (("low", F.min), ("high", F.max))]).first() if texts else None
    out = {}
    for c in columns:
        if types[c] == "string":
            low, high = (ends[f"{n}{texts.index(c)}"] or "" for n in ("low", "high"))
            shared = next((k for k, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
            bytes_ = F.rpad(F.hex(F.substring(F.substring(c, shared + 1, STRING_BYTES).cast("binary"), 1, STRING_BYTES)), 2 * STRING_BYTES, "0")
            out[c] = F.conv(bytes_, 16, 10).cast("bigint")
        elif types[c] == "date":
            out[c] = F.unix_date(c).cast("bigint")
        elif types[c].startswith("timestamp"):
            out[c] = F.unix_micros(F.col(c).cast("timestamp"))
        else:
            out[c] = F.col(c)
    return out


def _cell(number: Column, cuts: list, type_: str) -> Column:
    """Number of cut points at or below the value; 0 for NULL.

    The cuts are one literal array and the rank is found by binary search in
    it, so the expression has the same size for any number of files, and a row
    takes as many steps as the number of cuts has bits."""
    if not cuts:
        return F.lit(0).cast("bigint")
    held = F.split(F.lit(",".join(map(str, cuts))), ",").cast(f"array<{type_}>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])

    def further(rank: Column, step: Column) -> Column:
        return F.when(F.get(held, rank + step - 1) <= number, rank + step).otherwise(rank)

    return F.when(number.isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), further)).cast("bigint")


def with_z_value(stored: DataFrame, columns: list[str], files: int) -> DataFrame:
    """Add ``_z``, the interleaved bits of the columns' cells.

    Cells are quantiles of all stored rows, from one aggregate over these
    columns; there are at least four cells in all for each file, so skipping
    grows with the table. Only the cut points reach the driver. The cells get
    columns of their own, so that each is computed once per row.
    """
    bits = max(1, -(-(4 * files - 1).bit_length() // len(columns)))
    if bits * len(columns) > 62:
        raise ValueError(f"{files} files by {len(columns)} columns need more than 62 bits")
    shares = [i / 2**bits for i in range(1, 2**bits)]
    numbers = _numbers(stored, columns)
    found_frame = stored.agg(*[
        F.percentile_approx(n, shares, 10 * 2**bits).alias(f"_q{i}") for i, n in enumerate(numbers.values())
    ])
    found = found_frame.first()
    types = dict(found_frame.dtypes)
    cells = {
        f"_cell{i}": _cell(n, sorted(set(found[i] or [])), types[f"_q{i}"][len("array<"):-1]) for i, n in enumerate(numbers.values())
    }
    parts = [
        F.shiftleft(F.shiftright(name, bit).bitwiseAND(F.lit(1)), bit * len(columns) + place)
        for bit in range(bits)
        for place, name in enumerate(cells)
    ]
    z = reduce(lambda a, b: a.bitwiseOR(b), parts)
    return stored.withColumns(cells).withColumn("_z", z).drop(*cells)


def z_order(spark: SparkSession, source: str, target: str, columns: list[str], files: int) -> str:
    """Rewrite a stored table so that each file covers a small range of every column.

    The rows of each Z-value are counted from these columns alone, and a row goes to its file by this count: a
    partitioning by range would read and place all rows once more to sample them."""
    stored = spark.read.parquet(source)
    placed = with_z_value(stored, columns, files)
    counted = placed.groupBy("_z").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_z")) - F.col("_rows")
    starts = counted.select("_z", "_rows", before.alias("_before"), F.sum("_rows").over(Window.partitionBy()).alias("_all"))
    place = (F.col("_before") + F.pmod(spread(stored), F.col("_rows"))) * files
    (
        placed.join(F.broadcast(starts), "_z", "left")  # all are found; an inner join would filter by, and so compute, the value twice
        .withColumn("_file", F.least(F.floor(place / F.col("_all")), F.lit(files - 1)).cast("int"))
        .drop("_rows", "_before", "_all")
        .repartitionById(files, "_file")
        .sortWithinPartitions("_z")
        .drop("_z", "_file")
        .write.mode("overwrite")
        .parquet(target)
    )
    return target


def folder_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """File count and size of a table from its listing; no content is read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return listing.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = COMPACT_BYTES) -> str:
    """Rewrite small files into even files of about the target size.

    A file is put together from whole input splits, so its task reads what it
    writes: shuffled rows would be several times as many bytes. Only files
    smaller than a split are dealt out by a shuffle."""
    size = folder_bytes(spark, source).first()["bytes"]
    files = max(1, -(-size // target_bytes))
    stored = spark.read.parquet(source)
    placed = stored.coalesce(files) if files <= stored.rdd.getNumPartitions() else stored.repartition(files, spread(stored))
    placed.write.mode("overwrite").parquet(target)
    return target


def rewrite_rebalanced(df: DataFrame, folder: str, columns: list[str] | None = None) -> str:
    """Write with even files sized by adaptive execution, hot keys split."""
    even = df.hint("rebalance", *columns) if columns else df.hint("rebalance")
    even.write.mode("overwrite").parquet(folder)
    return folder


def file_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and value range of each file of a table read from files."""
    ranges = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"), *ranges)


def merged_stats(stats: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Statistics of files put together by a column that labels them."""
    ranges = [f(f"{n}_{c}").alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return stats.groupBy(by).agg(F.sum("row_count").alias("row_count"), *ranges)


def files_to_read(stats: DataFrame, column: str, value) -> DataFrame:
    """How many files a point lookup must open, going by their value ranges."""
    may_hold = F.lit(value).between(F.col(f"min_{column}"), F.col(f"max_{column}"))
    return stats.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(may_hold).alias("files_read"),
        F.sum(F.when(may_hold, F.col("row_count")).otherwise(0)).alias("rows_read"),
    )


def column_statistics(df: DataFrame, columns: list[str], exact: tuple[str, ...] = ()) -> DataFrame:
    """Nulls, distinct values and range per column, in one pass. Distinct
    values are sketched, but counted for the columns in ``exact``."""
    aggregates, lines = [], []
    for c in columns:
        aggregates += [
            F.count_if(F.col(c).isNull()).alias(f"n_{c}"),
            (F.countDistinct(c) if c in exact else F.approx_count_distinct(c)).alias(f"d_{c}"),
            F.min(c).cast("string").alias(f"lo_{c}"),
            F.max(c).cast("string").alias(f"hi_{c}"),
        ]
        lines.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"n_{c}").alias("null_count"),
                F.col(f"d_{c}").alias("distinct_count"),
                F.col(f"lo_{c}").alias("min_value"),
                F.col(f"hi_{c}").alias("max_value"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*lines)))


def analyze(spark: SparkSession, table: str, histograms: bool = False) -> None:
    """Catalog statistics of a table, for the cost-based optimizer."""
    key = "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, str(histograms).lower())
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    finally:
        spark.conf.set(key, before)


def catalog_statistics(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """What the catalog knows of some columns; no row of the table is read."""
    rows = []
    for c in columns:
        told = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {c}").collect()}
        known = lambda name: None if told.get(name) in (None, "NULL") else told[name]
        number = lambda name: None if known(name) is None else int(known(name))
        rows.append((c, number("num_nulls"), number("distinct_count"), known("min"), known("max"), known("histogram") is not None))
    return spark.createDataFrame(
        rows, "column_name STRING, null_count BIGINT, distinct_count BIGINT, min_value STRING, max_value STRING, has_histogram BOOLEAN"
    )
