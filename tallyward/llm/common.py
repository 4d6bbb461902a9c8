"""What the training-data operators share: tables, splits, samples, held-back models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.session import stored_copy


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """The whole table, only the columns an operator needs."""
    return table(spark, sf_dir, "documents").select("doc_id", "text", *extra)


def fold(column: Column, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``; -1 for a NULL id."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds, F.lit(-1))


def fresh(taken: Sequence[str], name: str) -> str:
    """``name``, made longer until no column of the input has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


_SPAN = 1 << 40


def smallest_hashes(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows with the smallest hash of ``doc_id``.

    The number of rows sets a hash bound that about twice as many rows pass,
    so that no task sends more than its share to the final sort."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_SPAN))
    n = rows.agg(F.count(F.lit(1))).scalar()
    near = place.cast("double") * n <= F.lit(float(_SPAN)) * (2 * most + 100)  # long numbers overflow from 2^23 rows on
    return rows.where(near).orderBy(place, *rows.columns).limit(most)


def smallest_of_each(rows: DataFrame, by: str, most: int) -> DataFrame:
    """For each value of ``by`` the ``most`` rows with the smallest hash of
    ``doc_id``.

    The number of rows of a value sets a hash bound that about twice as many
    of them pass, so that a value that most rows have does not bring its rows
    to one task. The numbers are stored: there are as many as values, and by
    their size Spark decides how to join them."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_SPAN))
    taken = fresh(rows.columns, "rows_")
    sizes = stored_copy(rows.groupBy(by).agg(F.count(F.lit(1)).alias(taken)), "sizes")
    near = rows.join(sizes, by).where(place.cast("double") * F.col(taken) <= F.lit(float(_SPAN)) * (2 * most + 100))
    first = Window.partitionBy(by).orderBy(place, *rows.columns)
    rank = fresh([*rows.columns, taken], "rank")
    return near.withColumn(rank, F.row_number().over(first)).where(F.col(rank) <= most).select(*rows.columns)


def join_counted(rows: DataFrame, told: DataFrame, key: str, count: str, most: int, purpose: str) -> DataFrame:
    """``rows`` with what ``told`` says of their key, an inner join. ``told``
    has one row per key and in ``count`` how many rows have it.

    Keys with more than ``most`` rows, of which there are at most one for every
    ``most`` rows, are stored apart. Their table is joined first: it is small
    beside the rows, and where it is small enough Spark sends it to them, so
    that a key with a third of all rows is not brought to one task; beyond that
    adaptive execution splits the key. All other keys are joined by a shuffle."""
    told = stored_copy(told, purpose)
    values = [c for c in told.columns if c != key]
    hot = stored_copy(told.where(F.col(count) > most), purpose).select(key, F.struct(*values).alias("_told"))
    marked = rows.join(hot, key, "left")
    found = marked.where("_told is not null").select(*rows.columns, *[F.col(f"_told.{c}").alias(c) for c in values])
    rest = marked.where("_told is null").drop("_told").join(told.where(F.col(count) <= most), key)
    return found.unionByName(rest.select(*found.columns))


def texts_of(docs: DataFrame, ids: DataFrame, *columns: str) -> DataFrame:
    """``ids`` (doc_id and more, one row per id; a bounded sample) with their
    texts, one row per id: the smallest text of an id that documents repeat."""
    rows = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", *columns).agg(F.min("text").alias("text")).select("doc_id", "text", *columns)


def labelled(
    docs: DataFrame, labels: DataFrame, label: Column, most: int, where: Column | None = None, least: int = 0
) -> DataFrame:
    """A bounded sample (doc_id, text, y) for fitting a model.

    The ``most`` ids with the smallest hash are taken from the labels that
    have a value, one label per id (the largest, where an id is repeated), and
    besides them the ``least`` of smallest hash of each value, so that a rare
    value is not lost. An id has one row, whatever rows repeat it. Documents
    and labels may each lack ids of the other.
    """
    ids = labels.select("doc_id", label.cast("double").alias("y")).where("doc_id is not null and y is not null")
    if where is not None:
        ids = ids.where(where)
    ids = ids.groupBy("doc_id").agg(F.max("y").alias("y"))
    some = smallest_hashes(ids, most)
    if least:
        some = some.unionByName(smallest_of_each(ids, "y", least)).distinct()
    # at most `most` rows of two numbers, and `least` for each value: a proven bound
    return texts_of(docs, some, "y")
