"""Keyed table maintenance: dedup, upsert, conditional update.

Tables are ordinary DataFrames. An operator returns the new table state; the
caller writes it to a new folder, since Spark cannot overwrite what it reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def not_null(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.na.drop(subset=keys)


def any_null(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key. ``row_number() = 1`` lets Spark keep only the best row
    of each key before the shuffle, so copies of a hot key never travel."""
    best = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1").drop("_rn")


def newest_first(sequence: list[str], df: DataFrame, keys: list[str]) -> list[Column]:
    """A total order: the sequence columns, then a hash of all other columns,
    then these columns, which are compared only where the hashes are equal."""
    rest = [c for c in df.columns if c not in sequence and c not in keys]
    tie = [F.xxhash64(*rest).desc()] if rest else []
    return [*[F.col(c).desc_nulls_last() for c in sequence], *tie, *[F.col(c).desc_nulls_last() for c in rest]]


def dedup_latest(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    return latest_per_key(not_null(df, keys), keys, newest_first(sequence, df, keys))


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """First-seen key rows with no order promised (batch ``dropDuplicates``)."""
    return not_null(df, keys).dropDuplicates(keys)


def _one_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in source.columns if c not in keys]
    packed = source.groupBy(*keys).agg(
        F.max(F.struct(*[F.col(v) for v in values])).alias("_row"), F.count(F.lit(1)).alias("_copies")
    )
    message = F.lit(f"merge source holds several rows for one key of {keys}")
    single = F.when(F.col("_copies") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return packed.filter(single).select(*keys, "_row.*")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    source_is_unique: bool = False,
) -> DataFrame:
    """MERGE: matched rows take the ``update`` columns, others are inserted whole.

    A source with two rows for one key is an error. ``source_is_unique`` skips
    that check when the source comes straight from a dedup.
    """
    source = source if source_is_unique else _one_per_key(source, keys)
    s = source.select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], F.struct(*source.columns).alias("_s")
    )
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys])
    t = target.withColumn("_known", F.lit(True))
    incoming = set(source.columns)

    def choose(name: str) -> Column:
        fresh = F.col(f"_s.{name}") if name in incoming else F.lit(None)
        take = F.col("_known").isNull()
        if name in update:
            take = take | F.col("_s").isNotNull()
        return F.when(take, fresh).otherwise(F.col(name)).alias(name)

    return t.join(s, on, "full_outer").select(*[choose(c) for c in target.columns])


def merge_update_if(
    target: DataFrame, source: DataFrame, keys: list[str], update: list[str], condition: Column
) -> DataFrame:
    """MERGE without insert: matched rows that meet ``condition`` (over the
    target's columns) take the ``update`` columns of the source."""
    s = _one_per_key(source.select(*keys, *update), keys).select(
        *keys, F.struct(*update).alias("_s")
    )
    take = F.coalesce(condition, F.lit(False)) & F.col("_s").isNotNull()
    return target.join(s, keys, "left").select(
        *[F.when(take, F.col(f"_s.{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in target.columns]
    )


def duplicate_check(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.countDistinct(key).alias("unique_keys"))


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows whose columns differ; missing columns become NULL."""
    return old.unionByName(new, allowMissingColumns=True)
