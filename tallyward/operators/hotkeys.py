"""Ordered per-key lookups that survive hot keys.

A window over ``PARTITION BY key`` sends every row of a key to one task. That
is fine until one key holds a large share of the table. The caller may
therefore pass a table of hot keys with their numbers of rows (``hot_keys``,
written once per load with ``stored_copy``). The rows of these keys are cut into
slices; each slice is its own window partition, and one summary row per slice
carries the edge values across slice borders. Without such a table the plan is
the plain window and nothing else. Nothing is counted or collected while a plan
is built.

Cuts are places in the full order of the window: a sample of the rows of a hot
key, picked by a hash of key and place, gives about a cut for every
``SLICE_ROWS`` rows of the key, ``FEWEST`` to ``SLICES`` of them, and a row's slice is the number of cuts at or before its place. So a crowded
day or value is split like any other stretch, NULL places have a slice, equal
places share one, and a rerun cuts alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES, FEWEST, SLICE_ROWS = 64, 4, 1_000
ROWS = "_rows"
SLICE = "_slice"
_SPAN = 1 << 40


def hot_keys(df: DataFrame, keys: list[str], at_least: int) -> DataFrame:
    """Keys with at least so many rows, and their numbers of rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))
    return counted.filter(F.col(ROWS) >= at_least)


def cut_hot_keys(df: DataFrame, keys: list[str], order: list[str], hot: DataFrame | None, slices: int = SLICES) -> DataFrame:
    """Add ``_slice`` if there is a table of hot keys: a number for their rows, else NULL.

    ``hot`` has the keys and their rows (``_rows``); it may count more or fewer
    rows than ``df`` has, as slicing changes no result. Keys must not be NULL.
    """
    if hot is None:
        return df
    place = F.struct(*order)
    listed = hot.select(*keys, ROWS)
    wanted = F.least(F.lit(slices), F.greatest(F.lit(FEWEST), F.col(ROWS) / SLICE_ROWS))
    picked = F.pmod(F.xxhash64(*keys, *order), F.lit(_SPAN)) < F.lit(_SPAN) * wanted / F.col(ROWS)
    cuts = (
        df.select(*keys, *[c for c in order if c not in keys])
        .join(listed, keys)
        .filter(picked)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set(place)).alias("_cuts"))
    )
    at = F.size(F.filter("_cuts", lambda cut: cut <= place))
    return df.join(cuts, keys, "left").withColumn(SLICE, F.when(F.col("_cuts").isNotNull(), at)).drop("_cuts")


def _parts(df: DataFrame, keys: list[str]) -> list[str]:
    return [*keys, SLICE] if SLICE in df.columns else keys


def _carry(df: DataFrame, window_result: DataFrame, keys: list[str], edges: list[Column], carried: list[Column]) -> DataFrame:
    """Join to each row what its slice takes over from other slices."""
    summary = df.filter(F.col(SLICE).isNotNull()).groupBy(*keys, SLICE).agg(*edges)
    return window_result.join(summary.select(*keys, SLICE, *carried), [*keys, SLICE], "left")


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    before: str | None = None,
    after: str | None = None,
) -> DataFrame:
    """Add the previous and/or next row's ``columns`` as struct columns.

    The struct is NULL where there is no such row, so NULL values inside it
    stay distinguishable.
    """
    value = F.struct(*columns)
    near = Window.partitionBy(*_parts(df, keys)).orderBy(*order)
    found = {name: f(value).over(near) for name, f in ((before, F.lag), (after, F.lead)) if name}
    wide = df.withColumns(found)
    if SLICE not in df.columns:
        return wide
    position, across = F.struct(*order), Window.partitionBy(*keys).orderBy(SLICE)
    wide = _carry(
        df,
        wide,
        keys,
        [F.min_by(value, position).alias("_first"), F.max_by(value, position).alias("_last")],
        [F.lag("_last").over(across).alias("_from_before"), F.lead("_first").over(across).alias("_from_after")],
    )
    taken = {name: F.coalesce(name, other) for name, other in ((before, "_from_before"), (after, "_from_after")) if name}
    return wide.withColumns(taken).drop("_from_before", "_from_after")


def last_known(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Add the latest non-NULL ``value`` at or before each row."""
    near = Window.partitionBy(*_parts(df, keys)).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wide = df.withColumn(out, F.last(value, ignorenulls=True).over(near))
    if SLICE not in df.columns:
        return wide
    known = F.col(value).isNotNull()
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    wide = _carry(
        df,
        wide,
        keys,
        [F.max_by(F.when(known, F.col(value)), F.when(known, F.struct(*order))).alias("_last")],
        [F.last("_last", ignorenulls=True).over(earlier).alias("_carried")],
    )
    return wide.withColumn(out, F.coalesce(out, "_carried")).drop("_carried")


def _after_earlier_slices(df: DataFrame, wide: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Shift positions counted within a slice by the rows of earlier slices."""
    if SLICE not in df.columns:
        return wide
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    wide = _carry(
        df, wide, keys, [F.count(F.lit(1)).alias(ROWS)], [F.sum(ROWS).over(earlier).alias("_skipped")]
    )
    return wide.withColumn(out, F.col(out) + F.coalesce("_skipped", F.lit(0))).drop("_skipped")


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str = "_n") -> DataFrame:
    """Add the 1-based position of each row within its key."""
    near = Window.partitionBy(*_parts(df, keys)).orderBy(*order)
    return _after_earlier_slices(df, df.withColumn(out, F.row_number().over(near)), keys, out)


def ranked_descending(df: DataFrame, group: str, measure: str, out: str, hot: DataFrame | None = None) -> DataFrame:
    """Add SQL ``rank()`` by ``measure`` descending within a text column, NULLs last.

    ``hot`` lists crowded groups by the column's name (a NULL group cannot be
    listed). Equal values share a slice, so a rank is the rows of all earlier
    slices plus the rank in the slice.
    """
    keys, order = ["_group", "_no_group"], ["_no_measure", "_down"]
    rows = df.withColumns({
        "_group": F.coalesce(group, F.lit("")),
        "_no_group": F.col(group).isNull(),
        "_no_measure": F.col(measure).isNull(),
        "_down": -F.col(measure),
    })
    listed = None if hot is None else hot.select(F.col(group).alias("_group"), F.lit(False).alias("_no_group"), ROWS)
    cut = cut_hot_keys(rows, keys, order, listed)
    near = Window.partitionBy(*_parts(cut, keys)).orderBy(*order)
    wide = _after_earlier_slices(cut, cut.withColumn(out, F.rank().over(near)), keys, out)
    return wide.withColumn(out, F.col(out).cast("bigint")).drop(SLICE, *keys, *order)
