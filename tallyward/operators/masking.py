"""Column masks and row filters as secured views.

Group membership is an argument: open-source Spark has no ``is_member``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.fixed_values import MASKED_DATE, MASKED_TEXT

SEES_PERSONAL_DATA = frozenset({"data_stewards"})
SEES_ALL_ROWS = frozenset({"admins", "care_managers"})


@dataclass(frozen=True)
class Viewer:
    name: str
    groups: frozenset[str] = field(default_factory=frozenset)

    def in_any(self, groups: Iterable[str]) -> bool:
        return bool(self.groups & frozenset(groups))


def stand_in(df: DataFrame, column: str) -> Column:
    """What an outsider sees: a fixed date or text, NULL for other types."""
    kind = df.schema[column].dataType.simpleString()
    if kind == "date":
        return F.lit(MASKED_DATE).cast("date")
    return F.lit(MASKED_TEXT if kind == "string" else None).cast(kind)


def mask(df: DataFrame, columns: Iterable[str], viewer: Viewer) -> DataFrame:
    """Masked columns are constants, so their data is not even read."""
    if viewer.in_any(SEES_PERSONAL_DATA):
        return df
    return df.withColumns({c: stand_in(df, c).alias(c) for c in columns})


def own_rows(df: DataFrame, owner: str, viewer: Viewer) -> DataFrame:
    """Privileged viewers see all rows, others those they own. The owner test
    is a plain comparison and reaches the scan."""
    return df if viewer.in_any(SEES_ALL_ROWS) else df.filter(F.col(owner) == viewer.name)


def rows_by_access(df: DataFrame, owner: str, access: DataFrame, viewer: Viewer) -> DataFrame:
    """Row filter through a table of (viewer, owner) grants."""
    if viewer.in_any(SEES_ALL_ROWS):
        return df
    granted = access.filter(F.col("viewer") == viewer.name).select(F.col(owner))
    return df.join(granted, owner, "left_semi")


def secured_view(df: DataFrame, name: str, columns: Iterable[str], owner: str, viewer: Viewer) -> DataFrame:
    view = mask(own_rows(df, owner, viewer), columns, viewer)
    view.createOrReplaceTempView(name)
    return view


def create_mask_functions(spark: SparkSession, viewer: Viewer) -> None:
    """The same masks as SQL functions, for queries written in SQL."""
    sees = "true" if viewer.in_any(SEES_PERSONAL_DATA) else "false"
    for name, kind, hidden in (("mask_date", "DATE", f"DATE'{MASKED_DATE}'"), ("mask_text", "STRING", f"'{MASKED_TEXT}'")):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v {kind}) RETURNS {kind} RETURN CASE WHEN {sees} THEN v ELSE {hidden} END"
        )
