"""Column expressions shared by the operators. All run on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(amount: str | Column, where: Column | None = None) -> Column:
    """Sum of money, exact in cents and so the same for every row order."""
    value = col(amount).cast(MONEY)
    if where is not None:
        value = F.when(where, value).otherwise(F.lit(0).cast(MONEY))
    return F.sum(value).cast("double")


def exact_avg(amount: str | Column) -> Column:
    """Mean of money from the exact sum; NULL for an empty group."""
    return F.try_divide(exact_sum(amount), F.count(amount))


def tally(where: Column) -> Column:
    """Rows that satisfy a condition; an unknown condition counts as no."""
    return F.count_if(F.coalesce(where, F.lit(False)))


def percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """Share in percent, NULL for an empty whole."""
    return F.round(F.try_divide(col(part), col(whole)) * 100, digits)


def month_of(day: str | Column) -> Column:
    return F.trunc(col(day), "month")


def quarter_label(day: str | Column) -> Column:
    return F.concat(F.year(col(day)).cast("string"), F.lit("-Q"), F.quarter(col(day)).cast("string"))


def stay_seconds(admitted: str | Column = "admitted_at", discharged: str | Column = "discharged_at") -> Column:
    """Length of stay in whole seconds; NULL while still admitted."""
    return F.unix_timestamp(col(discharged)) - F.unix_timestamp(col(admitted))


def avg_stay_hours() -> Column:
    """Mean stay in hours, summed as integers so that row order cannot matter."""
    seconds = stay_seconds()
    return F.try_divide(F.sum(seconds) / F.lit(3600.0), F.count(seconds))


def pick(values: list[str], index: Column) -> Column:
    """The list element at a zero-based index taken modulo the list length."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))

