"""Time and arithmetic expressions with the null and zero rules of the feature pipelines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch_to_timestamp(seconds: ColumnOrName) -> Column:
    return F.timestamp_seconds(as_column(seconds))


def local_time(instant: ColumnOrName, offset_minutes: ColumnOrName) -> Column:
    """Local wall clock of an instant. Shifts by minutes, so half-hour zones keep their half hour."""
    return F.timestamp_add("MINUTE", -as_column(offset_minutes), as_column(instant))


def complete_units(unit: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole units elapsed from ``start`` to ``end``, truncated towards zero."""
    return F.timestamp_diff(unit, as_column(start), as_column(end))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Fractional minutes between two instants, each taken at whole seconds."""
    return (F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))) / F.lit(60.0)


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Division that answers NULL for a zero denominator, also in ANSI mode."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def percent_delta(value: ColumnOrName, base: ColumnOrName) -> Column:
    """Percent by which ``value`` exceeds ``base``; 0 where the base is not positive."""
    value, base = as_column(value), as_column(base)
    return F.when(base > 0, (F.try_divide(value, base) - 1) * 100).otherwise(F.lit(0.0))


def safe_divide(
    numerator: ColumnOrName, denominator: ColumnOrName, null_on_zero_numerator: bool = True
) -> Column:
    """Float division, NULL when an operand is NULL or the denominator is zero.

    By default a zero numerator answers NULL as well.
    """
    numerator, denominator = as_column(numerator), as_column(denominator)
    usable = denominator != 0
    if null_on_zero_numerator:
        usable = usable & (numerator != 0)
    return F.when(usable, F.try_divide(numerator.cast("double"), denominator.cast("double"))).cast("float")
