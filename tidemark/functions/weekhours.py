"""Hour-of-week slots and vectors: slot = (day of week - 1) * 24 + hour, Sunday is day 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnOrName, as_column

WEEK_HOURS = 168


def start_slot(start_hour: ColumnOrName, start_day: ColumnOrName) -> Column:
    return (as_column(start_day) - 1) * 24 + as_column(start_hour)


def shift_hours(start_hour: ColumnOrName, end_hour: ColumnOrName) -> Column:
    """Clock hours a shift covers. An end at or before the start means the next day."""
    span = as_column(end_hour) - as_column(start_hour)
    return F.when(span > 0, span).otherwise(span + 24)


def week_vector(start_hour: ColumnOrName, end_hour: ColumnOrName, start_day: ColumnOrName) -> Column:
    """168 zeros and ones: 1 where the shift covers that hour of the week."""
    first = start_slot(start_hour, start_day)
    hours = shift_hours(start_hour, end_hour)
    return F.transform(
        F.sequence(F.lit(0), F.lit(WEEK_HOURS - 1)),
        lambda slot: (F.pmod(slot - first, F.lit(WEEK_HOURS)) < hours).cast("int"),
    )


def _sum(products: Column) -> Column:
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_similarity(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Cosine of two numeric arrays as float; NULL when one is NULL, empty or all zero."""
    left, right = as_column(left), as_column(right)

    def dot(a: Column, b: Column) -> Column:
        return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))

    norm = F.sqrt(dot(left, left) * dot(right, right))
    usable = (F.size(left) > 0) & (F.size(right) > 0)
    return F.when(usable, F.try_divide(dot(left, right), norm)).cast("float")
