"""Dense time grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .hot import as_list


def hour_grid(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every hour from ``first`` to ``last``, both included."""
    bounds = spark.range(1).select(
        F.lit(first).cast("timestamp_ntz").alias("first"), F.lit(last).cast("timestamp_ntz").alias("last")
    )
    return hours_between(bounds, "first", "last")


def hours_between(bounds: DataFrame, first: str, last: str, name: str = "calendar_hour") -> DataFrame:
    """Every hour between two instant columns, for each row of ``bounds``."""
    return bounds.select(
        F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 hour"))).alias(name)
    )


def entity_days(
    df: DataFrame,
    entity: str | Sequence[str],
    first: Column,
    last: Column,
    name: str = "calendar_date",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per entity and day of its span, ends included; an empty span gives no row.

    The grid is generated from each entity's own bounds, in place of joining a calendar on a range.
    """
    spans = df.select(*as_list(entity), *carry, F.to_date(first).alias("__a"), F.to_date(last).alias("__b"))
    return (
        spans.where(F.col("__a") <= F.col("__b"))
        .withColumn(name, F.explode(F.sequence("__a", "__b", F.expr("interval 1 day"))))
        .drop("__a", "__b")
    )


def days_of_periods(periods: DataFrame, start: str, end: str, name: str = "calendar_date") -> DataFrame:
    """Explode a period table to its days, so that a range join with it becomes an equi join."""
    return periods.withColumn(
        name, F.explode(F.sequence(F.to_date(start), F.to_date(end), F.expr("interval 1 day")))
    )
