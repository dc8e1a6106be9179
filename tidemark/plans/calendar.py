"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import is_us_holiday


def calendar_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Days from ``first`` to ``last`` (ends included) with weekday, weekend, holiday and Monday = 0 index."""
    days = bounds.select(
        F.explode(F.sequence(F.to_date(first), F.to_date(last), F.expr("interval 1 day"))).alias("day")
    )
    weekday = F.weekday("day")
    return days.select(
        F.col("day").cast("timestamp").alias("date"),
        (weekday < 5).alias("is_weekday"),
        (weekday >= 5).alias("is_weekend"),
        is_us_holiday("day").alias("is_holiday"),
        weekday.alias("day_of_week"),
    )


def calendar(spark: SparkSession, as_of: str, years: int = 5) -> DataFrame:
    """Calendar of 365 * ``years`` days on each side of ``as_of``."""
    reach = 365 * years
    day = F.to_date(F.lit(as_of))
    bounds = spark.range(1).select(F.date_sub(day, reach).alias("a"), F.date_add(day, reach).alias("b"))
    return calendar_between(bounds, "a", "b")
