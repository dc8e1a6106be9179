"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hot import as_list


def keep_first(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order; pass a total order for a repeatable choice.

    Spark limits every map task to its own first row per key before it shuffles, so a hot key
    sends one row per task.
    """
    ranked = Window.partitionBy(*as_list(keys)).orderBy(*order_by)
    return df.withColumn("__rank", F.row_number().over(ranked)).where(F.col("__rank") == 1).drop("__rank")


def most_frequent(df: DataFrame, keys: str | Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Mode of a column per key; the smallest value wins a tie, NULLs do not count."""
    keys = as_list(keys)
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min_by(F.col(value), F.struct(-F.col("__n"), F.col(value)))
    return counted.groupBy(*keys).agg(best.alias(name or value))
