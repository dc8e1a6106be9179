"""Rolling measures over a dense grid with one row per key and day.

The groups here are bounded by the length of the calendar, whatever the volume of the events that
were aggregated into it, so a plain window per key is safe. A frame of n means n preceding rows and
the current one, n + 1 rows; None means all rows so far.

No measure reads its frame: each is a difference of running totals, so its cost per row does not grow
with the frame, and all of them share one shuffle and sort by key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hot import as_list

Frames = Mapping[str, tuple[str, int | None]]

# decimals at which averaged values are summed, so that running sums can be subtracted without drift
MEAN_SCALE = 10


def _over(keys: str | Sequence[str], order: str):
    by = Window.partitionBy(*as_list(keys)).orderBy(order)
    return by, by.rowsBetween(Window.unboundedPreceding, 0)


def rolling_totals(df: DataFrame, keys: str | Sequence[str], order: str, frames: Frames) -> DataFrame:
    """Rolling sums of whole-number columns, ``{output: (column, frame)}``.

    Each is the difference of two running totals, so the cost per row does not grow with the frame.
    """
    by, sofar = _over(keys, order)
    sources = dict.fromkeys(column for column, _ in frames.values())
    totals = df.select("*", *[F.sum(c).over(sofar).alias(f"__run_{c}") for c in sources])
    outputs = []
    for out, (column, n) in frames.items():
        run = F.col(f"__run_{column}")
        outputs.append((run if n is None else run - F.lag(run, n + 1, 0).over(by)).alias(out))
    return totals.select(*df.columns, *outputs)


def rolling_means(df: DataFrame, keys: str | Sequence[str], order: str, frames: Frames) -> DataFrame:
    """Rolling averages, ``{output: (column, frame)}``; NULL days do not count.

    A value enters at ``MEAN_SCALE`` decimals, as a decimal of 38 digits: running sums of doubles would drift
    when subtracted. Values must be finite; totals may have 28 digits before the point.
    """
    by, sofar = _over(keys, order)
    sources = dict.fromkeys(column for column, _ in frames.values())
    runs = []
    for c in sources:
        exact = F.col(c).cast(f"decimal(38,{MEAN_SCALE})")
        runs.append(F.sum(F.coalesce(exact, F.lit(0).cast(f"decimal(38,{MEAN_SCALE})"))).over(sofar).alias(f"__run_{c}"))
        runs.append(F.count(c).over(sofar).alias(f"__n_{c}"))
    totals = df.select("*", *runs)
    nothing = F.lit(0).cast(f"decimal(38,{MEAN_SCALE})")
    outputs = []
    for out, (column, n) in frames.items():
        run, count = F.col(f"__run_{column}"), F.col(f"__n_{column}")
        if n is not None:
            run = run - F.coalesce(F.lag(run, n + 1).over(by), nothing)
            count = count - F.lag(count, n + 1, 0).over(by)
        outputs.append(F.when(count > 0, run.cast("double") / count).alias(out))
    return totals.select(*df.columns, *outputs)


def rolling_distinct(df: DataFrame, keys: str | Sequence[str], order: str, frames: Frames) -> DataFrame:
    """Exact rolling distinct counts, ``{output: (column, frame)}``; NULLs do not count.

    A sweep with expiries: a value enters a frame of n on its row, unless it was on one of the n rows
    before, and leaves it n + 1 rows later, unless it comes again on one of the n rows after. The count
    is what has entered so far less what has left, so no set is built per row.
    """
    keys = as_list(keys)
    by, sofar = _over(keys, order)
    swept = df.withColumn("__row", F.row_number().over(by))
    columns = dict.fromkeys(column for column, _ in frames.values())
    for c in columns:
        # clustered by the keys already, so this is one more sort and no shuffle
        same = Window.partitionBy(*keys, c).orderBy(order)
        swept = swept.withColumns(
            {
                f"__since_{c}": F.col("__row") - F.lag("__row").over(same),
                f"__until_{c}": F.lead("__row").over(same) - F.col("__row"),
            }
        )

    def apart(column: str, gap: Column, n: int | None) -> Column:
        """1 if the value is there and its neighbour occurrence is outside of the frame."""
        far = gap.isNull() if n is None else gap.isNull() | (gap > n)
        return F.when(F.col(column).isNotNull() & far, 1).otherwise(0)

    steps = list(dict.fromkeys(frames.values()))
    running = []
    for c, n in steps:
        running.append(F.sum(apart(c, F.col(f"__since_{c}"), n)).over(sofar).alias(f"__in_{c}_{n}"))
        if n is not None:
            running.append(F.sum(apart(c, F.col(f"__until_{c}"), n)).over(sofar).alias(f"__out_{c}_{n}"))
    swept = swept.select(*df.columns, *running)
    outputs = []
    for out, (c, n) in frames.items():
        entered = F.col(f"__in_{c}_{n}")
        outputs.append((entered if n is None else entered - F.lag(f"__out_{c}_{n}", n + 1, 0).over(by)).alias(out))
    return swept.select(*df.columns, *outputs)
