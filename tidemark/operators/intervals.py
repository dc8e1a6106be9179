"""Joins of instants with validity intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .asof import asof_join, check_new_names, key_pairs
from .hot import SPLIT, Split, all_present

BOUNDS = ("[)", "(]", "[]", "()")


def contains(instant: Column, start: Column, end: Column, bounds: str) -> Column:
    """Whether the instant lies in the interval; ``bounds`` marks which ends belong to it."""
    if bounds not in BOUNDS:
        raise ValueError(f"bounds must be one of {BOUNDS}, not {bounds!r}")
    after = instant >= start if bounds[0] == "[" else instant > start
    before = instant <= end if bounds[1] == "]" else instant < end
    return after & before


def valid_at(
    points: DataFrame,
    history: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    point_ts: str,
    start: str,
    end: str,
    features: Sequence[str],
    *,
    bounds: str = "[)",
    split: Split | None = SPLIT,
    point_rows: DataFrame | None = None,
    history_rows: DataFrame | None = None,
) -> DataFrame:
    """Attach the history row in force at each point, for histories whose intervals do not overlap.

    The only candidate is the latest interval that has begun, so this is an as-of lookup followed
    by a look at its end: no range join, one output row per point. At an instant shared by two
    closed intervals the later one answers. Intervals that hold no instant are left out, so those
    that tied changes leave behind hide nothing; of intervals with equal start the longest counts.
    """
    if bounds not in BOUNDS:
        raise ValueError(f"bounds must be one of {BOUNDS}, not {bounds!r}")
    check_new_names(points.columns, features)
    holds = F.col(start) <= F.col(end) if bounds == "[]" else F.col(start) < F.col(end)
    carried = asof_join(
        points,
        history.where(F.coalesce(holds, F.lit(True))),
        on,
        point_ts,
        start,
        {**{c: f"__f_{c}" for c in features}, end: "__end"},
        strict=bounds[0] == "(",
        split=split,
        left_rows=point_rows,
        right_rows=history_rows,
        right_ties=[end],
    )
    instant = F.col(point_ts).cast(dict(history.dtypes)[end])
    live = instant <= F.col("__end") if bounds[1] == "]" else instant < F.col("__end")
    return carried.select(
        *points.columns, *[F.when(live, F.col(f"__f_{c}")).alias(c) for c in features]
    )


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: str | Sequence[str],
    point_ts: str,
    start: str,
    end: str,
    *,
    bounds: str = "[)",
    unit: str = "day",
    split: Split | None = SPLIT,
) -> DataFrame:
    """All pairs of equal key whose instant lies in the interval; intervals may overlap.

    Points are gathered by the units of time they fall in, and a key's units that hold points are
    numbered. An interval is laid out over the numbers between its ends, found by two as-of lookups, so
    it is copied only to units where points wait: copies follow the pairs, however long an interval is.
    Points meet the intervals of their own unit, which spreads a hot key over time.
    """
    keys = [on] if isinstance(on, str) else list(on)
    check_new_names(points.columns, [c for c in intervals.columns if c not in keys])
    known = points.where(all_present([*keys, point_ts])).withColumn("__slot", F.date_trunc(unit, F.col(point_ts)))
    numbered = Window.partitionBy(*keys).orderBy("__slot")
    # one row per key and unit with points
    slots = known.select(*keys, "__slot").distinct().withColumn("__n", F.row_number().over(numbered))
    placed = intervals.where(all_present([*keys, start, end]) & (F.col(start) <= F.col(end))).select(
        "*", F.date_trunc(unit, F.col(start)).alias("__low"), F.date_trunc(unit, F.col(end)).alias("__high")
    )
    placed = asof_join(placed, slots, keys, "__low", "__slot", {"__n": "__before"}, strict=True, split=split)
    placed = asof_join(placed, slots, keys, "__high", "__slot", {"__n": "__last"}, split=split)
    first = F.coalesce("__before", F.lit(0)) + 1
    cut = placed.where(F.col("__last") >= first).select(
        *intervals.columns, F.explode(F.sequence(first, F.col("__last"))).alias("__n")
    )
    met = known.join(slots, [*keys, "__slot"]).join(cut, [*keys, "__n"])
    rest = [c for c in intervals.columns if c not in keys]
    return met.where(contains(F.col(point_ts), F.col(start), F.col(end), bounds)).select(
        *points.columns, *rest
    )


def lookback_days(
    labels: DataFrame,
    days: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    label_ts: str,
    day: str,
    length: int = 7,
) -> DataFrame:
    """Pairs of labels and distinct event days with day <= t and less than ``length`` whole days before t.

    A label can meet ``length`` days at most, namely those at or after t - length and up to t; it is
    exploded to these and joined on key and day, so a hot key is spread over its days. ``days`` has one row
    per key and day.
    """
    pairs = key_pairs(on)
    keys = [f"__k{i}" for i in range(len(pairs))]
    t = F.col(label_ts)
    today = F.to_date(t)
    probe = labels.select(
        "*",
        *[F.col(l).alias(k) for k, (l, _) in zip(keys, pairs)],
        F.explode(F.sequence(F.date_sub(today, length), today)).alias("__day"),
        # midnight of a day counts only if fewer than `length` whole days passed since
    ).where(F.timestamp_diff("DAY", F.col("__day").cast(dict(labels.dtypes)[label_ts]), t) < length)
    right_keys = [r for _, r in pairs]
    rest = [c for c in days.columns if c not in right_keys and c != day]
    check_new_names(labels.columns, rest)
    events = days.select(
        *[F.col(r).alias(k) for k, r in zip(keys, right_keys)],
        F.to_date(F.col(day)).alias("__day"),
        *rest,
    )
    return probe.join(events, [*keys, "__day"]).select(
        *labels.columns, F.col("__day").alias("event_day"), *rest
    )
