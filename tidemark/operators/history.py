"""Histories from change logs, and counts of what is in force."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hot import SPLIT, Split
from .running import run_previous, run_sum, running

OPEN_START = "2001-01-01"
OPEN_END = "2099-01-01"


def change_log_to_history(
    current: DataFrame,
    edits: DataFrame,
    entity: str,
    old: str,
    new: str,
    at: str,
    *,
    value: str,
    prefer: Sequence[str] = (),
    entities: DataFrame | None = None,
    split: Split | None = SPLIT,
) -> DataFrame:
    """(entity, effective start) -> value, from the current state and the log of edits.

    An edit says which value held until its instant; the current value holds until the open end.
    Edits that change nothing are dropped, of several at one instant the first by ``prefer`` (then
    by old value) stays. ``current`` has the columns entity and ``new``; ``entities`` keeps only
    the listed ones.
    """
    kind = dict(edits.dtypes)[at]
    states = current.select(
        entity, F.col(new).alias("__value"), F.lit(OPEN_END).cast(kind).alias("__until"),
        F.struct(*[F.lit(None).cast(dict(edits.dtypes)[c]).alias(c) for c in prefer], F.col(new).alias("__value")).alias("__rank"),
    ).unionByName(
        edits.where(F.col(old) != F.col(new)).select(
            entity, F.col(old).alias("__value"), F.col(at).alias("__until"),
            F.struct(*prefer, F.col(old).alias("__value")).alias("__rank"),
        )
    )
    if entities is not None:
        states = states.join(entities.select(entity).distinct(), entity, "left_semi")
    settled = states.groupBy(entity, "__until").agg(F.min_by("__value", "__rank").alias(value))
    return running(
        settled, entity, "__until",
        {"start_date": run_previous("__until", F.lit(OPEN_START).cast(kind))},
        split=split, sized_by=[edits],
    ).select(entity, value, "start_date")


def change_points(instants: Sequence[DataFrame], entity: str, at: str) -> DataFrame:
    """Every distinct (entity, instant) at which one of the sources may change state."""
    stacked = instants[0].select(entity, at)
    for more in instants[1:]:
        stacked = stacked.unionByName(more.select(entity, at))
    return stacked.where(F.col(at).isNotNull()).distinct()


def in_force_counts(
    deltas: DataFrame,
    keys: Sequence[str],
    at: str,
    counts: Mapping[str, str],
    *,
    split: Split | None = SPLIT,
    sized_by: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Counts in force from each instant on: the running sum of signed changes.

    Adding +1 where something begins and -1 where it ends gives the same counts as a containment
    join, without pairing instants with everything in force. ``counts`` maps output to delta column.
    """
    instants = deltas.groupBy(*keys, at).agg(*[F.sum(c).alias(f"__d_{out}") for out, c in counts.items()])
    sums = running(
        instants, keys, at, {out: run_sum(f"__d_{out}") for out in counts}, split=split,
        sized_by=[deltas] if sized_by is None else sized_by,
    )
    return sums.select(*keys, at, *counts)
