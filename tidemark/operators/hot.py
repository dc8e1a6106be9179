"""Splitting hot keys by time.

A window partitioned by an entity puts the whole history of that entity into one task. That is
fine for most entities and hopeless for one that owns a third of the data. Keys above a row
threshold are therefore cut into blocks of time; each block is a window partition of its own and
receives what came before it as a carry (see ``running``). Keys below the threshold keep one
partition.

Which keys are hot is found beforehand, on the narrowest input that bounds the rows per key
(usually the key column of a source table): by a mergeable sketch, with exact counts for what it names. Without hot keys the plan is the plain window. With
them only the rows of hot keys are staged and counted per unit of time, and units that are still too
big are cut further, into as many equal parts as their rows ask for; all other rows keep the plain
window and are united with them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

BLOCK = "__block"

# hot keys there may be (rows / hot_rows) for them to be named by a sketch; it has 16 counters for each
SKETCHED = 10_000


# Length of the units in microseconds
UNIT_MICROS = {"hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


@dataclass(frozen=True)
class Split:
    """When a key is too big for one task, and the unit of time it is cut into first.

    ``hot_rows`` is the number of rows a task may still sort on its own. ``hot`` holds the hot keys
    where they are known already (see ``if_hot``).
    """

    hot_rows: int = 1_000_000
    unit: str = "day"
    hot: DataFrame | None = field(default=None, repr=False, compare=False)

    def __post_init__(self) -> None:
        if self.unit not in UNIT_MICROS or self.hot_rows < 1:
            raise ValueError(f"unit must be one of {sorted(UNIT_MICROS)} and hot_rows positive: {self}")


SPLIT = Split()


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def all_present(columns: Sequence[str | Column]) -> Column:
    return reduce(and_, [(F.col(c) if isinstance(c, str) else c).isNotNull() for c in columns])


def any_missing(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def _keyed(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [s.select(*keys).where(all_present(keys)) for s in sources])


def hot_candidates(keyed: DataFrame, keys: Sequence[str], rows: int, hot_rows: int) -> DataFrame:
    """Rows of every key with more than ``hot_rows`` of the ``rows`` rows, and of few others.

    A frequency sketch per task, merged into one: with m counters over n rows it misses at most 3.5 n / m of a
    key, and lists those it is sure of by twice that. 16 n / hot_rows counters list every hot key, and 2 n / hot_rows
    places are enough for them. Only the hashes of the listed keys go to the tasks.
    """
    most = max(1, -(-rows // hot_rows))
    hashed = keyed.withColumn("__hash", F.xxhash64(*keys))
    sketched = hashed.agg(F.expr(f"approx_top_k(__hash, {2 * most + 1}, {max(64, 16 * most)})").alias("top"))
    listed = sketched.select(F.explode(F.transform("top", lambda t: t["item"])).alias("__hash"))
    # at most 2 * SKETCHED + 1 rows
    return hashed.join(F.broadcast(listed), "__hash", "left_semi").select(*keys)


def find_hot_keys(sources: Sequence[DataFrame], keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows over all sources as a staged table, or None.

    If all rows together are not more, no key is hot: one count, which reads no key. Else a frequency sketch
    names candidates, and only their rows are grouped and counted exactly. Beyond ``SKETCHED`` possible hot
    keys all keys are grouped. The table stays on the cluster and nothing asks for its broadcast, so it may
    grow with the data (it holds rows / hot_rows keys at most).
    """
    rows = reduce(DataFrame.unionByName, [s.select(F.lit(1).alias("__one")) for s in sources]).count()
    if rows <= hot_rows:
        return None
    keyed = _keyed(sources, keys)
    if rows <= SKETCHED * hot_rows:
        keyed = hot_candidates(keyed, keys, rows, hot_rows)
    hot = stage(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > hot_rows).select(*keys))
    return None if hot.isEmpty() else hot


def if_hot(split: Split | None, sources: Sequence[DataFrame], keys: Sequence[str]) -> Split | None:
    """The split with its hot keys if there are any, else None: one count for several operators on the
    same keys. They must come in the same order; their names may differ."""
    hot = None if split is None else find_hot_keys(sources, keys, split.hot_rows)
    return None if hot is None else replace(split, hot=hot)


@dataclass(frozen=True)
class Cut:
    """The input in two: rows of hot keys, staged, with their block, and all others as they came."""

    hot: DataFrame
    rest: DataFrame


def cut_hot_keys(
    df: DataFrame, keys: Sequence[str], order: str, split: Split, sources: Sequence[DataFrame]
) -> Cut | None:
    """Rows of hot keys with a block apart from the rest, or None if no key is hot.

    Only the hot rows are staged, counted and cut; the others keep the plan they had. Rows with a NULL
    key are never hot.
    """
    hot = split.hot.toDF(*keys) if split.hot is not None else find_hot_keys(sources, keys, split.hot_rows)
    if hot is None:
        return None
    rest = df.join(hot, list(keys), "left_anti").select(*df.columns)
    unit = F.date_trunc(split.unit, F.col(order))
    flagged = stage(df.join(hot, list(keys), "left_semi").select(*df.columns, unit.alias(BLOCK)))
    counts = flagged.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("__rows"))
    crowded = counts.where(F.col("__rows") > split.hot_rows).select(
        *keys, F.unix_micros(BLOCK).alias("__unit"), F.ceil(F.col("__rows") / split.hot_rows).alias("__parts")
    )
    tagged = flagged.withColumn("__unit", F.unix_micros(BLOCK))
    start = F.col("__unit")
    width = F.lit(UNIT_MICROS[split.unit]) / F.col("__parts")
    part = F.floor((F.unix_micros(F.col(order).cast("timestamp")) - start) / width)
    cut = F.timestamp_micros(start + F.floor(part * width).cast("bigint"))
    blocks = tagged.join(crowded, [*keys, "__unit"], "left").select(
        *df.columns, F.when(F.col("__parts").isNull(), F.col(BLOCK)).otherwise(cut).alias(BLOCK)
    )
    return Cut(blocks, rest)


def spread_missing(keys: Sequence[str], order: str) -> Column:
    """Extra window key that scatters rows with a NULL key, of which nothing is asked."""
    return F.when(any_missing(keys), F.xxhash64(order))
