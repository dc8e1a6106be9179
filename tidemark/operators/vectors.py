"""Totals and running totals of hour-of-week vectors."""

from __future__ import annotations

from functools import reduce
from operator import and_
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.weekhours import WEEK_HOURS
from ..session import ship
from .hot import BLOCK, SPLIT, Split, as_list, cut_hot_keys


def _week_vectors(groups: int):
    """Arrow function: one dense vector per group from (group, slot, count) rows sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, open_keys, open_vector = _GroupStarts(), None, None
        schema = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            fresh = starts.mark(batch.columns[:groups])
            heads = np.flatnonzero(fresh)
            continued = open_keys is not None and not fresh[0]
            member = np.cumsum(fresh) - (0 if continued else 1)
            vectors = np.zeros((member[-1] + 1, WEEK_HOURS), dtype=np.int32)
            slot, count = (c.to_numpy(zero_copy_only=False) for c in batch.columns[-2:])
            np.add.at(vectors, (member, slot), count)
            keys = batch.select(range(groups)).take(pa.array(heads))
            schema = keys.schema
            if continued:
                vectors[0] += open_vector
            if open_keys is not None:
                keys = pa.concat_batches([open_keys, keys])
                if not continued:
                    vectors = np.concatenate([open_vector[None, :], vectors])
            # the last group may go on in the next batch
            done = len(vectors) - 1
            if done:
                yield _with_vectors(keys.slice(0, done), vectors[:done])
            open_keys, open_vector = keys.slice(done), vectors[done]
        if open_keys is not None and schema is not None:
            yield _with_vectors(open_keys, open_vector[None, :])

    return run


def _with_vectors(kept: pa.RecordBatch, vectors: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * WEEK_HOURS)
    arrays = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(vectors).reshape(-1)))
    return pa.RecordBatch.from_arrays([*kept.columns, arrays], names=[*kept.schema.names, "vector"])


def vector_total(
    df: DataFrame, keys: str | Sequence[str], first_slot: Column, hours: Column, name: str
) -> DataFrame:
    """Element-wise sum per key of the week vectors of shifts.

    Only the covered hours are exploded and counted, map-side first; at most 168 counts per key are
    then laid out as a vector.
    """
    keys = as_list(keys)
    counted = (
        df.select(*keys, first_slot.cast("int").alias("__first"), hours.cast("int").alias("__hours"))
        .select(*keys, F.explode(F.sequence("__first", F.col("__first") + F.col("__hours") - 1)).alias("__hour"))
        .groupBy(*keys, F.pmod("__hour", F.lit(WEEK_HOURS)).alias("__slot"))
        .agg(F.count(F.lit(1)).cast("int").alias("__n"))
    )
    schema = T.StructType([counted.schema[k] for k in keys] + [T.StructField(name, T.ArrayType(T.IntegerType()))])
    placed = counted.repartition(*keys).sortWithinPartitions(*keys)
    ship(placed.sparkSession)
    return placed.mapInArrow(_week_vectors(len(keys)), schema)


class _GroupStarts:
    """Marks the rows at which a sorted stream of Arrow batches enters a new group."""

    def __init__(self) -> None:
        self.last: tuple | None = None

    def mark(self, columns: list[pa.Array]) -> np.ndarray:
        size = len(columns[0])
        fresh = np.zeros(size, dtype=bool)
        fresh[0] = self.last != tuple(c[0].as_py() for c in columns)
        for column in columns:
            codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            fresh[1:] |= codes[1:] != codes[:-1]
        self.last = tuple(c[size - 1].as_py() for c in columns)
        return fresh


def _accumulate(groups: int, exclusive: bool):
    """Arrow function: cumulative 168-vectors over rows sorted by group.

    Columns are the group, further columns to keep, then first slot, hours and an optional ready
    vector. Rows with a ready vector add it; in the inclusive form they only seed the group and are
    not emitted. State is one vector, so a group of any length streams through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hours_of_week = np.arange(WEEK_HOURS, dtype=np.int32)
        starts, total = _GroupStarts(), np.zeros(WEEK_HOURS, dtype=np.int32)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            first, hours, ready = batch.columns[-3:]
            first = first.fill_null(0).to_numpy(zero_copy_only=False)
            hours = hours.fill_null(0).to_numpy(zero_copy_only=False)
            steps = (((hours_of_week[None, :] - first[:, None]) % WEEK_HOURS) < hours[:, None]).astype(np.int32)
            seeded = np.asarray(ready.is_valid())
            if seeded.any():
                steps[seeded] = np.asarray(ready.drop_null().flatten(), dtype=np.int32).reshape(-1, WEEK_HOURS)
            fresh = starts.mark(batch.columns[:groups])
            sums = np.cumsum(steps, axis=0, dtype=np.int32)
            heads = np.flatnonzero(fresh)
            if len(heads) == 0 or heads[0] != 0:
                heads = np.concatenate(([0], heads))
                opening = total
            else:
                opening = np.zeros(WEEK_HOURS, dtype=np.int32)
            base = np.empty((len(heads), WEEK_HOURS), dtype=np.int32)
            base[0] = opening
            base[1:] = -sums[heads[1:] - 1]
            sums += np.repeat(base, np.diff(np.append(heads, batch.num_rows)), axis=0)
            total = sums[-1].copy()
            emitted = sums - steps if exclusive else sums[~seeded]
            kept = batch.columns[:-3]
            if not exclusive and seeded.any():
                kept = [c.filter(pa.array(~seeded)) for c in kept]
            yield _with_vectors(pa.RecordBatch.from_arrays(kept, names=batch.schema.names[:-3]), emitted)

    return run


def _stream(df: DataFrame, kept: list[str], order: list[str], exclusive: bool, groups: int) -> DataFrame:
    """Bring each group together in order and run the accumulation over the stream.

    The number of partitions is stated, since a vector is some thirty times its input and partitions
    merged by the size of the input would come out far too large.
    """
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("vector", T.ArrayType(T.IntegerType()))])
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ship(df.sparkSession)
    placed = df.repartition(partitions, *kept[:groups]).sortWithinPartitions(*order)
    return placed.select(*kept, "__first", "__hours", "__ready").mapInArrow(
        _accumulate(groups, exclusive), schema
    )


def running_vector(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str,
    first_slot: Column,
    hours: Column,
    name: str,
    *,
    split: Split | None = SPLIT,
    sized_by: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Per key and instant, the element-wise sum of the week vectors so far, own row included.

    One row per key and instant expected. What is shuffled is the shift (two small numbers), not
    its vector. Hot keys are cut into blocks of time; each block is seeded with the total of the
    earlier ones, sent along as one more row, so that there is a single shuffle and no join.
    """
    keys = as_list(keys)
    shifts = df.select(
        *keys, order, first_slot.cast("int").alias("__first"), hours.cast("int").alias("__hours")
    )
    vector = T.ArrayType(T.IntegerType())
    nothing = F.lit(None)

    def plain(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("__ready", nothing.cast(vector))
        return _stream(rows, [*keys, order], [*keys, order], False, len(keys)).select(
            *keys, order, F.col("vector").alias(name)
        )

    cut = None if split is None else cut_hot_keys(shifts, keys, order, split, sized_by or [shifts])
    if cut is None:
        return plain(shifts)

    totals = vector_total(cut.hot, [*keys, BLOCK], F.col("__first"), F.col("__hours"), "__ready").select(
        "*", nothing.cast("int").alias("__first"), nothing.cast("int").alias("__hours")
    )
    seeds = _stream(totals, [*keys, BLOCK], [*keys, BLOCK], True, len(keys)).withColumnRenamed("vector", "__ready")

    rows = cut.hot.withColumn("__ready", nothing.cast(vector))
    both = rows.unionByName(seeds, allowMissingColumns=True).withColumn("__event", F.col("__ready").isNull())
    ordered = [*keys, BLOCK, "__event", order]
    hot = _stream(both, [*keys, BLOCK, order], ordered, False, len(keys) + 1).select(
        *keys, order, F.col("vector").alias(name)
    )
    return plain(cut.rest).unionByName(hot)


def continue_vector(window: DataFrame, state: DataFrame, keys: str | Sequence[str], name: str) -> DataFrame:
    """A running vector over a window of time plus each key's last vector before it; keys without one begin anew."""
    keys = as_list(keys)
    held = state.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(name).alias("__seed"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    total = F.zip_with(F.col(name), F.col("__seed"), lambda a, b: a + b)
    rest = [c for c in window.columns if c != name]
    return window.join(held, same, "left").select(*rest, F.coalesce(total, F.col(name)).alias(name))
