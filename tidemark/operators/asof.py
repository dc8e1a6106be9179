"""Point-in-time lookup: the latest feature row at or before each label row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hot import SPLIT, Split, all_present, any_missing
from .running import run_last, running


def key_pairs(on: str | Sequence[str] | Mapping[str, str]) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(name, name) for name in on]


def check_new_names(existing: Sequence[str], added: Sequence[str]) -> None:
    taken = {c.lower() for c in existing}
    clash = sorted(c for c in added if c.lower() in taken)
    if clash:
        raise ValueError(f"columns already present on the left: {clash}")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    left_ts: str,
    right_ts: str,
    features: Sequence[str] | Mapping[str, str] | None = None,
    *,
    strict: bool = False,
    split: Split | None = SPLIT,
    left_rows: DataFrame | None = None,
    right_rows: DataFrame | None = None,
    right_ties: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Attach to every left row the right row with equal key and the greatest time <= its own.

    Both sides are stacked and the last feature row is carried forward per key: one shuffle by
    key, no fan-out, every left row comes out exactly once. ``strict`` asks for a time < its own.
    ``on`` may map left names to right names, ``features`` right names to output names. The left
    key and time are compared in the type of the right side. Of right rows with equal key and time
    the one greatest in ``right_ties`` counts; without ties they must be unique. Left rows without a key match nothing and are spread by time. ``left_rows`` and
    ``right_rows`` name cheaper tables with at least as many rows per key, to count hot keys in.

    ``buckets`` says that ``right`` is a table bucketed into so many by its keys, in the order of ``on`` (see
    ``publish_bucketed``): labels are then dealt to the same buckets, and the right side is read where it lies, without a
    shuffle. Only rows of hot keys leave their bucket. Labels without a key don't take part; they are read once more and added.
    """
    pairs = key_pairs(on)
    right_keys = [r for _, r in pairs]
    if features is None:
        features = [c for c in right.columns if c not in right_keys and c != right_ts]
    renames = dict(features) if isinstance(features, Mapping) else {c: c for c in features}
    check_new_names(left.columns, list(renames.values()))

    keys = [f"__k{i}" for i in range(len(pairs))]
    payload = F.struct(*[F.col(c).alias(out) for c, out in renames.items()])
    lookups = right.where(all_present([*right_keys, right_ts])).select(
        *[F.col(r).alias(k) for k, (_, r) in zip(keys, pairs)],
        F.col(right_ts).alias("__t"),
        F.lit(0).alias("__side"),
        *[F.col(c).alias(f"__tie{i}") for i, c in enumerate(right_ties)],
        payload.alias("__feature"),
    )
    types = dict(lookups.dtypes)
    labels = left.select(
        *[F.col(l).cast(types[k]).alias(k) for k, (l, _) in zip(keys, pairs)],
        F.col(left_ts).cast(types["__t"]).alias("__t"),
        F.lit(-1 if strict else 1).alias("__side"),
        F.struct(*left.columns).alias("__label"),
    )
    left_keys = [l for l, _ in pairs]
    if buckets is not None:
        labels = labels.where(all_present(keys)).repartition(buckets, *keys)
    stacked = labels.unionByName(lookups, allowMissingColumns=True)

    def keyed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
        return df.select(*[F.col(c).cast(types[k]).alias(k) for c, k in names.items()])

    carried = running(
        stacked,
        keys,
        "__t",
        {"__hit": run_last("__feature")},
        ties=["__side", *[f"__tie{i}" for i in range(len(right_ties))]],
        split=split,
        sized_by=[
            keyed(left if left_rows is None else left_rows, dict(zip(left_keys, keys))),
            keyed(right if right_rows is None else right_rows, dict(zip(right_keys, keys))),
        ],
        spread_null_keys=buckets is None,
    )
    met = carried.where(F.col("__side") != 0).select("__label.*", "__hit.*")
    if buckets is None:
        return met
    types = dict(met.dtypes)
    nothing = [F.lit(None).cast(types[out]).alias(out) for out in renames.values()]
    return met.unionByName(left.where(any_missing(left_keys)).select(*left.columns, *nothing))


@dataclass(frozen=True)
class Features:
    """A table of features for ``asof_join_many``: its keys in the order of the labels' keys, its time, and
    the columns to attach, right names to output names. ``rows`` is a cheaper table to count hot keys in."""

    df: DataFrame
    keys: tuple[str, ...]
    ts: str
    columns: Mapping[str, str]
    rows: DataFrame | None = None


def asof_join_many(
    left: DataFrame,
    on: Sequence[str],
    left_ts: str,
    tables: Sequence[Features],
    *,
    split: Split | None = SPLIT,
    left_rows: DataFrame | None = None,
) -> DataFrame:
    """``asof_join`` with several tables of one key at once: all are stacked with the labels and the last row
    of each is carried forward in one shuffle and one sort, where a join per table would move the labels
    each time. Keys and times of the tables must have the same types; the labels' are cast to them."""
    outputs = [out for t in tables for out in t.columns.values()]
    check_new_names([*left.columns], outputs)
    if len({o.lower() for o in outputs}) < len(outputs):
        raise ValueError(f"output columns occur twice: {outputs}")
    keys = [f"__k{i}" for i in range(len(on))]
    kinds = [tuple(dict(t.df.dtypes)[c] for c in (*t.keys, t.ts)) for t in tables]
    if len(set(kinds)) != 1:
        raise ValueError(f"keys and times of the tables differ in type: {kinds}")
    types = dict(zip([*keys, "__t"], kinds[0]))

    stacked = left.select(
        *[F.col(c).cast(types[k]).alias(k) for k, c in zip(keys, on)],
        F.col(left_ts).cast(types["__t"]).alias("__t"),
        F.lit(1).alias("__side"),
        F.struct(*left.columns).alias("__label"),
    )
    counted = [(left if left_rows is None else left_rows).select(*[F.col(c).cast(types[k]).alias(k) for k, c in zip(keys, on)])]
    for i, t in enumerate(tables):
        renamed = [F.col(c).alias(k) for k, c in zip(keys, t.keys)]
        payload = F.struct(*[F.col(c).alias(out) for c, out in t.columns.items()]).alias(f"__feature{i}")
        rows = t.df.where(all_present([*t.keys, t.ts])).select(*renamed, F.col(t.ts).alias("__t"), F.lit(0).alias("__side"), payload)
        stacked = stacked.unionByName(rows, allowMissingColumns=True)
        counted.append((t.df if t.rows is None else t.rows).select(*[F.col(c).cast(types[k]).alias(k) for k, c in zip(keys, t.keys)]))
    carried = running(
        stacked, keys, "__t", {f"__hit{i}": run_last(f"__feature{i}") for i in range(len(tables))},
        ties=["__side"], split=split, sized_by=counted, spread_null_keys=True,
    )
    return carried.where(F.col("__side") == 1).select("__label.*", *[f"__hit{i}.*" for i in range(len(tables))])


def asof_join_collapsed(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    left_ts: str,
    right_ts: str,
    features: Sequence[str] | Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """``asof_join`` for labels of which many share key and instant: each (key, instant) is looked up once and
    joined back. The labels themselves then meet a table that is unique in the join's key, so however many
    are at one instant, adaptive skew joins can split them; the stack holds one of them. Labels without a key or
    time match nothing."""
    pairs = key_pairs(on)
    if features is None:
        features = [c for c in right.columns if c not in [r for _, r in pairs] and c != right_ts]
    renames = dict(features) if isinstance(features, Mapping) else {c: c for c in features}
    check_new_names(left.columns, list(renames.values()))
    asked = [*[l for l, _ in pairs], left_ts]
    names = [f"__p{i}" for i in range(len(asked))]
    probes = left.where(all_present(asked)).select(*[F.col(c).alias(n) for c, n in zip(asked, names)]).distinct()
    found = asof_join(probes, right, dict(zip(names, [r for _, r in pairs])), names[-1], right_ts, renames, **options)
    same = reduce(and_, [F.col(c) == F.col(n) for c, n in zip(asked, names)])
    return left.join(found, same, "left").select(*left.columns, *renames.values())


def key_lookup(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Attach the row of a table without time key; its keys are unique, so rows are kept one to one."""
    pairs = key_pairs(on)
    right_keys = [r for _, r in pairs]
    if features is None:
        features = [c for c in right.columns if c not in right_keys]
    check_new_names(left.columns, features)
    keys = [f"__k{i}" for i in range(len(pairs))]
    table = right.select(*[F.col(r).alias(k) for k, r in zip(keys, right_keys)], *features)
    types = dict(table.dtypes)
    probe = left.select("*", *[F.col(l).cast(types[k]).alias(k) for k, (l, _) in zip(keys, pairs)])
    return probe.join(table, keys, "left").select(*left.columns, *features)
