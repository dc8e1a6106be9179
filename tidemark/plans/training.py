"""Training sets: point-in-time lookups and derived columns folded over a label table."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.asof import Features, asof_join, asof_join_many, key_lookup
from ..operators.hot import SPLIT, Split
from ..sources.tables import FeatureTable


@dataclass(frozen=True)
class Lookup:
    """Features of a table by key, as of a time column of the labels if the table has a time key."""

    table: FeatureTable
    lookup_key: str | tuple[str, ...]
    timestamp_lookup_key: str | None = None
    feature_names: tuple[str, ...] | None = None
    rename: Mapping[str, str] | None = None

    def features(self) -> dict[str, str]:
        names = self.feature_names or tuple(self.table.features)
        missing = [n for n in names if n.lower() not in {c.lower() for c in self.table.df.columns}]
        if missing:
            raise ValueError(f"{self.table.name} has no columns {missing}")
        return {n: (self.rename or {}).get(n, n) for n in names}

    def keys(self) -> dict[str, str]:
        own = (self.lookup_key,) if isinstance(self.lookup_key, str) else tuple(self.lookup_key)
        if len(own) != len(self.table.entity_keys):
            raise ValueError(f"{self.table.name} is keyed by {self.table.entity_keys}, got {own}")
        return dict(zip(own, self.table.entity_keys))


@dataclass(frozen=True)
class Derived:
    """A column computed from earlier lookups or from the labels; parameters are bound by name."""

    function: Callable[..., Column]
    output_name: str
    input_bindings: Mapping[str, str]


Feature = Lookup | Derived


def _check_binding(feature: Derived, columns: Sequence[str]) -> None:
    try:
        inspect.signature(feature.function).bind(**feature.input_bindings)
    except TypeError as problem:
        raise ValueError(f"{feature.output_name}: {problem}") from None
    known = {c.lower() for c in columns}
    unknown = sorted(c for c in feature.input_bindings.values() if c.lower() not in known)
    if unknown:
        raise ValueError(f"{feature.output_name}: no columns {unknown} to bind")


def _stacks(lookups: Sequence[Lookup]) -> list[list[Lookup]]:
    """Neighbouring lookups by the same columns of the labels, in tables with a time key and keys of one type.
    A bucketed table is looked up on its own, where it lies."""

    def kind(f: Lookup):
        types = dict(f.table.df.dtypes)
        columns = (*f.table.entity_keys, f.table.timestamp_key)
        return tuple(f.keys()), f.timestamp_lookup_key, tuple(types[c] for c in columns)

    stacks: list[list[Lookup]] = []
    for f in lookups:
        timed = f.table.timestamp_key is not None and f.timestamp_lookup_key is not None
        last = stacks[-1][0] if stacks else None
        laid_out = f.table.buckets is not None or (last is not None and last.table.buckets is not None)
        if timed and not laid_out and last is not None and last.table.timestamp_key is not None and kind(last) == kind(f):
            stacks[-1].append(f)
        else:
            stacks.append([f])
    return stacks


def build_training_set(
    labels: DataFrame,
    features: Sequence[Feature],
    label: str | None = None,
    exclude_columns: Sequence[str] = (),
    *,
    split: Split | None = SPLIT,
) -> DataFrame:
    """One output row per label row. Lookups run first, neighbouring ones by the same key and time in one
    stack, then the derived columns in their order."""
    if label is not None and label.lower() not in {c.lower() for c in labels.columns}:
        raise ValueError(f"the labels have no column {label!r}")
    built = labels
    for lookups in _stacks([f for f in features if isinstance(f, Lookup)]):
        feature = lookups[0]
        renames = feature.features()
        if feature.table.timestamp_key is None:
            table = feature.table.df.select(
                *feature.table.entity_keys, *[F.col(c).alias(out) for c, out in renames.items()]
            )
            built = key_lookup(built, table, feature.keys(), list(renames.values()))
            continue
        if feature.timestamp_lookup_key is None:
            raise ValueError(f"{feature.table.name} has a time key, the lookup names none")
        own = set(feature.keys())
        left_rows = labels if own <= set(labels.columns) else None
        if len(lookups) > 1:
            tables = [
                Features(f.table.df, tuple(f.keys().values()), f.table.timestamp_key, f.features(), f.table.rows)
                for f in lookups
            ]
            built = asof_join_many(
                built, list(feature.keys()), feature.timestamp_lookup_key, tables, split=split, left_rows=left_rows
            )
            continue
        built = asof_join(
            built,
            feature.table.df,
            feature.keys(),
            feature.timestamp_lookup_key,
            feature.table.timestamp_key,
            renames,
            split=split,
            right_rows=feature.table.rows,
            left_rows=left_rows,
            buckets=feature.table.buckets,
        )
    for feature in [f for f in features if isinstance(f, Derived)]:
        _check_binding(feature, built.columns)
        bound = {name: F.col(c) for name, c in feature.input_bindings.items()}
        built = built.withColumn(feature.output_name, feature.function(**bound))
    return built.drop(*exclude_columns)
