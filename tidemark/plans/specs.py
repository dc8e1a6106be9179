"""Named feature specs: what a training set is made of, stored as a description and created once."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hot import SPLIT, Split
from ..sources.tables import FeatureTable
from .training import Derived, Feature, Lookup, build_training_set


class SpecConflict(ValueError):
    """Another spec is stored under the name."""


@dataclass(frozen=True)
class FeatureSpec:
    """Lookups and derived columns under a name, with the label and the columns to leave out.

    Tables count by their name and keys and functions by theirs, so a description holds no data and no code.
    """

    name: str
    features: tuple[Feature, ...]
    label: str | None = None
    exclude_columns: tuple[str, ...] = ()

    def description(self) -> dict:
        return {
            "features": [_describe(f) for f in self.features],
            "label": self.label,
            "exclude_columns": list(self.exclude_columns),
        }

    def content_hash(self) -> str:
        """Equal for equal descriptions, whatever the name; the order of features counts, of bindings not."""
        return hashlib.sha256(_canonical(self.description()).encode()).hexdigest()

    def training_set(self, labels: DataFrame, *, split: Split | None = SPLIT) -> DataFrame:
        return build_training_set(labels, self.features, self.label, self.exclude_columns, split=split)


def _canonical(description: Mapping) -> str:
    return json.dumps(description, sort_keys=True, separators=(",", ":"))


def _describe(feature: Feature) -> dict:
    if isinstance(feature, Derived):
        return {
            "kind": "derived",
            "function": feature.function.__name__,
            "output": feature.output_name,
            "bindings": dict(feature.input_bindings),
        }
    return {
        "kind": "lookup",
        "table": feature.table.name,
        "primary_keys": list(feature.table.primary_keys),
        "timestamp_key": feature.table.timestamp_key,
        "keys": list(feature.keys()),
        "at": feature.timestamp_lookup_key,
        "columns": feature.features(),
    }


def _place(folder: str, name: str) -> str:
    if not name or set(name) & set("/\\:*?") or name.startswith((".", "_")):
        raise ValueError(f"not a name for a spec: {name!r}")
    return f"{folder.rstrip('/')}/{name}"


def stored_description(spark: SparkSession, name: str, folder: str) -> tuple[str, dict] | None:
    """(hash, description) of the spec stored under the name, None if there is none."""
    try:
        row = spark.read.schema("hash string, description string").json(_place(folder, name)).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if row is None else (row["hash"], json.loads(row["description"]))


def create_spec(spark: SparkSession, spec: FeatureSpec, folder: str) -> str:
    """Store a spec and answer its hash. An equal one under the name is left as it is; a different one
    raises ``SpecConflict``, and stays."""
    own = spec.content_hash()
    stored = stored_description(spark, spec.name, folder)
    if stored is None:
        row = spark.range(1).select(F.lit(own).alias("hash"), F.lit(_canonical(spec.description())).alias("description"))
        # of two writers at once the second is refused by the path
        row.coalesce(1).write.mode("error").json(_place(folder, spec.name))
    elif stored[0] != own:
        raise SpecConflict(f"{spec.name}: stored as {stored[0][:12]}, asked for as {own[:12]}")
    return own


def load_spec(
    spark: SparkSession, name: str, folder: str, tables: Mapping[str, FeatureTable],
    functions: Mapping[str, Callable[..., Column]] | None = None,
) -> FeatureSpec:
    """The stored spec on given tables and functions, which must have the names and keys it was made with."""
    stored = stored_description(spark, name, folder)
    if stored is None:
        raise KeyError(f"no spec {name!r} in {folder}")
    _, description = stored
    features: list[Feature] = []
    for f in description["features"]:
        if f["kind"] == "derived":
            features.append(Derived((functions or {})[f["function"]], f["output"], f["bindings"]))
            continue
        table = tables[f["table"]]
        if (list(table.primary_keys), table.timestamp_key) != (f["primary_keys"], f["timestamp_key"]):
            raise SpecConflict(f"{name}: {table.name} is keyed by {table.primary_keys}, stored with {f['primary_keys']}")
        features.append(Lookup(table, tuple(f["keys"]), f["at"], tuple(f["columns"]), f["columns"]))
    spec = FeatureSpec(name, tuple(features), description["label"], tuple(description["exclude_columns"]))
    if spec.content_hash() != stored[0]:
        raise SpecConflict(f"{name}: what is stored does not match its hash")
    return spec
