"""Feature tables and their life cycle on plain files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.hot import any_missing
from .staging import stage

SAVE_MODES = ("append", "overwrite", "ignore", "error")


@dataclass(frozen=True)
class FeatureTable:
    """A DataFrame with its primary key, optional timestamp key and description.

    ``rows`` may name a cheaper table with the entity keys and at least as many rows per entity; hot
    keys are then counted there and the features are not computed for the count. ``observed`` is what
    ``publish`` saw while writing: rows, null_keys (rows with an incomplete key), first and last time.
    ``buckets`` is set by ``publish_bucketed``: the files are dealt to so many by the entity keys.
    """

    name: str
    df: DataFrame = field(repr=False)
    primary_keys: tuple[str, ...]
    timestamp_key: str | None = None
    description: str = ""
    rows: DataFrame | None = field(default=None, repr=False)
    observed: Mapping[str, object] | None = field(default=None, repr=False, compare=False)
    buckets: int | None = None

    def __post_init__(self) -> None:
        columns = {c.lower() for c in self.df.columns}
        wanted = [*self.primary_keys, *([self.timestamp_key] if self.timestamp_key else [])]
        missing = [c for c in wanted if c.lower() not in columns]
        if missing or not self.primary_keys:
            raise ValueError(f"{self.name}: key columns missing: {missing or 'none given'}")
        if self.timestamp_key and self.timestamp_key not in self.primary_keys:
            raise ValueError(f"{self.name}: the timestamp key belongs to the primary keys")

    @property
    def entity_keys(self) -> tuple[str, ...]:
        return tuple(k for k in self.primary_keys if k != self.timestamp_key)

    @property
    def features(self) -> list[str]:
        keys = {k.lower() for k in self.primary_keys}
        return [c for c in self.df.columns if c.lower() not in keys]


class KeyViolation(ValueError):
    """Primary keys that are NULL or occur more than once."""


def read_query(
    spark: SparkSession, fmt: str, options: Mapping[str, str], query: str | None = None
) -> DataFrame:
    """Load from any Spark source; ``query`` is pushed to sources that take one (JDBC, warehouses)."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.option("query", query) if query else reader).load()


def read_sql(
    spark: SparkSession, text: str, parameters: Mapping[str, object] | None = None, **frames: DataFrame
) -> DataFrame:
    """Rows of a query with named markers (``:name``) for values and ``{name}`` for DataFrames.

    Values are bound as typed literals (lists as arrays), so quotes in them are harmless; a marker without a value and a
    value without a marker are refused.
    """
    parameters = dict(parameters or {})
    # markers outside of quoted text; a cast's double colon is none
    bare = re.sub(r"'(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*", "", text)
    markers = set(re.findall(r"(?<!:):([A-Za-z_]\w*)", bare))
    if markers != parameters.keys():
        raise ValueError(f"values for {sorted(parameters)}, but the text has markers {sorted(markers)}")
    bound = {n: F.array(*map(F.lit, v)) if isinstance(v, list) else v for n, v in parameters.items()}
    return spark.sql(text, bound, **frames)


def write_table(df: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = ()) -> None:
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}, not {mode!r}")
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are incomplete or occur more than once, with their row count in ``rows``."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where((F.col("rows") > 1) | any_missing(keys))
    )


def check_keys(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    bad = key_violations(df, keys).first()
    if bad is not None:
        raise KeyViolation(f"{name}: primary key violated by {bad.asDict()}")


def _beside(path: str) -> str:
    """A name of its own for a staged copy, so that two writers never meet in it."""
    return f"{path.rstrip('/')}__staged-{uuid.uuid4().hex}"


def _drop(spark: SparkSession, path: str) -> None:
    """Remove a staged copy; called only after what it was for has been written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def publish(
    table: FeatureTable, path: str, mode: str = "error", partition_by: Sequence[str] = (), staging: str | None = None
) -> FeatureTable:
    """Write a feature table and answer it as read back; bad keys raise and leave no table behind.

    The rows are computed once, into a staged copy; they are counted and looked over for NULL keys and bounds of
    time on their way (``observed`` of the answer). The check for repeated keys and the final write read that
    copy, which is removed in the end. Appended rows must not repeat a key of the table either. ``error`` and
    ``ignore`` look at the path before anything is computed.

    ``staging`` names the staged copy as a table of its own: it is overwritten by every run and kept, also when bad keys
    keep the feature table from being written, so that they can be looked up in it.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}, not {mode!r}")
    if staging is not None and staging.rstrip("/") == path.rstrip("/"):
        raise ValueError(f"{table.name}: the staging table must not be the table itself")
    spark = table.df.sparkSession
    current = existing(spark, path)
    if current is not None and mode == "error":
        raise FileExistsError(f"{table.name}: a table exists at {path}")
    observed = None
    if current is None or mode != "ignore":
        place = staging or _beside(path)
        seen = Observation()
        facts = [F.count(F.lit(1)).alias("rows"), F.count_if(any_missing(table.primary_keys)).alias("null_keys")]
        if table.timestamp_key:
            facts += [F.min(table.timestamp_key).alias("first"), F.max(table.timestamp_key).alias("last")]
        staged = stage(table.df.observe(seen, *facts), place)
        try:
            observed = seen.get
            if observed["null_keys"]:
                raise KeyViolation(f"{table.name}: primary key violated by {observed['null_keys']} rows with NULLs in it")
            # whether keys repeat is the one question that takes another look at the rows
            check_keys(staged, table.primary_keys, table.name)
            if current is not None and mode == "append":
                keys = staged.select(*table.primary_keys)
                known = current.join(keys, list(table.primary_keys), "left_semi").select(*table.primary_keys).first()
                if known is not None:
                    raise KeyViolation(f"{table.name}: the table already has {known.asDict()}")
            write_table(staged, path, mode, partition_by)
        finally:
            if staging is None:
                _drop(spark, place)
    return FeatureTable(
        table.name, spark.read.parquet(path).select(*table.df.columns),
        table.primary_keys, table.timestamp_key, table.description, observed=observed,
    )


def publish_bucketed(table: FeatureTable, name: str, path: str, buckets: int) -> FeatureTable:
    """Write a feature table for lookups: bucketed by its entity keys, sorted by key and time, under ``name`` in the catalog.

    Lookups then leave it where it lies (``asof_join`` with ``buckets``). A table of that name or files at ``path`` are refused;
    bad keys raise and leave no table. One task writes a bucket; a bucket that a hot key makes
    big is cut among several by adaptive execution, each sorted on its own. Choose ``buckets`` so that one fits a task.
    """
    spark = table.df.sparkSession
    if buckets < 1:
        raise ValueError(f"{table.name}: buckets must be positive, not {buckets}")
    if not table.entity_keys:
        raise ValueError(f"{table.name}: no entity key to bucket by")
    if spark.catalog.tableExists(name) or existing(spark, path) is not None:
        raise FileExistsError(f"{table.name}: a table exists as {name} or at {path}")
    place = _beside(path)
    staged = stage(table.df, place)
    try:
        check_keys(staged, table.primary_keys, table.name)
        keys = list(table.entity_keys)
        order = keys + ([table.timestamp_key] if table.timestamp_key else [])
        dealt = staged.hint("rebalance", buckets, *keys)
        dealt.write.bucketBy(buckets, *keys).sortBy(*order).option("path", path).format("parquet").saveAsTable(name)
    finally:
        _drop(spark, place)
    return FeatureTable(
        table.name, spark.table(name).select(*table.df.columns), table.primary_keys, table.timestamp_key, table.description, buckets=buckets
    )


def upserted(current: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after a merge: updates replace rows of equal key, new keys are added."""
    kept = current.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(*current.columns).unionByName(updates.select(*current.columns))


def upsert(
    spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], partition_by: str | None = None
) -> DataFrame:
    """Merge updates into the table at ``path`` and read it back.

    With ``partition_by`` only the partitions the updates touch are read and replaced, the NULL one
    like any other. If the partition column is not one of the keys, an update may move a key to another
    partition; then the whole table is written, as it is without ``partition_by``. Updates are computed
    once. The merged rows are staged first, so that nothing is overwritten while it is read; the staged
    copies are removed after the last write, and stay if that fails. Readers should be kept off while a
    table without partitions is replaced.
    """
    places = [_beside(path), _beside(path)]
    updates = stage(updates, places[0])
    check_keys(updates, keys, "updates")
    current = spark.read.parquet(path)
    whole = partition_by is None
    if partition_by is not None and partition_by not in keys:
        new = updates.select(*keys, F.col(partition_by).alias("__new"))
        moved = current.select(*keys, partition_by).join(new, list(keys)).where(~F.col(partition_by).eqNullSafe(F.col("__new")))
        whole = not moved.isEmpty()
    affected = current
    if not whole:
        touched = updates.select(F.col(partition_by).alias("__touched")).distinct()
        affected = current.join(touched, F.col(partition_by).eqNullSafe(F.col("__touched")), "left_semi")
    merged = stage(upserted(affected.select(*current.columns), updates, keys), places[1])
    writer = merged.write.mode("overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "static" if whole else "dynamic")
    writer.parquet(path)
    for place in places:
        _drop(spark, place)
    return spark.read.parquet(path).select(*current.columns)


def look_back(df: DataFrame, ts: str, as_of: str, days: int, until_days: int = 0) -> DataFrame:
    """Rows from ``days`` before ``as_of`` up to ``until_days`` before it (that day excluded).

    The bounds are literals in the column's own type, so the filter reaches the scan.
    """
    kind = dict(df.dtypes)[ts]
    day = F.to_date(F.lit(as_of))
    return df.where(
        (F.col(ts) >= F.date_sub(day, days).cast(kind)) & (F.col(ts) < F.date_sub(day, until_days).cast(kind))
    )
