"""Logical table names, resolved to catalog tables or folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .tables import SAVE_MODES, write_table


class Tables:
    """Where the tables of a deployment live: ``{logical name: catalog name or folder}``.

    A location with a slash is a parquet folder, anything else a table of the session's catalog,
    with up to three name levels. Pipelines get DataFrames from here and know no names.
    """

    def __init__(self, spark: SparkSession, locations: Mapping[str, str]) -> None:
        self.spark = spark
        self.locations = dict(locations)

    def _location(self, name: str) -> str:
        try:
            return self.locations[name]
        except KeyError:
            raise KeyError(f"no location for table {name!r}; known: {sorted(self.locations)}") from None

    def read(self, name: str) -> DataFrame:
        location = self._location(name)
        return self.spark.read.parquet(location) if "/" in location else self.spark.read.table(location)

    def write(self, df: DataFrame, name: str, mode: str = "error") -> None:
        location = self._location(name)
        if "/" in location:
            write_table(df, location, mode)
        elif mode not in SAVE_MODES:
            raise ValueError(f"mode must be one of {SAVE_MODES}, not {mode!r}")
        else:
            df.write.mode(mode).format("parquet").saveAsTable(location)
