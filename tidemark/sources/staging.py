"""Cutting lineage through written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """Folder for staged tables: the shared one the session names.

    Without one, a local run gets a temporary folder and a cluster is refused, since a folder of
    one machine is invisible to the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="tidemark-")


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write and read back: computed once, cut from its lineage, safe from the loss of executors."""
    target = path or f"{work_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
