"""Session settings the operators are written for."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Spark's own means against skew and wrong partition counts; all but the time zone are its defaults
# or close to them, and are named here because the operators count on them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # splitting a hot join key is worth one more shuffle after it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(builder: SparkSession.Builder, shared_dir: str | None = None) -> SparkSession.Builder:
    """Apply the settings; ``shared_dir`` is where staged tables go, visible to every executor."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.config("spark.checkpoint.dir", shared_dir) if shared_dir else builder


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, once per application.

    Arrow functions are pickled by module name. Where the package is not installed on the workers, a
    zip of it is handed out by the driver; that needs no folder in common.
    """
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="tidemark-ship-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tidemark_shipped = True
