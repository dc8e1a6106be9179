"""Registration of queries, access to tables and stand-in views, and comparable output."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .analogs import VIEWS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_REFERENCE = re.compile(r"\{(\w+)\}")


# events of one stand-in job: the number of jobs grows with the events
JOB_EVENTS = 40


def with_jobs(text: str) -> str:
    """Spell out ``JOB(x)``, the job an event belongs to."""
    return re.sub(r"JOB\((\w+)\)", rf"CAST(floor(\1 / {JOB_EVENTS}) AS BIGINT)", text)


def job_of(event: str) -> Column:
    return F.floor(F.col(event) / JOB_EVENTS)


class Data:
    """Tables and views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES and name not in VIEWS:
            raise AttributeError(name)
        self.__dict__[name] = df = self._load(name)
        return df

    def _load(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = VIEWS[name]
        inputs = {n: getattr(self, n) for n in dict.fromkeys(_REFERENCE.findall(text))}
        return self.spark.sql(re.sub(r"EPOCH\((\w+)\)", r"unix_timestamp(\1)", with_jobs(text)), **inputs)


def duckdb_sql(text: str) -> str:
    """Put the stand-in views a query names in front of it, in DuckDB's spelling."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in order:
            for inner in _REFERENCE.findall(VIEWS[name]):
                visit(inner)
            order.append(name)

    for name in _REFERENCE.findall(text):
        visit(name)
    body = text.strip()
    if order:
        views = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)
        body = f"WITH {views}{', ' + body[5:] if body[:5].upper() == 'WITH ' else ' ' + body}"
    body = with_jobs(_REFERENCE.sub(r"\1", body)).replace("TIMESTAMP_NTZ", "TIMESTAMP")
    return re.sub(r"EPOCH\((\w+)\)", r"(epoch_us(\1) // 1000000)", body)


def comparable(df: DataFrame) -> DataFrame:
    """Plain types only: zoneless instants (dates too), doubles at six digits, arrays as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.TimestampType, T.DateType)):
            column = column.cast("timestamp_ntz")
        elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = F.round(column.cast("double"), 6)
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(F.transform(column, lambda x: x.cast("string")), ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None) -> Callable:
    """Register a function of ``Data`` under a key, with the SQL that must give the same rows."""

    def register(build: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: comparable(build(Data(spark, folder)))
        if sql is not None:
            SQL[name] = duckdb_sql(sql)
        return build

    return register
