"""Column names and types."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Apply a naming rule to every column; refuses rules that make two names equal."""
    names = [rule(c) for c in df.columns]
    folded = [n.lower() for n in names]
    clash = sorted({n for n in folded if folded.count(n) > 1})
    if clash or not all(names):
        raise ValueError(f"column names collide or vanish: {clash or df.columns}")
    return df.toDF(*names)


# Fixed value: characters removed from column names
UNSAFE_NAME_CHARACTERS = "()|,%+ ;{}\n\t="


def sanitize_names(df: DataFrame) -> DataFrame:
    """Drop the characters table formats refuse in column names."""
    unsafe = re.compile("[" + re.escape(UNSAFE_NAME_CHARACTERS) + "]")
    return rename_all(df, lambda name: unsafe.sub("", name))


def narrow_types(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long and decimal columns to float, through decimal(38,0) for longs, in one projection.

    Float holds whole numbers exactly up to 2^24 only, so keys go into ``keep``.
    """
    kept = {c.lower() for c in keep}
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name.lower() not in kept:
            if isinstance(field.dataType, T.LongType):
                column = column.cast(T.DecimalType(38, 0)).cast("float")
            elif isinstance(field.dataType, T.DecimalType):
                column = column.cast("float")
        columns.append(column.alias(field.name))
    return df.select(*columns)
