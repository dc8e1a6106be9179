"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Row r of n goes to place p(r), a keyed permutation of 0 .. n-1; shard and slot follow from the place by
division, so either can be computed from the other without a table, and counts differ by one at most.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import positions, shipped

ROUNDS = 6


class Feistel:
    """Keyed permutation of 0 .. n-1, vectorised; ``backward`` undoes ``forward``.

    Both halves have the same number of bits, so the network permutes 0 .. 4^bits - 1, which is less
    than four times n; a value outside 0 .. n-1 is walked on along its cycle until it falls inside.
    """

    def __init__(self, n: int, seed: int):
        self.n = n
        self.bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = [_mix(np.uint64((seed * ROUNDS + i + 1) & (2**64 - 1))) for i in range(ROUNDS)]

    def _walk(self, values: np.ndarray, keys: list, flipped: bool) -> np.ndarray:
        out = np.asarray(values).astype(np.uint64)
        outside = np.ones(len(out), bool)
        while outside.any():
            out[outside] = self._network(out[outside], keys, flipped)
            outside = out >= np.uint64(self.n)
        return out.astype(np.int64)

    def _network(self, x: np.ndarray, keys: list, flipped: bool) -> np.ndarray:
        bits, mask = np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        left, right = x >> bits, x & mask
        if flipped:
            left, right = right, left
        for key in keys:
            left, right = right, left ^ (_mix(right ^ key) & mask)
        if flipped:
            left, right = right, left
        return (left << bits) | right

    def forward(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, self.keys, False)

    def backward(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, self.keys[::-1], True)


def _mix(x):
    """A bijective scrambling of 64-bit words: multiply and fold, twice."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


@shipped
def shard_rows(df: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id, size (UTF-8 bytes of the text plus 1), text_crc32, row_number
    (global, by id, then size and checksum), shard and slot.

    Counts of shards differ by one at most; slots of a shard run from 0 without gaps. The result depends
    on the rows, ``shards`` and ``seed`` only, not on how the table is cut; rows equal in id, size and
    checksum may change places. A null text counts as no bytes, null ids come first. Texts of any length are
    measured where they are read and not moved. Other columns don't matter, whatever their names. An empty table gives an
    empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    narrow = df.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    numbered = positions(narrow, [F.col("id"), F.col("size"), F.col("text_crc32")], into="row_number")

    @F.pandas_udf("long")
    def place(row: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(Feistel(int(n.iloc[0]), seed).forward(row.to_numpy())) if len(row) else row

    return (
        numbered.withColumn("place", place("row_number", "n_in_group"))
        .withColumn("shard", (F.col("place") % shards).cast("int"))
        .withColumn("slot", F.floor(F.col("place") / shards).cast("long"))
        .drop("place")
    )
